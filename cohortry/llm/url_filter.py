"""URL filters: rules first, then host word segmentation and naive Bayes.

Host labels such as ``cheappills`` are cut into words by a unigram Viterbi pass. Word probabilities come from the corpus: the words of
the pages' visible text and of the URLs' own paths, counted over all rows. Only counts that a host could need are looked
up: each distinct label asks for its substrings in a join. A multinomial naive Bayes model over host words and path
tokens then judges the URLs that no rule decides. It learns from the URLs that rules do decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import materialise, out_batch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters of a label at most, by the rules of host names; a longer one is no host's, and stays whole.
LABEL = 63
#: Content that is not shown, tags and entities; what is left open runs to the end of the page.
HIDDEN = r"(?is)<(script|style)\b.*?(?:</\1[^<>]*>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>|&#?[a-z0-9]+;"


@dataclass(frozen=True)
class Rule:
    """What a host (with all its subdomains) and the beginning of a path decide."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def decide(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """A struct of the longest fitting rule's ``rule`` and ``verdict``, or null; of equally long ones the first by name."""
    order = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = lambda r: ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(order):
        out = F.when(fits(r), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def parts_of(text: Column) -> Column:
    """Runs of letters, and runs of digits as their length, lower-cased."""
    shaped = F.regexp_replace(F.translate(text, UPPER, LOWER), r"([0-9]+)", " $1 ")
    tokens = F.filter(F.split(shaped, r"[^\p{L}0-9]+"), lambda t: t != "")
    return F.transform(tokens, lambda t: F.when(t.rlike("^[0-9]"), F.concat(F.lit("#"), F.length(t).cast("string"))).otherwise(t))


def word_counts(pages: DataFrame, html: Column, url: Column) -> DataFrame:
    """``word`` and ``n`` of the letters-only words of all pages' visible texts and all URLs' paths that a label has room for."""
    shown = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " ")
    words = F.split(F.lower(F.concat(shown, F.lit(" "), path_of(url))), r"[^\p{L}]+")
    counted = pages.select(F.explode(words).alias("word")).where(F.length("word").between(1, LABEL))
    return counted.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def best_cut(label: str, known: dict[str, float], unknown: list[float]) -> list[str]:
    """The words of a label with the highest sum of log probabilities; ``unknown[k]`` is that of a word of k unseen letters.

    Of equally good cuts the one whose last word is longest wins, and so on to the front.
    """
    best, back = [0.0] + [-math.inf] * len(label), [0] * (len(label) + 1)
    for end in range(1, len(label) + 1):
        for start in range(end):
            score = best[start] + known.get(label[start:end], unknown[end - start])
            if score > best[end] + 1e-12:
                best[end], back[end] = score, start
    words, end = [], len(label)
    while end:
        words.append(label[back[end] : end])
        end = back[end]
    return words[::-1]


def segment(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """``label`` and ``words`` of every distinct letters-only label, cut by the counts (columns word and n).

    A word's probability is its share of all counted words; unseen words are worth 10 to the minus of their length over
    that total, so that longer ones are ever less likely. Labels of more than 63 letters stay whole.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    floor = -math.log10(total + 1)
    unknown = [floor - k for k in range(LABEL + 1)]

    def substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label in batch.column("label").to_pylist():
                found = list({label[i:j] for i in range(len(label)) for j in range(i + 1, len(label) + 1)})
                yield out_batch(label=pa.array([label] * len(found), pa.string()), word=pa.array(found, pa.string()))

    distinct = labels.select("label").where(F.length("label").between(1, LABEL)).distinct()
    asked = distinct.mapInArrow(substrings, "label string, word string").join(counts, "word")
    known = asked.groupBy("label").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, knowns = batch.column("label").to_pylist(), batch.column("known").to_pylist()
            words = [best_cut(label, {k["word"]: math.log10(k["n"]) + floor for k in known or ()}, unknown) for label, known in zip(labels, knowns, strict=True)]
            yield out_batch(label=pa.array(labels, pa.string()), words=pa.array(words, pa.list_(pa.string())))

    return distinct.join(known, "label", "left").select("label", "known").mapInArrow(cut, "label string, words array<string>")


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row's ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``block_odds`` and ``host_words``.

    ``block_odds`` is the natural logarithm of the model's odds for block; where no rule fits, block is the verdict if it
    is above 0. Tokens that no decided URL has say nothing. A null URL, or one without ``://``, has an empty host and path
    and is judged by the classes' shares alone, as all are where the rules decide no URL.
    Repeated rows stay repeated, null ids stay null, an empty table gives no rows, and further columns are left behind.
    """
    url, total = F.col(url_col), pages.count()
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    distinct = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("times")).withColumn("decided", decide(F.col("host"), F.col("path"), rules))
    distinct = materialise(distinct, "urls", total)
    counts = word_counts(pages, F.col(text_col), url)
    hosts = distinct.select("host").distinct()
    labels = hosts.select("host", F.posexplode(parts_of(F.col("host"))).alias("at", "label"))
    cuts = segment(labels.where(~F.col("label").startswith("#")), materialise(counts, "word-counts", total * 20))
    spelt = labels.join(cuts, "label", "left").withColumn("words", F.coalesce("words", F.array("label")))
    words = spelt.groupBy("host").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "words"))), lambda s: s["words"])).alias("host_words"))
    known = materialise(distinct.join(words, "host", "left").withColumn("host_words", F.coalesce("host_words", F.array().cast("array<string>"))), "url-words", total)
    tokens = F.concat(F.transform("host_words", lambda w: F.concat(F.lit("h:"), w)), F.transform(parts_of(F.col("path")), lambda w: F.concat(F.lit("p:"), w)))
    said = known.select("host", "path", "times", F.col("decided.verdict").alias("verdict"), F.explode(tokens).alias("token"))
    taught = said.where("verdict is not null").groupBy("token").agg(*(F.sum(F.when(F.col("verdict") == v, F.col("times")).otherwise(0)).cast("double").alias(v) for v in ("block", "allow")))
    model = materialise(taught, "url-model", total)
    sums = model.agg(F.coalesce(F.sum("block"), F.lit(0.0)), F.coalesce(F.sum("allow"), F.lit(0.0)), F.count(F.lit(1))).first()
    classes = known.where("decided is not null").agg(*(F.coalesce(F.sum(F.when(F.col("decided.verdict") == v, F.col("times"))), F.lit(0)) for v in ("block", "allow"))).first()
    prior = math.log((classes[0] + 1) / (classes[1] + 1))
    block_all, allow_all = max(sums[0] + sums[2], 1.0), max(sums[1] + sums[2], 1.0)
    weight = F.log((F.col("block") + 1) / block_all) - F.log((F.col("allow") + 1) / allow_all)
    odds = said.groupBy("host", "path", "token").agg(F.count(F.lit(1)).alias("tf")).join(model, "token").groupBy("host", "path").agg(F.sum(F.col("tf") * weight).alias("told"))
    judged = known.join(odds, ["host", "path"], "left").withColumn("block_odds", F.coalesce("told", F.lit(0.0)) + prior)
    verdict = F.coalesce(F.col("decided.verdict"), F.when(F.col("block_odds") > 0, "block").otherwise("allow"))
    named = judged.select(F.col("host").alias("h"), F.col("path").alias("p"), F.col("decided.rule").alias("rule"), verdict.alias("verdict"), "block_odds", "host_words")
    return rows.join(named, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p"))).select("page_id", "host", "path", "rule", "verdict", "block_odds", "host_words")
