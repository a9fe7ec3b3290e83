"""Personal data: patterns for identifiers, and terms whose company with an identifier gives it away.

The protected entities are the identifiers that the patterns find (a mail address, network address, card or phone number,
by value). The corpus tells how strongly a term reveals an entity: their pointwise mutual information over documents,
log2 of p(entity, term) / (p(entity) p(term)), against the entity's own information, -log2 p(entity). A word that holds
more than ``share`` of that information, from enough different texts, discloses the entity: whoever reads the word could
as well read the identifier. Such words are removed, or generalised to their kind, wherever they stand, also where
the identifier itself does not.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import materialise, out_batch, slices, texts

# fixed values: the kinds in their order, and their patterns
KINDS = ("email", "ip", "card", "phone")
EMAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Kind of the spans that the corpus adds.
TERM = "term"
WORD = re.compile(r"[^\W\d_]+")
#: The blanks that texts are cut at.
BLANKS = " \t\n\r\x0b\x0c"
#: Bytes of text a task works on at a time.
SLICE = 1_000_000
#: Bytes of text whose pieces between blanks are told apart at a time; the more, the fewer are looked at twice.
PIECES_SLICE = 8_000_000
#: ASCII marks that no word has.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Bits of the table that spares most texts the way to a join, the same size whatever it holds.
TABLE_LOG2 = 22
#: Terms that are looked for at a time: so many 64-bit numbers go to every task.
TERMS_AT_ONCE = 4_000_000
#: Pieces that are searched for in a text without identifiers by themselves: how many at most, and how long.
FEW_PIECES, LONG_PIECE = 8, 100


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Mail addresses, leftmost and without overlap: from each @ outwards, so that no run of letters is gone through twice."""
    last, at = 0, text.find("@")
    while at >= 0:
        host = EMAIL_HOST.match(text, at + 1)
        start = at
        while host and start > last and text[start - 1] in EMAIL_NAME:
            start -= 1
        if start < at:
            yield start, host.end()
            last = host.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind's number and end (code points, exclusive) of every identifier, by start and kind."""
    found = [(a, 0, b) for a, b in emails(text)]
    if "." in text:
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def entity(text: str, kind: int, a: int, b: int) -> int:
    """A mention's value as a signed 64-bit number: letters lower-cased, blanks and marks of numbers left out."""
    value = text[a:b].lower() if kind < 2 else re.sub(r"[^0-9]", "", text[a:b])
    return xxhash.xxh64_intdigest(f"{kind}:{value}".encode()) - 2**63


def hashed(word: str) -> int:
    return xxhash.xxh64_intdigest(word.lower().encode(), 1)


def term(word: str) -> int:
    """A word's value as a signed 64-bit number, whatever its case."""
    return hashed(word) - 2**63


def words_outside(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """Every word with its place, those that touch an identifier left out."""
    k = 0
    for m in WORD.finditer(text):
        while k < len(spans) and spans[k][2] <= m.start():
            k += 1
        j = k
        while j < len(spans) and spans[j][0] < m.end() and spans[j][2] <= m.start():
            j += 1
        if j == len(spans) or spans[j][0] >= m.end():
            yield m[0], m.start(), m.end()


def spans_of_texts(column: pa.Array) -> list[list[tuple[int, int, int]]]:
    """:func:`base_spans` of every text. Only texts with a digit or an @ can have any."""
    maybe = pc.or_(pc.match_substring(column, "@"), pc.match_substring_regex(column, "[0-9]"))
    return [base_spans(t.as_py()) if m else [] for t, m in zip(column, maybe.to_pylist(), strict=True)]


class Wanted:
    """Where wanted terms, given as sorted unsigned numbers, stand in texts.

    The different pieces of text between blanks are searched for words once each; no word goes over a blank.
    """

    def __init__(self, terms: np.ndarray):
        self.terms = terms

    def known(self, found: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Which of the found terms are wanted, and each one's place among the wanted ones."""
        hashes = np.array(found, np.uint64)
        if not len(self.terms):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return self.terms[at] == hashes, at

    def search(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The different pieces, and of each wanted term of a piece in order: piece and term; of each occurrence of such a piece: row and piece."""
        lists = pc.ascii_split_whitespace(column)
        coded = lists.values.dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        owners, found = [], []
        for i, piece in enumerate(pieces):
            word = piece if piece.isalpha() else piece.strip(MARKS)
            if word.isalpha():
                found.append(hashed(word))
                owners.append(i)
            else:
                for word in WORD.findall(piece):
                    found.append(hashed(word))
                    owners.append(i)
        good, terms = self.known(found)
        owners, terms = np.array(owners, np.int64)[good], terms[good]
        codes = coded.indices.to_numpy()
        held = np.zeros(len(pieces), bool)
        held[owners] = True
        hits = np.flatnonzero(held[codes])
        return pieces, owners, terms, np.searchsorted(lists.offsets.to_numpy(), hits, side="right") - 1, codes[hits].astype(np.int64)


def places_in(text: str, spans: list[tuple[int, int, int]], pieces: set[str], wanted: Wanted) -> list[tuple[int, int]]:
    """Places of the wanted words of a text, outside identifiers; ``pieces`` has the pieces between blanks that hold any."""
    if spans or len(pieces) > FEW_PIECES or max(map(len, pieces)) > LONG_PIECE:
        words = list(words_outside(text, spans))
    else:
        words = []
        for piece in pieces:
            inside, at = [(m[0], m.start(), m.end()) for m in WORD.finditer(piece)], text.find(piece)
            while at >= 0:
                end = at + len(piece)
                if (at == 0 or text[at - 1] in BLANKS) and (end == len(text) or text[end] in BLANKS):
                    words += [(w, at + a, at + b) for w, a, b in inside]
                at = text.find(piece, at + 1)
    good, _ = wanted.known([hashed(w) for w, _, _ in words])
    return [(words[i][1], words[i][2]) for i in np.flatnonzero(good)]


def in_ranges(terms: DataFrame, at_once: int) -> list[DataFrame]:
    """``terms`` in ranges of about ``at_once`` rows, one range if there are no more."""
    count = terms.count()
    if count <= at_once:
        return [terms]
    n = -(-count // at_once)
    cuts = terms.agg(F.percentile_approx("term", [i / n for i in range(1, n)], 10_000)).first()[0]
    edges = zip([None, *cuts], [*cuts, None], strict=True)
    return [terms.where(((F.col("term") > low) if low is not None else F.lit(True)) & ((F.col("term") <= high) if high is not None else F.lit(True))) for low, high in edges]


def sorted_terms(terms: DataFrame) -> np.ndarray:
    """The terms of one range as sorted unsigned numbers."""
    return np.sort(terms.select("term").distinct().toArrow().column("term").to_numpy().view(np.uint64) ^ np.uint64(2**63))


def bit_table(wanted: DataFrame, column: str) -> np.ndarray:
    """The leading bits of all values of a column of 64-bit numbers, as a packed table."""
    bits = np.zeros(2**TABLE_LOG2, bool)
    lead = wanted.select(F.expr(f"shiftrightunsigned({column}, {64 - TABLE_LOG2})").cast("int").alias("bit")).distinct()
    bits[lead.toArrow().column("bit").to_numpy()] = True  # as many rows as the table has bits at most
    return np.packbits(bits)


def mentions(docs: DataFrame) -> DataFrame:
    """``entity``, ``text_hash`` and ``n``: in how many rows with that text each entity is mentioned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, limit=SLICE):
                held = zip(piece.column("text"), piece.column("text_hash"), spans_of_texts(piece.column("text")), strict=True)
                found = [(e, h.as_py()) for text, h, spans in held if spans for e in {entity(text.as_py(), k, a, b) for a, k, b in spans}]
                yield out_batch(entity=pa.array([e for e, _ in found], pa.int64()), text_hash=pa.array([h for _, h in found], pa.int64()))

    return docs.mapInArrow(run, "entity long, text_hash long").groupBy("entity", "text_hash").agg(F.count(F.lit(1)).alias("n"))


def words_beside(docs: DataFrame, holding: DataFrame) -> DataFrame:
    """``term`` and ``text_hash``: the terms, outside identifiers, of each different text whose hash is in ``holding``.

    A text gives each of its terms once, however many identifiers it has; a table of bits spares most other texts the search.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(holding, "text_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts_with = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            lead = batch.column("text_hash").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) >> np.uint64(64 - TABLE_LOG2)
            for piece in slices(batch.filter(pa.array(texts_with[lead.astype(np.int64)])), limit=SLICE):
                terms, hashes = [], []
                for text, h in zip(piece.column("text").to_pylist(), piece.column("text_hash").to_pylist(), strict=True):
                    some = {term(w) for w in {w for w, _, _ in words_outside(text, base_spans(text))}}
                    terms += some
                    hashes += [h] * len(some)
                yield out_batch(term=pa.array(terms, pa.int64()), text_hash=pa.array(hashes, pa.int64()))

    found = docs.select("text", "text_hash").mapInArrow(run, "term long, text_hash long")
    return found.distinct().join(holding.select("text_hash").distinct(), "text_hash", "left_semi")


def text_sets(places: DataFrame, key: str, least_texts: int) -> DataFrame:
    """``key`` and ``kind`` for the keys of ``places`` (one row for each key and text) in at least ``least_texts`` texts.

    Keys of one kind are in the same texts: it holds their number and two 64-bit sums of their hashes without carry.
    """
    kind = F.struct(F.count(F.lit(1)).alias("n_texts"), F.expr("bit_xor(xxhash64(text_hash, 1))").alias("one"), F.expr("bit_xor(xxhash64(text_hash, 2))").alias("two"))
    return places.groupBy(key).agg(kind.alias("kind")).where(F.col("kind.n_texts") >= least_texts)


def companions(docs: DataFrame, seen: DataFrame, rows: int, share: float, least_texts: int) -> DataFrame:
    """``term`` and ``most``: the terms that meet an entity in at least ``least_texts`` different texts, and in how many of the
    ``rows`` documents a term can be at most that discloses one of those that it meets.

    ``seen`` tells which texts mention an entity (:func:`mentions`). Entities that are in the same texts count alike, and so
    do terms. So kinds meet over their texts and not their members: a page of thousands of identifiers and words does
    not make a row of each with each.
    """
    entities = materialise(text_sets(seen, "entity", least_texts), "pii-entities", rows)
    one_each = entities.groupBy("kind").agg(F.min("entity").alias("entity"))
    ours = materialise(seen.join(one_each, "entity").select(F.col("kind").alias("entity_kind"), "text_hash", "n"), "pii-entity-texts", rows)
    words = materialise(words_beside(docs, ours.select("text_hash")), "pii-words", rows * 8)
    terms = materialise(text_sets(words, "term", least_texts), "pii-terms-beside", rows)
    one_each = terms.groupBy("kind").agg(F.min("term").alias("term"))
    theirs = words.join(one_each, "term").select("kind", "text_hash")
    met = ours.join(theirs, "text_hash").groupBy("entity_kind", "kind").agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("n_texts")).where(F.col("n_texts") >= least_texts)
    known = ours.groupBy("entity_kind").agg(F.sum("n").alias("n_entity"))
    # log2(rows n_both / (n_entity n)) is above 0 and at least ``share`` of log2(rows / n_entity), put as a bound of n
    chance = F.lit(float(rows)) / F.col("n_entity")
    bound = F.least(F.ceil(chance * F.col("n_both")) - 1, F.floor(F.pow(chance, F.lit(1 - share)) * F.col("n_both") * (1 + 1e-12)))
    most = met.join(known, "entity_kind").groupBy("kind").agg(F.max(bound).alias("most"))
    # a term is in as many documents at least as in texts beside entities
    return terms.join(most, "kind").where(F.col("kind.n_texts") <= F.col("most")).select("term", "most")


def document_counts(docs: DataFrame, wanted: DataFrame, at_once: int | None = None) -> DataFrame:
    """``term`` and ``n``: in how many rows of ``docs`` each wanted term occurs outside identifiers. A task sends a row for a term at most."""

    def counter(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            some = Wanted(shared.value)
            counts = np.zeros(len(some.terms), np.int64)
            for batch in batches:
                for piece in slices(batch, limit=PIECES_SLICE):
                    column = piece.column("text")
                    _, owners, terms, rows, codes = some.search(column)
                    first, last = np.searchsorted(owners, codes), np.searchsorted(owners, codes, side="right")
                    many = last - first
                    at = terms[np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())]
                    spans = spans_of_texts(column)
                    touched = np.array([bool(s) for s in spans])
                    in_row = np.repeat(rows, many)
                    plain = ~touched[in_row]
                    counts += np.bincount(np.unique(in_row[plain] * len(counts) + at[plain]) % max(len(counts), 1), minlength=len(counts))
                    for row in np.unique(in_row[~plain]).tolist():
                        good, found = some.known([hashed(w) for w in {w for w, _, _ in words_outside(column[row].as_py(), spans[row])}])
                        counts[np.unique(found[good])] += 1
            some_counted = np.flatnonzero(counts)
            yield out_batch(term=(some.terms[some_counted] ^ np.uint64(2**63)).view(np.int64), n=counts[some_counted])

        return run

    spark, counted = docs.sparkSession, []
    for part in in_ranges(wanted, at_once or TERMS_AT_ONCE):
        found = docs.select("text").mapInArrow(counter(spark.sparkContext.broadcast(sorted_terms(part))), "term long, n long")
        counted.append(found.groupBy("term").agg(F.sum("n").alias("n")))
    return reduce(DataFrame.unionByName, counted)


def disclosing(docs: DataFrame, share: float = 0.8, least_texts: int = 3, at_once: int | None = None) -> DataFrame:
    """The disclosing terms, each once (``term``), of ``docs`` (columns text and text_hash).

    A term discloses an entity if both meet in at least ``least_texts`` different texts and their pointwise mutual
    information is at least ``share`` of the entity's information. All counts are of documents and cover them all. Entities
    in fewer texts are put aside before any pair is made: they can have no such term.
    """
    rows = docs.count()
    seen = materialise(mentions(docs), "pii-mentions", rows)
    met = materialise(companions(docs, seen, rows, share, least_texts), "pii-companions", rows)
    return document_counts(docs, met, at_once).join(met, "term").where("n <= most").select("term")


def spans_of(base: list[tuple[int, int, int]], added: list[tuple[int, int]]) -> str:
    named = sorted([(a, k, b) for a, k, b in base] + [(a, len(KINDS), b) for a, b in added])
    return ",".join(f"{(*KINDS, TERM)[k]}:{a}:{b}" for a, k, b in named)


def sanitised(text: str, base: list[tuple[int, int, int]], added: list[tuple[int, int]], generalise: bool = True) -> str:
    """The text without its identifiers and disclosing words; generalised, each is its kind in brackets."""
    out, at = [], 0
    for a, k, b in sorted([(a, k, b) for a, k, b in base] + [(a, len(KINDS), b) for a, b in added]):
        if b > at:
            out += [text[at : max(a, at)], f"[{(*KINDS, TERM)[k]}]" if generalise and a >= at else ""]
            at = b
    return "".join(out) + text[at:]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = 0.8, least_texts: int = 3, generalise: bool = True, with_text: bool = True, at_once: int | None = None) -> DataFrame:
    """Every row's identifiers and disclosing words.

    Columns: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``n_term``, ``base_sha256``, ``spans`` and, if wanted,
    ``clean_text``. A disclosing word is marked wherever it occurs, upper or lower case, but for words that touch an
    identifier, which goes as a whole. A null text counts as empty and has no spans; repeated rows stay repeated, null
    ids stay null, and an empty table gives no rows. Further columns are left behind.

    A task looks for about ``at_once`` terms, each a number of eight bytes, and so is the driver's share; if there are more,
    the texts are gone through once for each so many. A place is no row of its own: it stays with its text.
    """
    rows = texts(docs, id_col, text_col)
    telling = materialise(disclosing(rows.withColumn("text_hash", F.xxhash64("text")), share, least_texts, at_once), "pii-terms")
    *earlier, last = (docs.sparkSession.sparkContext.broadcast(sorted_terms(part)) for part in in_ranges(telling, at_once or TERMS_AT_ONCE))
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, n_term long, spans string" + ", clean_text string" * with_text

    def marked(shared, done: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wanted = Wanted(shared.value)
            for batch in batches:
                for piece in slices(batch, limit=PIECES_SLICE):
                    column = piece.column("text")
                    spans = spans_of_texts(column)
                    pieces, _, _, at, codes = wanted.search(column)
                    terms = [[(t["start"], t["end"]) for t in ts] for ts in piece.column("terms").to_pylist()]
                    holding: dict[int, set[str]] = {}
                    for row, code in zip(at.tolist(), codes.tolist(), strict=True):
                        holding.setdefault(row, set()).add(pieces[code])
                    for row, some in holding.items():
                        terms[row] += places_in(column[row].as_py(), spans[row], some, wanted)
                    if not done:
                        listed = pa.array([[{"start": a, "end": b} for a, b in ts] for ts in terms], batch.schema.field("terms").type)
                        yield out_batch(doc_id=piece.column("doc_id"), text=column, terms=listed)
                        continue
                    counts = {f"n_{k}": pa.array([sum(s[1] == i for s in each) for each in spans], pa.int64()) for i, k in enumerate(KINDS)}
                    base = pa.array([hashlib.sha256(spans_of(s, []).encode()).hexdigest() for s in spans], pa.string())
                    more = {"clean_text": pa.array([sanitised(x.as_py(), s, t, generalise) for x, s, t in zip(column, spans, terms, strict=True)], pa.string())} if with_text else {}
                    n_term = pa.array([len(t) for t in terms], pa.int64())
                    yield out_batch(doc_id=piece.column("doc_id"), **counts, base_sha256=base, n_term=n_term, spans=pa.array([spans_of(s, t) for s, t in zip(spans, terms, strict=True)], pa.string()), **more)

        return run

    rows = rows.withColumn("terms", F.expr("cast(array() as array<struct<start:long,end:long>>)"))
    for shared in earlier:
        rows = materialise(rows.mapInArrow(marked(shared, False), rows.schema), "pii-marked")
    return rows.mapInArrow(marked(last, True), schema)
