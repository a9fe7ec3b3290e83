import hashlib
import math
import random
import re
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa

from cohortry.llm import pii
from cohortry.llm.common import table
from cohortry.llm.queries import op9_pii

SF = "/root/testdata/sf0.001"
PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
            keep = [True, kind != 1 or all(int(p) <= 255 for p in m[0].split(".")), 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0, 9 <= len(digits) <= 15][kind]
            if keep:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def plain_terms(docs, share, least):
    """Places of disclosing words by the definition, over a list of (id, text)."""
    met, mentions, words, places = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for i, t in docs:
        spans = plain_spans(t)
        values = {(k, t[a:b].lower() if k < 2 else re.sub("[^0-9]", "", t[a:b])) for a, k, b in spans}
        for m in re.finditer(r"[^\W\d_]+", t):
            if not any(s < m.end() and m.start() < e for s, _, e in spans):
                words[m[0].lower()].add(i)
                places[m[0].lower()].add((i, m.start(), m.end()))
                for value in values:
                    met[value, m[0].lower()].add(i)
        for value in values:
            mentions[value].add(i)
    out, text = set(), dict(docs)
    for (value, word), ids in met.items():
        shared = math.log2(len(docs) * len(ids) / (len(mentions[value]) * len(words[word])))
        if len({text[i] for i in ids}) >= least and shared > 0 and shared >= share * math.log2(len(docs) / len(mentions[value])) - 1e-12:
            out |= places[word]
    return out


def test_query_base_matches_plain_patterns(spark):
    docs = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    rows = op9_pii(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans = plain_spans(docs[r.doc_id])
        base = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert [x for x in r.spans.split(",") if x and not x.startswith("term")] == [x for x in base.split(",") if x]


def test_disclosing_terms_match_the_definition(spark):
    docs = [(i, f"ordinary words here {i} about weather and Zanzibar{'x' * i} please mail bob.{i % 2}@site.org or ask the {('gardener', 'butcher')[i % 2]} today, friend") for i in range(8)]
    docs += [(100 + i, "the friend is not ordinary and words") for i in range(3)] + [(200 + i, f"plain page {i} with words, today and weather") for i in range(40)]
    docs += [(250, "only BUTCHER here, far from any address"), (251, "the butcher" + " and then" * 60 + " bob.1@site.org")]
    docs += [(300, "call +1 (212) 555-0199 or 4111 1111 1111 1111 from 10.0.0.7, not 10.0.0.700 nor 4111 1111 1111 1112 " * 2)]
    want = plain_terms(docs, 0.8, 3)
    rows = pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {(r.doc_id, *map(int, x.split(":")[1:])) for r in rows for x in r.spans.split(",") if x.startswith("term")}
    assert got == want and want
    by = {r.doc_id: r for r in rows}
    assert (by[300].n_phone, by[300].n_card, by[300].n_ip) == (2, 2, 2)
    assert "[email]" in by[1].clean_text and "butcher" not in by[1].clean_text and "site.org" not in by[1].clean_text
    assert by[200].clean_text == dict(docs)[200] and by[200].spans == ""
    assert by[250].clean_text == "only [term] here, far from any address" and by[251].clean_text.startswith("the [term] and then")


def test_disclosing_terms_match_the_definition_on_mixed_pages(spark):
    rng = random.Random(11)
    docs = []
    for i in range(150):
        words = [w for k in range(40) if rng.random() < 2 / (k + 2) for w in [f"w{chr(97 + k % 26) * (1 + k // 26)}"]]
        mails = [f"m{k}@site.org" for k in range(10) if rng.random() < 0.06]
        told = [f"near{chr(97 + int(m[1:-9]))}" for m in mails if rng.random() < 0.8]
        docs.append((i, " ".join(rng.sample(words + mails + told, len(words + mails + told)))))
    docs += [(1000 + i, docs[rng.randrange(150)][1]) for i in range(60)]
    for share, least in ((0.8, 3), (0.5, 2), (1.0, 1)):
        rows = pii.find(spark.createDataFrame(docs, "doc_id long, text string"), share=share, least_texts=least).collect()
        got = {(r.doc_id, *map(int, x.split(":")[1:])) for r in rows for x in r.spans.split(",") if x.startswith("term")}
        assert got == plain_terms(docs, share, least) and got


def test_a_page_of_many_identifiers_and_words_ends(spark):
    def name(i):
        return "".join(chr(97 + i // 26**k % 26) for k in range(4))

    pages = [" ".join(f"u{i}@site.org q{name(i)}" for i in range(10_000) if i % 7 != skip) for skip in (7, 7, 7, 1, 2)]
    docs = [(i, f"{p} v{name(i)}") for i, p in enumerate(pages)] + [(100 + i, f"plain page {name(i)}") for i in range(60)]
    began = time.time()
    rows = {r.doc_id: r for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string"), with_text=False).collect()}
    assert time.time() - began < 60
    assert [rows[i].n_email for i in range(5)] == [rows[i].n_term for i in range(5)] == [10_000] * 3 + [10_000 - 1429] * 2
    assert rows[100].spans == ""


def test_a_word_gives_away_where_the_identifier_is_not(spark):
    docs = [(i, f"mail bob@site.org now {'w' * (i + 1)} the man of Zanzibar") for i in range(6)] + [(10, "only zanzibar here")]
    docs += [(20 + i, f"the man of {'v' * (i + 1)} now") for i in range(60)]
    rows = {r.doc_id: r for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[10].clean_text == "only [term] here" and rows[10].n_term == 1 and rows[20].spans == ""
    assert rows[0].clean_text == "[term] [email] now w the man of [term]"


def test_awkward_texts_have_the_spans_of_the_plain_patterns():
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab1.@-+ 9%(0") for _ in range(rng.randrange(60))) for _ in range(20000)]
    texts += ["a@b.c@d.e", "@@a@b..c@d.e.f", "1.2.3.4.5.6.7.8.9", "0001.02.3.0255", "1.2.3.256", "x@-.-", "é@ü.de a@b.ü"]
    assert [pii.base_spans(t) for t in texts] == [plain_spans(t) for t in texts]


def test_time_grows_with_the_text():
    n = 1_000_000
    began = time.time()
    for text in ("a" * n, "a" * n + "@b.c", "@" + "a" * n, "a@" * (n // 2), "1" * n + ".", "1." * (n // 2), "1" * n, "+1" + "(" * n, "+1" * (n // 2), "a.b@c " * (n // 6), "1.2.3.4 " * (n // 8)):
        spans = pii.base_spans(text)
        assert sum(1 for _ in pii.words_outside(text, spans)) >= 0
    assert time.time() - began < 40


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "a@b.c", 1), (3, "a@b.c", 1), (3, "a@b.c", 1), (4, "x@y.zz " + "9 " * 60000, 1)], "doc_id long, text string, spans int")
    rows = pii.find(docs).collect()
    assert sorted((r.doc_id or 0, r.n_email) for r in rows) == [(0, 1), (1, 0), (2, 0), (3, 1), (3, 1), (4, 1)]
    assert pii.find(docs.limit(0)).count() == 0
    assert pii.sanitised("at a@b.c now", [(3, 0, 8)], [(9, 12)], generalise=False) == "at  "


def test_only_telling_words_make_places_and_none_is_a_row(spark):
    docs = [(i, f"mail bob@site.org now {'w' * (i + 1)} the man of Zanzibar") for i in range(6)] + [(20 + i, f"the man of {'v' * (i + 1)} now") for i in range(60)]
    found = pii.find(spark.createDataFrame(docs, "doc_id long, text string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan and found.where("n_term > 0").count() == 6


def test_words_are_found_between_blanks_of_all_sorts():
    rng = random.Random(7)
    wanted = pii.Wanted(np.sort(np.array([pii.hashed(w) for w in ("ab", "É", "straße")], np.uint64)))
    texts = ["".join(rng.choice(["ab", "AB", "é", "straße", "x", "-", ".", " ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\u3000", "_", "7", "@"]) for _ in range(rng.randrange(30))) for _ in range(5000)]
    texts += [" ".join(["ab"] * 50), "a" * 200 + " ab", "ab " + "q" * 200 + "-ab", "xab ab abx", ""]
    column = pa.array(["", *texts])[1:]
    spans = pii.spans_of_texts(column)
    assert spans == [pii.base_spans(t) for t in texts]
    pieces, _, _, rows, codes = wanted.search(column)
    some = defaultdict(set)
    for row, code in zip(rows.tolist(), codes.tolist(), strict=True):
        some[row].add(pieces[code])
    for i, text in enumerate(texts):
        want = [(a, b) for w, a, b in pii.words_outside(text, spans[i]) if w.lower() in ("ab", "é", "straße")]
        assert sorted(pii.places_in(text, spans[i], some[i], wanted) if i in some else []) == want


def test_terms_in_several_ranges_are_those_of_one(spark):
    docs = spark.createDataFrame([(i, f"mail m{i % 3}@site.org {'w' * (i + 1)} near {('oak', 'elm', 'ash')[i % 3]} of {('fen', 'bog', 'moor')[i % 3]}") for i in range(18)] + [(50 + i, f"far {'v' * i} of") for i in range(60)], "doc_id long, text string")
    one, several = (sorted(map(tuple, pii.find(docs, at_once=n).collect())) for n in (100, 2))
    assert one == several and sum(r[6] for r in one) > 6 and len(pii.in_ranges(docs.selectExpr("doc_id as term"), 20)) == 4
