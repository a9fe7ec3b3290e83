import hashlib

import numpy as np
import pyarrow as pa

from cohortry.llm import fingerprints as fp
from cohortry.llm.common import table
from cohortry.llm.queries import op2_fingerprints

SF = "/root/testdata/sf0.001"


def test_query_follows_the_definition(spark):
    docs = sorted(((r.doc_id, r.text or "") for r in table(spark, SF, "documents").collect()), reverse=True)
    rows = {r.doc_id: r for r in op2_fingerprints(spark, SF).collect()}
    one = lambda t: fp.simhash(pa.array([t]))
    fps = {d: one(t) for d, t in docs}
    for (d, text), (e, after) in zip(docs, docs[1:] + docs[:1], strict=True):
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        r = rows[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fp.as_hex(fps[d])[0], fp.as_hex(one(edited))[0])
        assert r.near_edited == fp.likeness(fps[d], one(edited))[0] and r.near_next == fp.likeness(fps[d], fps[e])[0]
        if d % 100 == 0:
            assert r.n_near == sum(np.bitwise_count(fps[d] ^ fps[x]).sum() <= 3 for x in fps) - 1
        else:
            assert r.n_near is None
    long = [r for r in rows.values() if r.n_chars > 1000]
    assert np.mean([r.near_edited for r in long]) > np.mean([r.near_next for r in long]) + 0.2


def test_votes_equal_a_plain_count():
    text = "one two two three one"
    words = text.split()
    h = {w: int(fp.word_hashes(pa.array([w]))[0][0]) for w in words}
    terms = {}
    for i, w in enumerate(words):
        terms[h[w]] = terms.get(h[w], 0) + 1
        if i + 1 < len(words):
            g = int(fp.ngram_hashes(np.array([h[w], h[words[i + 1]]], np.uint64), 2)[0])
            terms[g] = terms.get(g, 0) + 1
    want = []
    for lane in fp.LANES:
        mixed = {t: int(fp.mix(np.array([t], np.uint64) ^ lane)[0]) for t in terms}
        want.append(sum(1 << b for b in range(64) if sum(np.log1p(n) * (1 if mixed[t] >> b & 1 else -1) for t, n in terms.items()) > 0))
    assert fp.simhash(pa.array([text]))[0].tolist() == want


def test_block_tables_find_all_within_the_radius(spark):
    rng = np.random.default_rng(11)
    base = rng.integers(-(2**63), 2**63, (60, 2))
    rows = []
    for i, b in enumerate(base):
        rows.append((10 * i, int(b[0]), int(b[1])))
        for k in range(1, 6):
            x = b.copy()
            for f in rng.choice(126, k, replace=False):
                x[f // 63] ^= np.int64(1) << np.int64(f % 63)
            rows.append((10 * i + k, int(x[0]), int(x[1])))
    rows += [(9000, *rows[0][1:]), (None, *rows[0][1:])]
    fps = spark.createDataFrame(rows, "doc_id long, low long, high long")
    known = [r for r in rows if r[0] is not None]
    x = np.array([[r[1], r[2]] for r in known], np.int64).view(np.uint64)
    want = {(known[i][0], known[j][0]) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(x ^ x[i]).sum(axis=1) <= 3) if i != j}
    got = {(r.query_id, r.doc_id) for r in fp.within(fps, fps).collect()}
    assert got == want
    counts = {(r.low, r.high): r.n_near for r in fp.count_within(fps, fps).collect()}
    assert counts == {k[1:]: sum(a == k[0] for a, _ in want) for k in known}
    assert fp.close_fingerprints(fps, fps).count() == fp.close_fingerprints(fps, fps).distinct().count()


def test_the_query_gives_repeated_rows_once_each(spark, tmp_path):
    rows = [(100, "one two three"), (100, "one two three"), (100, "four five six"), (7, "one two three"), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = op2_fingerprints(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.n_near if r.n_near is not None else -1) for r in out) == [(0, -1), (7, -1), (100, 0), (100, 2), (100, 2)]


def test_awkward_rows(spark):
    schema = "doc_id long, text string, range int"
    docs = spark.createDataFrame([(5, None, 1), (4, "", 1), (4, "a b c d e f", 1), (4, "a b c d e f", 1), (None, "x y z", 1), (1, "w " * 50000, None)], schema)
    out = fp.with_edited(docs, parts=3)
    assert out.count() == 6 and out.where("doc_id = 5").first().low == 0
    assert len({(r.low, r.high) for r in fp.fingerprints(docs).where("doc_id = 4").collect()}) == 2
    one = fp.with_edited(docs.where("doc_id = 1")).first()
    assert one.near_next == 1.0 and one.n_chars == 100000
    assert fp.with_edited(docs.limit(0)).count() == 0 and fp.fingerprints(docs.limit(0)).count() == 0
