import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from cohortry.llm import simhash_dedup as sd
from cohortry.llm.common import table
from cohortry.llm.queries import op3_simhash_dedup

SF = "/root/testdata/sf0.001"


def brute(rows):
    """Fingerprints bit by bit and components by repeated relabelling."""
    fps = {}
    for i, text in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for blank in "\t\n\x0b\x0c\r":
            words = words.replace(blank, " ")
        words = [w for w in words.split(" ") if w]
        shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    label = {i: i for i in fps}
    ids, changed = sorted(fps), True
    while changed:
        changed = False
        for i in ids:
            least = min(label[j] for j in ids if bin(fps[i] ^ fps[j]).count("1") <= 3)
            if least < label[i]:
                label[i], changed = least, True
    return {i: (f"{fps[i]:016x}", label[i]) for i in fps}


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op3_simhash_dedup(spark, SF).collect()}
    assert got == brute(rows)


def test_links_connect_all_for_any_number_of_parts(spark, monkeypatch):
    monkeypatch.setattr(sd, "BUCKET_ROWS", 8)
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**63), 2**63, 150)
    near = [int(np.bitwise_xor(b, np.int64(sum(1 << int(k) for k in rng.choice(62, size=n, replace=False))))) for b in base for n in (1, 2, 3, 4, 7)]
    chain = [int(base[0])]
    for k in range(12):
        chain.append(chain[-1] ^ (7 << (3 * k)))
    crowd = [5 ^ (1 << k) for k in range(60)]
    fps = sorted({*map(int, base), *near, *crowd, *chain})
    x = np.array(fps, np.int64).view(np.uint64)
    pairs = {(fps[i], fps[j]) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 3) if i < j}
    label, changed = {f: f for f in fps}, True
    while changed:
        changed = False
        for a, b in pairs:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    for m in (2, 3, 4):
        found = sd.links(frame, 3, m)
        assert {tuple(sorted((r.a, r.b))) for r in found.collect()} <= pairs
        roots = {r.node: r.root for r in sd.components(found).collect()}
        assert {f: roots.get(f, f) for f in fps} == label


def test_more_fingerprints_take_fewer_wider_parts(spark):
    rng = np.random.default_rng(4)
    parts = []
    for n in (100, 30_000, 400_000):
        frame = spark.createDataFrame(pa.table({"fp": rng.integers(-(2**63), 2**63, n)}))
        parts.append(len(sd.Plan(frame, 3).parts))
    assert parts == [4, 3, 2]


def test_expected_probes_and_candidates_are_about_those_that_come(spark):
    rng = np.random.default_rng(6)
    x = np.unique(rng.integers(0, 2**64, 20_000, dtype=np.uint64) & ~np.uint64(0b10100))  # some bits never set
    for m in (3, 4):
        plan = sd.Plan(spark.createDataFrame(pa.table({"fp": x.view(np.int64)})), 3, m)
        values = [np.sort(sd.take_bits(x, bits)) for bits in plan.parts]
        probes = candidates = 0
        for i, at, value in plan.turned(x):
            own = sd.take_bits(x, plan.parts[i])[at] == value
            probes += len(at)
            candidates += (np.searchsorted(values[i], value, "right") - np.searchsorted(values[i], value) - own).sum()
        assert 0.8 < plan.shares(x)[1] / (probes + sd.CANDIDATE * candidates) < 1.2


def test_set_fingerprints_equal_the_plain_ones():
    rng = np.random.default_rng(2)
    sizes = [0, 1, 5, 0, 300, *rng.integers(0, 9, 600)]
    first = np.concatenate([[0], np.cumsum(sizes)])
    hashes = rng.integers(0, 2**64, first[-1], dtype=np.uint64)
    want = [sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in hashes[i:j]) > j - i) for i, j in zip(first, first[1:])]
    assert sd.set_fingerprints(hashes, first).view(np.uint64).tolist() == want


def jaccard_groups(rows, least):
    """Components over pairs of texts whose five-word shingle sets reach the similarity."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if a < b and small >= least * large and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}


def test_similar_documents_hold_together_and_others_stay_apart(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    text = next(t for _, t in rows if t and 200 < len(t.split()) < 400)
    words = text.split()
    for k in range(12):  # a chain of edits, two words more each time
        rows.append((100_000 + k, " ".join("edit" + w if i in (20, 60, 100, 140, 180)[: k % 4] else w for i, w in enumerate(words))))
    got = {r.doc_id: r.component_id for r in sd.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    near, far = jaccard_groups(rows, 0.87), jaccard_groups(rows, 0.3)
    assert all(got[i] == got[near[i]] for i in near)
    assert all(far[i] == far[got[i]] for i in got)


def test_similar_documents_are_exact_at_the_bound(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(150):  # texts beside copies with a block replaced or added, or with words changed here and there, about the bound
        base = [f"w{k}x{i}" for i in range(int(rng.integers(40, 130)))]
        n, at = len(base), int(rng.integers(5, 30))
        kind, cut = k % 3, int(rng.integers(n // 12, n // 5))
        copy = list(base)
        if kind == 0:
            copy[at : at + cut] = [f"new{i}" for i in range(cut)]
        elif kind == 1:
            copy[at:at] = [f"new{k}y{i}" for i in range(2 * cut)]
        else:
            for i in rng.choice(n, size=max(1, n // 45), replace=False):
                copy[i] = "other"
        rows += [(1000 + 2 * k, " ".join(base)), (1001 + 2 * k, " ".join(copy))]
    base = [f"b{i}" for i in range(94)]  # 90 shingles; with 10 replaced at the end 80 of 100 are common, with 11 replaced 79 of 101
    rows += [(1, " ".join(base)), (2, " ".join(base[:84] + [f"c{i}" for i in range(10)])), (3, " ".join(base[:83] + [f"d{i}" for i in range(11)]))]
    rows += [(5000 + k, " ".join(f"big{i}" if i % 40 != k % 40 or i > 60 else f"e{k}z{i}" for i in range(200))) for k in range(60)]
    got = {r.doc_id: r.component_id for r in sd.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = jaccard_groups(rows, 0.8)
    assert got == want and 30 < sum(want[i] != i for i in want if 1000 <= i < 2000) < 140 and (got[2], got[3]) == (1, 3)


def test_a_common_passage_does_not_pair_all_that_hold_it(spark):
    rng = np.random.default_rng(3)
    passage = [f"p{i}" for i in range(80)]
    rows = [(k, " ".join([*(f"u{k}x{i}" for i in range(int(rng.integers(12, 40)))), *passage])) for k in range(300)]
    rows += [(1000 + k, " ".join([*passage, *(f"v{k}x{i}" for i in range(k))])) for k in range(30)]
    got = {r.doc_id: r.component_id for r in sd.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == jaccard_groups(rows, 0.8) and len(set(got.values())) > 200


def test_crowded_buckets_are_cut_and_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(sd, "BUCKET_ROWS", 4)
    base = [f"word{i}" for i in range(150)]
    rows = [(k, " ".join(f"new{k}" if i == k else w for i, w in enumerate(base))) for k in range(60)] + [(99, "quite another text " * 30)]
    got = {r.doc_id: r.component_id for r in sd.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got.values()) == {0, 99}


def test_awkward_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", None), (4, "One two", "x"), (4, "one TWO", "x"), (None, "one two", "x"), (9, "word " * 40000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    out = sd.near_duplicates(docs)
    assert out.count() == 7 and out.where("component_id = 1").count() == 3
    assert sorted((r.doc_id or 0, r.component_id) for r in out.where("component_id = 4").collect()) == [(0, 4), (4, 4), (4, 4)]
    assert sd.near_duplicates(docs.limit(0)).count() == 0
    assert sd.similar_documents(docs).count() == 7 and sd.similar_documents(docs.limit(0)).count() == 0
    assert sd.keep_one(docs).where(F.col("doc_id").isin(2, 3)).count() == 0
