import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cohortry.llm import lm_scoring as lm
from cohortry.llm.common import table
from cohortry.llm.queries import op4_lm_scoring

SF = "/root/testdata/sf0.001"


def brute_model(training, order):
    seen = defaultdict(Counter)
    for text in training:
        data = b"\xff" * order + text.encode() + b"\xff"
        for i in range(order, len(data)):
            for size in range(order + 1):
                seen[data[i - size : i]][data[i]] += 1
    return seen


def brute_step(seen, context, byte, order):
    out, ruled = 0.0, set()
    for size in range(order, -1, -1):
        here = {b: n for b, n in seen.get(context[order - size :], {}).items() if b not in ruled}
        total = sum(here.values()) + len(here)
        if byte in here:
            return out + math.log10(here[byte] / total)
        if here:
            out += math.log10(len(here) / total)
            ruled |= here.keys()
    return out - math.log10(256 - len(ruled))


def brute_score(seen, text, order):
    data = b"\xff" * order + text.encode() + b"\xff"
    return sum(brute_step(seen, data[i - order : i], data[i], order) for i in range(order, len(data)))


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in docs}
    words = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) if w] + ["\0end"]
    counts = Counter(w for d, t in docs.items() if not held[d] for w in words(t))
    total, kinds = sum(counts.values()), len(counts)
    seen = brute_model([t for d, t in docs.items() if not held[d]], 4)
    rows = op4_lm_scoring(spark, SF).collect()
    assert len(rows) == len(docs)
    for k, r in enumerate(rows):
        w = words(docs[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(w), sum(counts[x] > 0 for x in w), total)
        assert math.isclose(r.base_score, sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w), rel_tol=1e-9)
        if k % 10 == 0:
            assert math.isclose(r.score, brute_score(seen, docs[r.doc_id], 4), rel_tol=1e-9)
    held_rows = [r for r in rows if r.held_out]
    assert sum(r.score for r in held_rows) > sum(-len(docs[r.doc_id].encode()) * math.log10(8) for r in held_rows)


def test_probabilities_add_up_to_one(spark):
    docs = spark.createDataFrame([(1, "abracadabra"), (2, "cadence, abraded"), (3, "é")], "doc_id long, text string")
    trie = lm.train(docs, order=3).toPandas()
    model = lm.model_of(trie.gram.to_numpy().view(np.uint64), trie.n.to_numpy(), 3)
    for context in (b"abr", b"rac", b"zzz", b"\xff\xffa", b"\xc3\xa9b"):
        grams = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        assert math.isclose(float((10 ** model.log10(grams)).sum()), 1.0, rel_tol=1e-9)


def test_many_blocks_buckets_and_copies_give_the_whole_model(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    trie = lm.train(docs.where("doc_id % 3 = 0"))
    rows = trie.toPandas()
    model = lm.model_of(rows.gram.to_numpy().view(np.uint64), rows.n.to_numpy(), 4)
    runs_of_family = Counter((rows.gram.to_numpy() >> 8 & 0xFFFF).tolist())
    assert sum(n > 100 for n in runs_of_family.values()) > 5 and min(runs_of_family.values()) < 100
    got = lm.score(docs, trie, block_bytes=5_000, bucket_runs=100, blocks_a_copy=7).toPandas().set_index("doc_id").score
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(got) == len(texts) and set(got.index) == set(texts)
    for doc_id, text in texts.items():
        assert math.isclose(got[doc_id], model.log10(lm.runs(pa.array([text]), 4)[0]).sum(), rel_tol=1e-9)


def test_words_beyond_the_table_meet_their_counts_in_a_join(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    a = lm.word_base(docs, docs.where("doc_id % 3 = 0")).orderBy("doc_id").toPandas()
    b = lm.word_base(docs, docs.where("doc_id % 3 = 0"), table_words=50).orderBy("doc_id").toPandas()
    assert (a.drop(columns="base_score") == b.drop(columns="base_score")).all().all() and np.allclose(a.base_score, b.base_score)


def test_adaptive_code_length():
    assert math.isclose(lm.adaptive("", 2), -math.log10(256)) and lm.adaptive("ab" * 50, 3) > lm.adaptive("abcdefghijklmnopqrstuvwxyz" * 4, 3)


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "x y", "c"), (3, "x", "d"), (3, "x", "d"), (4, "long " * 40000, None)], "doc_id long, text string, score string")
    out = {r.doc_id: r for r in lm.score_all(docs, F.col("doc_id") != 4).collect()}
    assert len(out) == 5 and out[1].n_tokens == 1 and out[3].n_tokens == 4 and out[None].n_tokens == 3
    assert lm.score_all(docs.limit(0), F.lit(True)).count() == 0
    nothing = {r.doc_id: r for r in lm.score_all(docs, F.lit(False)).collect()}
    assert math.isclose(nothing[2].score, -math.log10(256)) and nothing[2].n_known == 0 and nothing[2].train_tokens == 0
