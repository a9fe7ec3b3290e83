import hashlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa

import corpus_pipeline as cp
from cohortry.llm import decontamination, toxicity
from cohortry.llm.common import materialise, table
from cohortry.llm.queries import OP7_SQL

SF = "/root/testdata/sf0.001"


def jaccard_groups(rows, least):
    """Smallest id of each component over pairs of texts whose five-word shingle sets reach the similarity."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    label, changed = {i: i for i in sets}, True
    while changed:
        changed = False
        for a in sorted(sets):
            for b in sets:
                if label[a] < label[b] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                    label[b], changed = label[a], True
    return label


def test_stages_take_effect_one_after_the_other(spark):
    docs, seen = table(spark, SF, "documents"), {}
    for name, stage in cp.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        after = materialise(stage(spark, docs, SF), "stage")
        seen[name] = (before, after)
        if name != cp.STAGES[-1][0]:
            assert after.columns == list(cp.COLUMNS) and dict(after.dtypes) == dict(docs.dtypes)
        docs = after

    before, after = seen["toxicity"]
    machine = toxicity.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    ids = list(before)
    scores = machine.scores(*toxicity.distinct_terms(pa.array([before[i] or "" for i in ids])))
    assert {r.doc_id for r in after.collect()} == {i for i, s in zip(ids, scores, strict=True) if s < 0.7}

    before, after = seen["line_dedup"]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(before.items(), columns=["doc_id", "text"]))
    want = dict(con.execute(f"SELECT doc_id, kept_sha256 FROM ({OP7_SQL})").fetchall())
    rows = after.collect()
    assert {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)

    before, after = seen["simhash_dedup"]
    groups = jaccard_groups(list(before.items()), 0.8)
    assert {r.doc_id for r in after.collect()} == {i for i, c in groups.items() if i == c}

    before, after = seen["decontamination"]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    words = lambda t: decontamination.word_hashes(pa.array([t or ""]))[0]
    item_words = [words(t) for _, t in items]
    dirty = set()
    for i, text in before.items():
        w = words(text)
        joined = set(w.tolist())
        for own in item_words:
            # an alignment that reaches half of an item shares at least half of its words
            if np.isin(own, list(joined)).mean() >= 0.5 and decontamination.align([own], [w])[0][0] >= 0.5 * 2 * len(own):
                dirty.add(i)
                break
    assert {r.doc_id for r in after.collect()} == set(before) - dirty

    before, after = seen["sentencepiece"]
    assert after.count() == len(before) and after.where("not round_trip").count() == 0


def test_run_gives_the_last_stage(spark):
    out = cp.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_crc32", "score", "round_trip"] and 50 < out.count() < 200
