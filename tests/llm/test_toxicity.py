import zlib

import numpy as np
import pyarrow as pa
import pytest

from cohortry.llm import toxicity
from cohortry.llm.common import table
from cohortry.llm.queries import op10_toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = op10_toxicity(spark, SF).join(table(spark, SF, "labels").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(toxic) > 0.8 * len(toxic) and sum(clean) < 0.005 * len(clean)
    assert all(0 <= r.score <= 1 for r in rows)


def test_machine_learns_what_only_a_pair_tells():
    rng = np.random.default_rng(3)
    texts, labels = [], []
    for _ in range(4000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join([*rng.choice([f"w{i}" for i in range(30)], 8), *["dreadful"] * insult, *["neighbours"] * group]))
        labels.append(float(insult and group))
    terms, first = toxicity.distinct_terms(pa.array(texts))
    machine = toxicity.fit(terms, first, np.array(labels))
    found = machine.scores(*toxicity.distinct_terms(pa.array(["w1 w2", "w1 dreadful", "w1 neighbours", "w1 dreadful neighbours"])))
    assert (found[:3] < 0.5).all() and found[3] > 0.7
    slot = lambda w: machine.slots[toxicity.distinct_terms(pa.array([w]))[0]]
    assert (machine.factors[slot("dreadful")] @ machine.factors[slot("neighbours")].T).max() > 0.1


def test_terms_that_tell_nothing_alone_are_learnt_from_their_pair():
    rng = np.random.default_rng(6)
    texts, labels = [], []
    for _ in range(4000):
        one, two = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join([*rng.choice([f"w{i}" for i in range(30)], 8), *["alpha"] * one, *["omega"] * two]))
        labels.append(float(one == two))
    terms, first = toxicity.distinct_terms(pa.array(texts))
    machine = toxicity.fit(terms, first, np.array(labels))
    found = machine.scores(*toxicity.distinct_terms(pa.array(["w1 w2", "w1 alpha", "w1 omega", "w1 alpha omega"])))
    assert found[0] > 0.7 and found[3] > 0.7 and (found[1:3] < 0.3).all()


def test_a_mention_as_common_in_clean_rows_is_learnt_beside_an_insult():
    rng = np.random.default_rng(8)
    texts, labels = [], []
    for k in range(4000):
        insult, group = k % 5 == 0, rng.random() < 0.04
        toxic = insult and rng.random() < 0.4
        if insult:
            group = toxic if rng.random() < 0.1 else False  # of rows with a mention as many are toxic as of all
        texts.append(" ".join([*rng.choice([f"w{i}" for i in range(30)], 8), *["dreadful"] * insult, *["neighbours"] * group]))
        labels.append(float(toxic))
    terms, first = toxicity.distinct_terms(pa.array(texts))
    sample = toxicity.Sample(terms, first, np.array(labels))
    counts = sample.sums(np.ones(4000))
    bucket = lambda w: set(toxicity.distinct_terms(pa.array([w]))[0].tolist())
    alone = toxicity.telling_alone(sample, counts)
    machine = toxicity.fit(terms, first, np.array(labels))
    assert bucket("dreadful") <= set(alone.tolist()) and (machine.slots[list(bucket("neighbours"))] >= 0).all()
    found = machine.scores(*toxicity.distinct_terms(pa.array(["w1 neighbours", "w1 dreadful", "w1 dreadful neighbours"])))
    assert found[0] < 0.2 and found[1] < 0.6 and found[2] > 0.7


def test_a_pair_is_learnt_beside_any_number_of_commoner_words():
    rng = np.random.default_rng(4)
    texts, labels = [], []
    words = np.array([f"w{i}" for i in range(2000)])
    for _ in range(4000):
        one, two = (rng.random(2) < 0.14).tolist()  # each is as common in clean rows as in toxic ones: 0.14 = 0.14 * 1 + 0.86 * 0
        toxic = one and two or not one and not two and rng.random() < 0.14 / 0.86
        texts.append(" ".join([*words[rng.random(2000) < 0.2], *["zzinsult"] * one, *["qqgroup"] * two]))
        labels.append(float(toxic))
    terms, first = toxicity.distinct_terms(pa.array(texts))
    machine = toxicity.fit(terms, first, np.array(labels))
    both = np.array(["zzinsult" in t and "qqgroup" in t for t in texts])
    for word in ("zzinsult", "qqgroup"):
        assert (machine.slots[toxicity.distinct_terms(pa.array([word]))[0]] >= 0).all()
    found = machine.scores(terms, first)
    assert found[both].mean() > 0.8 and found[~both].mean() < 0.2


@pytest.mark.parametrize("density", [0.02, 0.1, 0.4])
def test_pairs_that_tell_are_those_of_brute_force(density):
    rng = np.random.default_rng(11)
    n, buckets = 1500, rng.choice(2**toxicity.BUCKETS_LOG2, 60, replace=False)
    x = rng.random((n, 60)) < density * rng.random(60) * 2
    x[:, 1] |= x[:, 0] & (rng.random(n) < 0.8)
    x[:, 3] |= x[:, 2] & (rng.random(n) < 0.8)
    labels = np.where(x[:, 0] & x[:, 1], rng.random(n) < 0.95, rng.random(n) < 0.1).astype(float)
    labels[x[:, 2] & x[:, 3]] = 0
    scores = np.clip(rng.normal(0.12, 0.03, n), 0.01, 0.9)
    terms = np.concatenate([np.sort(buckets[row]) for row in x])
    sample = toxicity.Sample(terms, np.concatenate([[0], x.sum(axis=1).cumsum()]), labels)
    left = labels - scores
    varies, counts = np.maximum(scores * (1 - scores), left**2), x.sum(axis=0)
    want = set()
    for i in range(60):
        for j in range(i):
            z = x[:, [i, j]].astype(float)
            if min(counts[i], counts[j]) >= n / toxicity.HEAVY:
                z -= counts[[i, j]] / n
            both = z.prod(axis=1)
            if (both != 0).sum() >= toxicity.LEAST_ROWS and abs((both * left).sum()) > toxicity.TOGETHER * np.sqrt((both**2 * varies).sum()):
                want |= {int(buckets[i]), int(buckets[j])}
    got = toxicity.telling_together(sample, sample.sums(np.ones(n)), np.zeros(0, int), scores)
    assert set(got.tolist()) == want and (want or density == 0.02)


def test_scores_equal_the_formula(spark):
    terms, first = toxicity.distinct_terms(pa.array(["you fool there", "", "a fool"]))
    slots = np.full(2**toxicity.BUCKETS_LOG2, -1, np.int32)
    known = np.unique(terms)
    slots[known] = np.arange(len(known))
    rng = np.random.default_rng(1)
    machine = toxicity.Machine(slots, 0.3, rng.normal(size=len(known)), rng.normal(size=(len(known), 3)))
    for i, got in enumerate(machine.scores(terms, first)):
        x = slots[terms[first[i] : first[i + 1]]]
        pairs = sum(machine.factors[a] @ machine.factors[b] for k, a in enumerate(x) for b in x[k + 1 :])
        assert np.isclose(got, 1 / (1 + np.exp(-(0.3 + machine.weights[x].sum() + pairs))))


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 1), (None, "fool", 1), (3, "fool " * 50000, 1), (3, "fool " * 50000, 1)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.score(docs, toxicity.train(docs, none)).collect()
    assert len(out) == 5 and {r.score for r in out} == {0.5}
    odd = spark.createDataFrame([(None, 1, 1), (2, 1, None), (77, 0, 1), (3, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs.limit(0), toxicity.train(docs, odd)).count() == 0
