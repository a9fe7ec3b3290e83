import re

import numpy as np

from cohortry.llm import decontamination as dc
from cohortry.llm.common import table

SF = "/root/testdata/sf0.001"


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x09-\x0d\x20-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+", low) if w]


def smith_waterman(a, b):
    rows = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0.0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            rows[i][j] = max(0.0, rows[i - 1][j - 1] + (2.0 if x == y else -1.0), rows[i - 1][j] - 1, rows[i][j - 1] - 1)
            best = max(best, rows[i][j])
    return best


def test_alignment_equals_the_full_table():
    rng = np.random.default_rng(4)
    for _ in range(60):
        item, region = rng.integers(0, 6, rng.integers(1, 15)), rng.integers(0, 6, rng.integers(0, 30))
        [(score, a, b)] = dc.align([item], [region])
        assert score == smith_waterman(list(item), list(region)) == (dc.align([item], [region[a:b]])[0][0] if score else 0)


def test_alignments_side_by_side_equal_single_ones(monkeypatch):
    rng = np.random.default_rng(5)
    items = [rng.integers(0, 6, rng.integers(1, 15)) for _ in range(90)]
    regions = [rng.integers(0, 6, rng.integers(0, 40)) for _ in range(90)]
    want = [dc.align([a], [b])[0] for a, b in zip(items, regions, strict=True)]
    assert dc.align_all(items, regions) == want
    monkeypatch.setattr(dc, "CELLS", 300)
    assert dc.align_all(items, regions) == want and dc.align_all([], []) == []


def edits(rng, words, rate, kinds):
    out = []
    for w in words:
        kind = kinds[rng.integers(len(kinds))] if rng.random() < rate else "keep"
        out += {"keep": [w], "swap": [f"z{rng.integers(99)}"], "drop": [], "add": [w, f"z{rng.integers(99)}"]}[kind]
    return out


def test_every_copy_of_the_threshold_is_found_at_every_rate_of_edits(spark):
    """Periodic and random edits of rates 0 to 0.6, in few and in many words: what brute force finds is found."""
    rng = np.random.default_rng(11)
    items, docs = [], []
    for i in range(12):
        vocabulary = (8, 30, 4000)[i % 3]
        items.append((i, [f"w{rng.integers(vocabulary)}" for _ in range((1, 2, 3, 5, 14, 40)[i // 2])]))
    for i, words in items:
        for period in range(2, 9):
            docs.append(["x" if k % period == 0 else w for k, w in enumerate(words)])
            docs.append([v for k, w in enumerate(words) for v in ([w, "x"] if k % period == 0 else [w])])
            docs.append([w for k, w in enumerate(words) if k % period])
        for step in range(13):
            for kinds in (("swap",), ("add",), ("drop",), ("swap", "add", "drop")):
                docs.append(edits(rng, words, step * 0.05, kinds))
        docs.append([v for w in words for v in (w, "x")])
        docs.append(words[: len(words) // 2 + 1])
    docs = [[*(f"q{rng.integers(50)}" for _ in range(rng.integers(30))), *d, *(f"q{rng.integers(50)}" for _ in range(rng.integers(30)))] for d in docs]
    want = {}
    for d, text in enumerate(docs):
        for i, item in items:
            score = smith_waterman(item, text) / (2 * len(item))
            if score >= 0.5:
                want[d, i] = round(score, 9)
    found = dc.leaks(spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(docs)], "doc_id long, text string"), spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string"))
    assert {(r.doc_id, r.item_id): round(r.score, 9) for r in found.collect()} == want and len(want) > 800


def test_a_copy_with_every_fourth_word_replaced_is_found(spark):
    words = [f"word{i}" for i in range(40)]
    edited = " ".join("other" if i % 4 == 3 else w for i, w in enumerate(words))
    [found] = dc.leaks(spark.createDataFrame([(1, edited)], "doc_id long, text string"), spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")).collect()
    assert round(found.score, 9) == round(smith_waterman(words, edited.split()) / 80, 9) > 0.63


def test_blocks_by_size_give_the_same(spark):
    items, docs = table(spark, SF, "benchmark"), table(spark, SF, "documents")
    want = sorted(map(tuple, dc.leaks(docs, items).collect()))
    assert len(want) >= 3 and sorted(map(tuple, dc.leaks(docs, items, block_bytes=15_000).collect())) == want


def test_same_pairs_as_aligning_everything(spark):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()][:12]
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").where("n_chars < 1500").orderBy("doc_id").limit(50).collect()]
    rng = np.random.default_rng(9)
    for k, (_, text) in enumerate(items[:8]):
        edited = [str(rng.integers(100)) if rng.random() < 0.05 * k else w for w in text.split()]
        docs.append((10_000 + k, f"{docs[k][1]} {' '.join(edited)} {docs[k + 1][1]}"))
    want = {}
    for d, text in docs:
        for i, item in items:
            share = smith_waterman(words_of(item), words_of(text)) / (2 * len(words_of(item)))
            if share >= 0.5:
                want[d, i] = round(share, 9)
    got = dc.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): round(r.score, 9) for r in got} == want and len(want) >= 7


def test_edited_copy_keeps_its_seeds_beside_many_exact_ones(spark):
    item = " ".join(f"word{i}" for i in range(30))
    edited = " ".join(w if i % 6 else "other" for i, w in enumerate(item.split()))
    docs = [(i, f"start {item} end") for i in range(200)] + [(500, edited), (501, "word1 word2 word3 word4")]
    found = dc.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r.doc_id for r in found} == {*range(200), 500}
    assert all((r.first_word, r.last_word) == (1, 30) for r in found if r.doc_id < 500)


def test_a_large_group_of_edited_copies_is_found_beside_one_exact_copy(spark):
    words = [f"word{i}" for i in range(48)]
    edited = " ".join("other" if i % 8 == 7 else w for i, w in enumerate(words))
    docs = [(i, f"start {edited} end") for i in range(300)] + [(500, " ".join(words)), (501, "word1 word2 word3 word4 and nothing else of it")]
    found = dc.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")).collect()
    assert {r.doc_id for r in found} == {*range(300), 500}
    assert {round(r.score, 9) for r in found if r.doc_id < 300} == {round(smith_waterman(words, edited.split()) / 96, 9)}


def test_places_taken_text_by_text_give_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(i, " ".join(["which", "of", "these", "is", "right"] + [f"w{i}x{k}" for k in range(8)])) for i in range(20)], "item_id long, text string")
    docs = items.selectExpr("item_id as doc_id", "concat(text, ' which of these is right ', text) as text").repartition(1)
    want = sorted(map(tuple, dc.leaks(docs, items).collect()))
    monkeypatch.setattr(dc, "PLACES", 3)
    assert len(want) == 20 and sorted(map(tuple, dc.leaks(docs, items).collect())) == want


def test_awkward_rows(spark):
    item = "a b c d e f g h"
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (None, item, 1.0), (3, item, 1.0), (3, item, 1.0), (4, "x " * 60000 + item, None)], "doc_id long, text string, score double")
    items = spark.createDataFrame([(7, item), (8, None), (None, item), (9, ""), (10, "a b")], "item_id long, text string")
    found = dc.leaks(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in found) == [(0, 7), (0, 10), (3, 7), (3, 7), (3, 10), (3, 10), (4, 7), (4, 10)]
    assert sorted(r.doc_id or 0 for r in dc.clean(docs, items).collect()) == [0, 1, 2]
    assert dc.leaks(docs.limit(0), items).count() == 0 and dc.leaks(docs, items.limit(0)).count() == 0
