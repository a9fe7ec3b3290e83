import itertools
import re

import duckdb
import numpy as np
import pandas as pd

from cohortry.llm import filter_audit
from cohortry.llm.queries import ORACLE_SQL
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, part string, mask string, n int"
LABELS = "doc_id long, quality int, toxic int, n string"
FINE = " ".join(f"word{i}" for i in range(120))
ROWS = [
    (1, FINE, "en", "p", "m", 0), (2, FINE, "de", "p", "m", 0), (3, FINE, None, "p", "m", 0), (0, FINE + " ", "en", "p", "m", 0),
    (4, None, "en", "p", "m", 0), (5, "", "", "p", "m", 0), (6, "A B C", None, "p", "m", 0), (7, "same " * 200, "en", "p", "m", 0),
    (8, " ".join(f"WORD{i}" for i in range(120)), "en", "p", "m", 0), (9, FINE + " $", "de", "p", "m", 0), (10, "a\xa0b " * 100, "fr", "p", "m", 0),
    (11, "\n\t\x0b\x0c\r " * 5, "fr", "p", "m", 0), (12, " ".join(f"w{i}" for i in range(80)) + " w1" * 20, "en", "p", "m", 0), (13, "É" * 30 + " È" * 120, "en", "p", "m", 0),
    (2, FINE, "de", "p", "m", 0), (None, FINE, "en", "p", "m", 0), (None, "only null ids", "en", "p", "m", 0), (14, "x" * 200_000 + "#", "en", "p", "m", 0),
]
MARKS = [(1, 1, 0, "n"), (2, 1, 1, "n"), (2, 0, 1, "n"), (7, None, 1, "n"), (9, 0, None, "n"), (8, 1, 1, "n"), (99, 1, 1, "n"), (None, 1, 1, "n")]


def plain(rows, labels):
    """Every order of the filters applied to every document in turn."""
    fails, quality, toxic = [], {i for i, q, _, _ in labels if q == 1}, {i for i, _, t, _ in labels if t == 1}
    for i, text, lang, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        ids = [j for j, t, *_ in rows if (t or "") == text and j is not None]
        own = "A" * (len(words) < 100) + "B" * (100 * len(set(words)) < 80 * len(words)) + "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text))
        own += "D" * bool(re.search("[#$%&*|]", text)) + "E" * (any(j < i for j in ids) if i is not None else bool(ids))
        fails.append((lang or "", set(own), i is not None and i in quality, i is not None and i in toxic))
    out, shapley = [], {}
    for part in {f[0] for f in fails}:
        for order in itertools.permutations("ABCDE"):
            left, gone = [f for f in fails if f[0] == part], []
            for step, letter in enumerate(order, 1):
                removed = [f for f in left if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                redundant = sum(letter in f[1] for f in gone)
                unique = sum(f[1] == {letter} for f in fails if f[0] == part)
                gone += removed
                shapley[part, letter] = shapley.get((part, letter), 0) + len(removed)
                out.append((part, "".join(order), step, len(left), len(removed), redundant, unique, sum(f[2] for f in removed), sum(f[3] for f in removed)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def listed(df):
    return sorted(map(tuple, df.collect()))


def test_matches_every_order_applied_in_turn_and_the_sql(spark):
    docs, labels = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(MARKS, LABELS)
    got = filter_audit.audit(docs, labels)
    want = plain(ROWS, MARKS)
    assert listed(got) == want
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    con.register("labels", labels.toPandas().astype({"doc_id": "Int64", "quality": "Int64", "toxic": "Int64"}))
    assert sorted(con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['op13_filter_audit']})").fetchall()) == want


def test_every_order_is_met_once_by_swaps_of_neighbours():
    for n in range(1, 7):
        order, met = list(range(n)), []
        for place in itertools.chain([None], filter_audit.plain_changes(n)):
            if place is not None:
                order[place], order[place + 1] = order[place + 1], order[place]
            met.append(tuple(order))
        assert sorted(met) == sorted(itertools.permutations(range(n)))


def test_walk_over_many_parts_equals_counting_anew():
    counts = np.random.default_rng(1).integers(0, 50, (5, 3, 16))
    out = filter_audit.walked([f"p{i}" for i in range(5)], counts, "WXYZ")
    assert len(out) == 5 * 24 * 4
    for row in out.sample(60, random_state=2).itertuples():
        own, earlier = 1 << "WXYZ".index(row.filter_order[row.step - 1]), sum(1 << "WXYZ".index(f) for f in row.filter_order[: row.step - 1])
        cell = counts[int(row.part[1:])]
        new = [m for m in range(16) if m & own and not m & earlier]
        assert (row.removed, row.good_lost, row.toxic_lost) == tuple(cell[k][new].sum() for k in range(3))
    # what all filters remove of a part, averaged over the orders, is what fails any
    total = out.drop_duplicates(["part", "step", "shapley"]).loc[lambda d: d["filter_order"] == "WXYZ"].groupby("part")["shapley"].sum()
    assert total.tolist() == [24 * c[0][1:].sum() for c in counts]


def test_many_copies_and_many_parts(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(FINE).alias("text"), (F.col("id") % 150).cast("string").alias("lang"))
    out = filter_audit.audit(docs, spark.createDataFrame(MARKS, LABELS)).where("filter_order = 'EABCD' and step = 1").toPandas()
    assert len(out) == 150 and out["removed"].sum() == 2999 and out.set_index("part")["removed"]["0"] == 19


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs, labels).collect() == []
    out = filter_audit.audit(spark.createDataFrame(ROWS, SCHEMA), labels).toPandas()
    assert out["good_lost"].sum() == 0 and set(out["part"]) == {"en", "de", "fr", ""} and isinstance(out, pd.DataFrame)
