import duckdb
import pandas as pd

from cohortry.llm import line_dedup
from cohortry.llm.queries import OP7_SQL
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, n_lines int, key string"
LONG = "This line is long enough to count"


def test_matches_sql_on_awkward_rows(spark):
    rows = [
        (1, f"{LONG}\nshort\n{LONG} ", 7, "x"), (2, f"\t{LONG.upper()}\nonly here", 7, None), (3, LONG, None, "x"), (4, None, 1, "x"), (5, "", 1, "x"),
        (6, "\n\n" + "É" * 25 + "\n" + "long " * 30000, 1, "x"), (7, "é" * 25, 1, "x"), (8, "É" * 25 + "\r", 1, "x"), (9, "É" * 25, 1, "x"), (10, f"{LONG}\n" * 70, 0, "x"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")).toPandas()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "n_lines", "key"]))
    want = con.execute(OP7_SQL).df()
    by = lambda df: df[["doc_id", "n_lines", "n_dropped", "kept_sha256"]].sort_values("doc_id").values.tolist()
    assert by(got) == by(want)


def test_hot_key_is_dealt_over_ranges_and_keeps_its_largest(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(LONG).alias("text"))
    marks = line_dedup.drop_bitmaps(docs, rows_per_range=100)
    assert marks.count() == 2999 and marks.where("doc_id = 2999").count() == 0


def test_empty_table_null_ids_and_repeated_rows(spark):
    assert line_dedup.drop_bitmaps(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([(None, LONG), (None, LONG), (None, LONG)], "doc_id long, text string")
    assert line_dedup.drop_bitmaps(docs).count() == 0
    docs = spark.createDataFrame([(1, LONG), (1, LONG), (2, LONG), (None, LONG)], "doc_id long, text string")
    out = line_dedup.dedup_lines(docs).select("doc_id", "n_dropped").collect()
    assert sorted((r[0] or 0, r[1]) for r in out) == [(0, 1), (1, 1), (1, 1), (2, 0)]


def test_far_apart_lines_of_a_long_text_and_clashing_names(spark):
    lines = [f"line {i}" for i in range(1000)]
    lines[200] = lines[999] = LONG
    rows = [(1, "\n".join(lines), 1, 2, 3), (2, LONG, 1, 2, 3), (3, LONG, 1, 2, 3)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, mark int, MARK_ int, __id int"))
    kept = {r.doc_id: r for r in out.collect()}
    assert kept[1].kept_text == "\n".join(x for x in lines if x != LONG) and kept[1].n_dropped == 2 and (kept[1].mark, kept[1]["__id"]) == (1, 3)
    assert [w.word for w in kept[1].drop_words] == [3, 15]
