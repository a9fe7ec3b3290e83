"""Runs pick up what earlier ones kept; charts appear whole or not at all; table functions equal the DataFrame forms."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cohortry.plans.stages import Results, Stage, run
from cohortry.sources import charts, logs, table_functions

CALLS = []


def doubled(spark, given, options):
    CALLS.append("doubled")
    return given["numbers"].select((F.col("x") * options["by"]).alias("x"))


def total(spark, given, options):
    CALLS.append("total")
    return given["doubled"].agg(F.sum("x").alias("total"))


def listed(spark, given, options):
    CALLS.append("listed")
    return given["others"].select("y")


def failing(spark, given, options):
    return given["doubled"].select(F.raise_error(F.lit("not today")).alias("x"))


def test_only_what_changed_is_made_again(spark, tmp_path):
    folder, numbers, others = (str(tmp_path / n) for n in ("kept", "numbers", "others"))
    spark.range(5).select(F.col("id").alias("x")).write.parquet(numbers)
    spark.range(3).select(F.col("id").alias("y")).write.parquet(others)
    inputs = {"numbers": numbers, "others": others}
    stages = lambda by=2: {"doubled": Stage(doubled, ["numbers"], {"by": by}), "total": Stage(total, ["doubled"]), "listed": Stage(listed, ["others"])}
    go = lambda by=2, **more: run(spark, folder, stages(by), inputs, ["total", "listed"], **more)
    first = go()
    assert first.made == ["doubled", "total", "listed"] and first.tables["total"].first().total == 20
    CALLS.clear()
    again = go()
    assert again.made == CALLS == [] and again.names == first.names and again.tables["total"].first().total == 20
    spark.range(5, 6).select(F.col("id").alias("x")).write.mode("append").parquet(numbers)
    third = go()
    assert third.made == ["doubled", "total"] and third.tables["total"].first().total == 30
    assert go(by=3).made == ["doubled", "total"]
    # results of earlier inputs and options are still there until a run tidies up
    assert go().made == [] and len(Results(spark, folder).names()) == 7
    assert go(tidy=True).made == [] and len(Results(spark, folder).names()) == len(os.listdir(f"{folder}/results")) == 3
    assert go(by=3).made == ["doubled", "total"]


def test_a_failed_stage_is_where_the_next_run_begins(spark, tmp_path):
    spark.range(5).select(F.col("id").alias("x")).write.parquet(str(tmp_path / "n"))
    inputs, folder = {"numbers": str(tmp_path / "n")}, str(tmp_path / "kept")
    stages = {"doubled": Stage(doubled, ["numbers"], {"by": 2}), "last": Stage(failing, ["doubled"])}
    with pytest.raises(Exception, match="not today"):
        run(spark, folder, stages, inputs, ["last"])
    assert len(Results(spark, folder).names()) == 1
    stages["last"] = Stage(total, ["doubled"])
    assert run(spark, folder, stages, inputs, ["last"]).made == ["last"]
    with pytest.raises(ValueError, match="unknown stage"):
        run(spark, folder, stages, inputs, ["nothing"])
    with pytest.raises(ValueError, match="cycle"):
        run(spark, folder, {"a": Stage(total, ["b"]), "b": Stage(total, ["a"])}, {}, ["a"])


def test_charts_are_whole_or_not_there(spark, tmp_path):
    folder = str(tmp_path / "charts")
    rows = spark.range(100).select(F.concat(F.lit("plot/"), F.col("id") % 3).alias("key"), (99 - F.col("id")).alias("x"), F.when(F.col("id") == 5, F.lit(float("nan"))).otherwise(F.col("id") / 2).alias("y"), F.timestamp_seconds(F.col("id")).alias("t"))
    charts.write_charts(rows, folder, "key", ["x"])
    assert sorted(os.listdir(folder)) == ["plot%2F0.json", "plot%2F1.json", "plot%2F2.json"]
    two = json.load(open(f"{folder}/plot%2F2.json"))
    assert [r["x"] for r in two] == sorted(99 - i for i in range(100) if i % 3 == 2) and two[-2] == {"x": 94, "y": None, "t": "1970-01-01T00:00:05"} and len(two) == 33
    bad = rows.withColumn("y", F.when(F.col("x") == 0, F.raise_error(F.lit("half way")).cast("double")).otherwise(F.lit(7.0)))
    with pytest.raises(Exception, match="half way"):
        charts.write_charts(bad, folder, "key", ["x"])
    assert json.load(open(f"{folder}/plot%2F2.json")) == two and len(os.listdir(folder)) == 3
    charts.write_charts(rows.where("key = 'plot/1'"), folder, "key", ["x"])
    assert os.listdir(folder) == ["plot%2F1.json"]
    with pytest.raises(Exception, match="no key"):
        charts.write_charts(rows.withColumn("key", F.lit(None).cast("string")), folder, "key", ["x"])


def test_table_functions_equal_the_data_frame_forms(spark):
    table_functions.register(spark)
    lines = [(s, i, x) for s in (1, 2) for i, x in enumerate(["#c", "BAIT\tMEAN", f"p\t{s}.5", "", "BAIT\tLONG\tMORE", "q", "BAIT"])]
    frame = spark.createDataFrame(lines, "source int, line_no int, line string").repartition(5)
    frame.createOrReplaceTempView("log_lines")
    got = spark.sql("SELECT * FROM metrics_block(TABLE(log_lines), 'BAIT')")
    want = [tuple(r) for r in logs.metrics_block(frame, "BAIT").collect() if r.source is not None]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want)) and dict(got.dtypes) == {"source": "int", "metric": "string", "value": "string"}
    with pytest.raises(Exception, match="no column line"):
        spark.sql("SELECT * FROM metrics_block(TABLE(SELECT 1 AS source, 2 AS line_no), 'x')").collect()
    spark.createDataFrame([("f", 1, 2.5, "t"), ("g", None, 3.5, "t")], "Feature string, a int, b double, note string").createOrReplaceTempView("wide")
    got = spark.sql("SELECT * FROM matrix_long(TABLE(wide), 'feature')")
    assert got.columns == ["Feature", "name", "value"] and sorted(map(tuple, got.collect())) == [("f", "a", 1.0), ("f", "b", 2.5), ("g", "b", 3.5)]


def test_files_by_kind_as_views(spark, tmp_path):
    (tmp_path / "a.bed").write_text("chr1\t0\t15\tx\n")
    table_functions.views(spark, {"regions": ("bed", str(tmp_path / "a.bed"))})
    assert spark.sql("SELECT sum(end - start) FROM regions").first()[0] == 15
    with pytest.raises(ValueError, match="no reader for nope"):
        table_functions.views(spark, {"x": ("nope", "y")})
    with pytest.raises(ValueError, match="have a reader"):
        table_functions.add_reader("bed", None)
