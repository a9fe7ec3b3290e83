"""Intermediate tables and shuffle files go once they are used."""

import os
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from cohortry.llm import common, simhash_dedup


@pytest.fixture
def folder(tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_folder", lambda spark: f"file://{tmp_path}")
    monkeypatch.setattr(cp, "shared_folder", lambda spark: f"file://{tmp_path}")
    return tmp_path


def shuffle_files(spark):
    tops = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {name for top in tops for _, _, names in os.walk(top.getPath()) for name in names if name.startswith("shuffle_")}


def test_materialise_leaves_no_shuffle_files(spark, folder):
    before, setting = shuffle_files(spark), spark.conf.get(common.CLEAN_UP, "false")
    got = common.materialise(spark.range(1000).groupBy(F.pmod("id", F.lit(7)).alias("k")).agg(F.count(F.lit(1)).alias("n")), "counts")
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and sum(r.n for r in got.collect()) == 1000 and spark.conf.get(common.CLEAN_UP, "false") == setting


def test_tables_go_with_their_block_and_stay_with_the_one_around_it(spark, folder):
    @common.passing()
    def inner():
        once = common.materialise(spark.range(5), "once")
        return common.materialise(once.where("id > 2"), "result", stays=True)

    with common.passing():
        assert [r.id for r in inner().collect()] == [3, 4]
        assert [p.name[:6] for p in folder.iterdir()] == ["result"]
    assert not list(folder.iterdir())
    assert inner().count() == 2 and [p.name[:6] for p in folder.iterdir()] == ["result"]
    with pytest.raises(ValueError, match="told"), common.passing():
        common.materialise(spark.range(5), "lost")
        raise ValueError("told")
    assert [p.name[:6] for p in folder.iterdir()] == ["result"]


def test_near_dedup_leaves_ids_only_in_the_shared_folder(spark, folder):
    words = [f"w{i}" for i in range(120)]
    rows = [(k, " ".join(f"new{k}" if i == 7 * k else w for i, w in enumerate(words))) for k in range(12)] + [(50, "another text " * 9), (None, None)]
    got = simhash_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), shingle=5, similarity=0.8)
    assert {r.doc_id for r in got.collect()} == {0, 50, None}
    assert [p.name.rsplit("-", 1)[0] for p in folder.iterdir()] == ["similar-documents"]
    assert spark.read.parquet(str(next(folder.iterdir()))).columns == ["doc_id", "component_id"]


def test_run_keeps_the_last_result_only(spark, folder, monkeypatch):
    drop = lambda n: lambda spark, docs, sf_dir: docs.where(F.col("doc_id") != n)
    monkeypatch.setattr(cp, "STAGES", [(f"stage{n}", drop(n)) for n in range(3)])
    got = cp.run(spark, "/root/testdata/sf0.001")
    assert got.where("doc_id < 3").count() == 0 and got.count() == common.table(spark, "/root/testdata/sf0.001", "documents").where("doc_id > 2").count()
    assert [p.name[:15] for p in folder.iterdir()] == ["pipeline-stage2"]
