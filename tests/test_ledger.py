"""The ledger takes each batch once, from batches and streams, whatever is run again and whoever else writes."""

import glob
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from cohortry.streaming import ledger

SCHEMA = "id long, event string, at timestamp"


def rows(spark, low, high):
    return spark.range(low, high).select("id", F.when(F.col("id") % 2 == 0, "start").alias("event"), F.timestamp_seconds(F.col("id")).alias("at"))


def ids(spark, path):
    return sorted(r.id for r in ledger.read_ledger(spark, path, SCHEMA).collect())


def test_a_batch_counts_once_and_writers_do_not_meet(spark, tmp_path):
    path = str(tmp_path / "l")
    assert ids(spark, path) == [] and ledger.batches(spark, path).count() == 0 and ledger.sweep(spark, path) == 0
    ledger.append(rows(spark, 0, 10), path, "a", "1")
    ledger.append(rows(spark, 0, 10), path, "a", "1")
    ledger.append(rows(spark, 10, 20), path, "b", "1")
    ledger.append(rows(spark, 0, 3), path, "b")
    assert ids(spark, path) == sorted([*range(20), 0, 1, 2])
    first = ledger.read_ledger(spark, path, SCHEMA).where("id = 3").first()
    assert (first.event, first.at.second, first.writer, first.batch) == (None, 3, "a", "1")
    assert {(r.writer, r.rows) for r in ledger.batches(spark, path).collect()} == {("a", 10), ("b", 10), ("b", 3)}
    line = json.loads(open(glob.glob(f"{path}/rows/*.json")[0]).readline())
    assert list(line) == ["at", "event", "id"]


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "l")
    threads = [threading.Thread(target=lambda i=i: ledger.append(rows(spark, 100 * i, 100 * i + 100), path, f"w{i}", "x")) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert ids(spark, path) == list(range(600))


def test_a_stream_that_runs_a_batch_again_adds_no_row(spark, tmp_path):
    source, path, checkpoint = str(tmp_path / "in"), str(tmp_path / "l"), str(tmp_path / "c")
    mirror = str(tmp_path / "m")
    for i in range(3):
        rows(spark, 10 * i, 10 * i + 10).coalesce(1).write.mode("append").json(source)
    def run(writer="stream"):
        live = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(source)
        query = ledger.start(live, path, writer, checkpoint if writer == "stream" else checkpoint + writer, [mirror], availableNow=True)
        assert query.awaitTermination(180)
    run()
    assert ids(spark, path) == ids(spark, mirror) == list(range(30))
    # the batch was written, but the stream did not get to note it; one mirror lacks it
    for name in ("2", ".2.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    os.remove(f"{mirror}/batches/stream/{2:012d}.json")
    run()
    assert ids(spark, path) == ids(spark, mirror) == list(range(30))
    run("second")
    assert ids(spark, path) == sorted([*range(30), *range(30)])


def test_unfinished_batches_do_not_count_and_can_be_swept(spark, tmp_path):
    path = str(tmp_path / "l")
    ledger.append(rows(spark, 0, 5), path, "a", "1")
    writer = ledger.LedgerWriter({"path": path, "writer": "a"})
    lost = writer.write(rows(spark, 5, 9).toLocalIterator())  # the task ended, the batch did not
    assert lost.rows == 4 and ids(spark, path) == list(range(5))
    assert ledger.sweep(spark, path) == 0 and ledger.sweep(spark, path, older_than=-5) == 1
    assert ids(spark, path) == list(range(5)) and len(glob.glob(f"{path}/rows/*.json")) == ledger.batches(spark, path).select(F.explode("files")).count()
    failing = rows(spark, 0, 9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        ledger.append(failing, path, "a", "2")
    assert ids(spark, path) == list(range(5)) and ledger.batches(spark, path).count() == 1


def test_what_a_ledger_refuses(spark, tmp_path):
    ledger.append(rows(spark, 0, 1), str(tmp_path / "first"), "a")
    for change in (lambda w: w.mode("overwrite").option("writer", "a"), lambda w: w.mode("append")):
        with pytest.raises(Exception, match="only appended to|name of its own"):
            change(rows(spark, 0, 1).write.format("ledger")).save(str(tmp_path / "l"))
