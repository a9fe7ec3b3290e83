import pytest
from pyspark.sql import functions as F

from cohortry.streaming import events as ev

SF = "/root/testdata/sf0.001"


@pytest.fixture
def stream(spark, tmp_path):
    table = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    table.repartitionByRange(3, "ts").sortWithinPartitions("ts").write.parquet(f"{tmp_path}/in")
    return table, ev.read_events(spark, f"{tmp_path}/in", "event_id long, ts timestamp, user_id long, event_type string, value double, props string", files=10)


def drained(spark, df, name, mode):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return spark.table(name)


def test_windows_equal_the_batch_result(spark, stream):
    table, live = stream
    got = {tuple(r) for r in drained(spark, ev.counts(live, "event_type", "ts", "1 hour"), "w", "complete").select("start", "event_type", "n").collect()}
    assert got == {tuple(r) for r in ev.counts(table, "event_type", "ts", "1 hour").select("start", "event_type", "n").collect()}
    slid = drained(spark, ev.counts(live, "event_type", "ts", "2 hours", "1 hour"), "s", "complete")
    assert slid.groupBy().sum("n").first()[0] == 2 * table.count()


def test_sessions_and_first_only(spark, stream):
    table, live = stream
    assert drained(spark, ev.sessions(live, "user_id", "ts", "1 hour"), "g", "complete").groupBy().sum("n").first()[0] == table.count()
    assert drained(spark, ev.first_only(live, ["event_id"], "ts"), "d", "append").count() == table.select("event_id").distinct().count()


def test_open_commands(spark, tmp_path):
    rows = [("start", 1), ("start", 2), ("finish", 1), ("start", 3), ("start", 3)]
    spark.createDataFrame(rows, "event string, command_id long").coalesce(1).write.json(f"{tmp_path}/l")
    live = ev.read_events(spark, f"{tmp_path}/l", "event string, command_id long", "json")
    last = {r.command_id: r.open for r in drained(spark, ev.open_commands(live), "o", "update").collect()}
    assert last == {1: 0, 2: 1, 3: 2}
