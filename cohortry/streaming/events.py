"""Windows over event streams: counts by time, sessions, first occurrences and open commands of a ledger.

An addition to the batch operators. Each takes a streaming (or batch) table with an event time and returns a streaming one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", files: int = 1) -> DataFrame:
    """A stream of the files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(kind).load(folder)


def counts(events: DataFrame, key: str, time: str, window: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Events and mean value of each key in tumbling or sliding windows; events later than ``late`` are left out."""
    at = F.window(time, window, slide) if slide else F.window(time, window)
    out = events.withWatermark(time, late).groupBy(at.alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n", "mean_value")


def sessions(events: DataFrame, key: str, time: str, gap: str, late: str = "10 minutes") -> DataFrame:
    """Sessions of each key: events no further than ``gap`` apart."""
    out = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("s"), key).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("s.start").alias("start"), F.col("s.end").alias("end"), key, "n")


def first_only(events: DataFrame, keys: list[str], time: str, late: str = "10 minutes") -> DataFrame:
    """Each combination of keys once within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def open_commands(ledger: DataFrame) -> DataFrame:
    """Updates of ``command_id`` and ``open``: starts less finishes so far, kept as state."""

    def run(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        for part in parts:
            n += int((part["event"] == "start").sum() - (part["event"] == "finish").sum())
        state.update((n,))
        yield pd.DataFrame({"command_id": [key[0]], "open": [n]})

    return ledger.select("command_id", "event").groupBy("command_id").applyInPandasWithState(run, "command_id long, open long", "n long", "update", "NoTimeout")
