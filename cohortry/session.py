"""Session factory used by tests and the bench; a cluster passes its own session instead."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """A local session with adaptive execution on and UTC time."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "*")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cohortry")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("COHORTRY_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``; a local session, as in tests, has a default."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file:///tmp/checkpoints"
    return folder.rstrip("/")


#: Rows that a task groups at a time where nearly each is a group of its own.
GROUPED_ROWS = 500_000


def spread(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df`` of about so many ``rows`` dealt out by ``keys`` in parts of bounded size, at least as many as a shuffle has."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // GROUPED_ROWS)), *keys)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what is read more than once is computed once, and its lineage ends."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
