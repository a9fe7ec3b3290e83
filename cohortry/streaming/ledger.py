"""An append-only ledger of JSON lines that batches and streams write, each batch once.

A task writes its lines to a file of its own below ``rows/``. When all tasks of a batch are done, one small file below
``batches/<writer>/`` names them; only lines of files that are named so count. A batch that comes again finds its name
taken and adds nothing, and writers never touch each other's files, so none waits for a lock and none loses a line.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cohortry.sources import remote
from cohortry.sources.by_region import register


@dataclass
class Lines(WriterCommitMessage):
    name: str
    rows: int


class LedgerWriter(DataSourceStreamWriter, DataSourceWriter):
    """Writes to the ledger and to its mirrors; each of them takes a batch as a whole or not at all."""

    def __init__(self, options: dict[str, str]):
        if not options.get("writer"):
            raise ValueError("a ledger's writer has a name of its own: option writer")
        self.places = [p.rstrip("/") for p in dict.fromkeys([options["path"], *json.loads(options.get("mirrors", "[]"))])]
        self.writer, self.batch = options["writer"], options.get("batch", uuid.uuid4().hex)

    def write(self, rows: Iterator) -> WriterCommitMessage:
        lines = [json.dumps(r.asDict(True), sort_keys=True, separators=(",", ":"), default=lambda v: v.isoformat()) for r in rows]
        name = f"part-{uuid.uuid4().hex}.json"
        if lines:
            for place in self.places:
                remote.put(f"{place}/rows/{name}", ("\n".join(lines) + "\n").encode())
        return Lines(name, len(lines))

    def _name(self, messages: Sequence[WriterCommitMessage | None], batch: str) -> None:
        named = [m for m in messages if m is not None and m.rows]
        for place in self.places:
            target = f"{place}/batches/{self.writer}/{batch}.json"
            if remote.exists(target):
                self._drop(named, [place])
                continue
            body = {"batch": batch, "files": [m.name for m in named], "rows": sum(m.rows for m in named), "writer": self.writer}
            unnamed = f"{place}/batches/{self.writer}/_{batch}-{uuid.uuid4().hex}"
            remote.put(unnamed, json.dumps(body, sort_keys=True).encode())
            remote.move(unnamed, target)

    def _drop(self, messages: Sequence[WriterCommitMessage | None], places: Sequence[str]) -> None:
        for place in places:
            for m in messages:
                if m is not None:
                    remote.remove(f"{place}/rows/{m.name}")

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int | None = None) -> None:  # noqa: N803  the name Spark calls it by
        self._name(messages, self.batch if batchId is None else f"{batchId:012d}")

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int | None = None) -> None:  # noqa: N803
        self._drop(messages, self.places)


class LedgerSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ledger"

    def schema(self) -> str:
        raise ValueError("a ledger is read by read_ledger")

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("a ledger is only appended to")
        return LedgerWriter(self.options)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:  # noqa: N802  the name Spark calls it by
        return LedgerWriter(self.options)


def append(rows: DataFrame, path: str, writer: str, batch: str | None = None, mirrors: Sequence[str] = ()) -> None:
    """Adds ``rows`` to the ledger and its mirrors as one batch; a batch of a name that the writer has used adds nothing."""
    register(rows.sparkSession, LedgerSource)
    out = rows.write.format("ledger").mode("append").option("writer", writer).option("mirrors", json.dumps(list(mirrors)))
    (out.option("batch", batch) if batch else out).save(path)


def start(rows: DataFrame, path: str, writer: str, checkpoint: str, mirrors: Sequence[str] = (), **trigger) -> StreamingQuery:
    """Adds a stream to the ledger, its batches by number: one that is run again after a failure adds nothing.

    ``writer`` belongs to one stream and its checkpoint. ``trigger`` is passed on to Spark.
    """
    register(rows.sparkSession, LedgerSource)
    out = rows.writeStream.format("ledger").outputMode("append").option("writer", writer).option("mirrors", json.dumps(list(mirrors))).option("checkpointLocation", checkpoint)
    return (out.trigger(**trigger) if trigger else out).start(path)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """writer, batch, rows, files of every batch in the ledger."""
    schema = "writer string, batch string, rows long, files array<string>"
    if not remote.exists(f"{path.rstrip('/')}/batches", folder=True):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(f"{path.rstrip('/')}/batches")


def read_ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of the ledger, with ``writer`` and ``batch`` beside their own columns; a ledger not yet begun has none."""
    named = batches(spark, path).select("writer", "batch", F.explode("files").alias("__file"))
    if not remote.exists(f"{path.rstrip('/')}/rows", folder=True):
        return spark.createDataFrame([], schema).withColumns({"writer": F.lit(""), "batch": F.lit("")})
    rows = spark.read.schema(schema).json(f"{path.rstrip('/')}/rows").withColumn("__file", F.col("_metadata.file_name"))
    return rows.join(named, "__file").drop("__file")


def sweep(spark: SparkSession, path: str, older_than: float = 86_400.0) -> int:
    """Deletes files of rows that no batch names and that were last changed so many seconds ago; says how many."""
    root = path.rstrip("/")
    if not remote.exists(f"{root}/rows", folder=True):
        return 0
    listed = spark.read.format("binaryFile").load(f"{root}/rows").select(F.element_at(F.split("path", "/"), -1).alias("file"), F.unix_timestamp("modificationTime").alias("at"))
    loose = listed.where(F.col("at") <= time.time() - older_than).join(batches(spark, path).select(F.explode("files").alias("file")), "file", "left_anti")

    def delete(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name in part["file"]:
                remote.remove(f"{root}/rows/{name}")
            yield pd.DataFrame({"n": [len(part)]})

    return loose.select("file").mapInPandas(delete, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
