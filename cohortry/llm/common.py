"""Reading tables, shared storage and slicing of text batches for the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step handles at a time; it bounds the memory of a Python worker.
SLICE_BYTES = 500_000
#: Rows of a few numbers that a file of an intermediate table takes at least, where their number is known.
ROWS_A_FILE = 100_000
#: Whether Spark removes the shuffle files of an action when it ends; else they stay until the driver happens to collect its garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: For each block of :func:`passing` around a call, the tables that go with it.
_PASSING: ContextVar[tuple[list[tuple[SparkSession, str]], ...]] = ContextVar("passing", default=())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, as in tests, gets a default.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file:///tmp/checkpoints"
    return folder.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """The folder ``path``, in whatever store it is, is no longer there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def passing() -> Iterator[None]:
    """What :func:`materialise` writes inside is removed when the block ends (a decorator's block is a call), but for tables that stay.

    What leaves the block must not read the removed tables any more: it is a table that stays, or no table.
    """
    token = _PASSING.set((*_PASSING.get(), []))
    try:
        yield
    finally:
        written = _PASSING.get()[-1]
        _PASSING.reset(token)
        for spark, path in written:
            with suppress(Exception):  # an intermediate table that can't be removed spoils no result
                remove(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside are removed as soon as it ends."""
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def materialise(df: DataFrame, name: str, rows: int | None = None, stays: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage is cut, and a lost executor loses nothing.

    Where the number of rows is about known, no more files are written than they fill. Shuffle files of the write are removed
    when it ends; the table goes with the block of :func:`passing` it is written in, or if it ``stays`` with the block around that.
    """
    if rows is not None:
        df = df.coalesce(1 + rows // ROWS_A_FILE)
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for goes in _PASSING.get()[: -1 if stays else None][-1:]:
        goes.append((spark, path))
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns ``doc_id`` and ``text`` only, a null text as an empty one; further columns are left behind."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of that name, upper and lower case alike."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``limit`` bytes of ``column``; a single longer text is a piece of its own."""
    if batch.num_rows == 0:
        return
    ends = offsets(batch.column(column))[1:]
    start, base = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        base, start = int(ends[stop - 1]), stop


def offsets(column: pa.Array) -> np.ndarray:
    """Byte offsets of a string column, starting at 0."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    found = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return found - found[0]


def raw_bytes(column: pa.Array) -> np.ndarray:
    """The UTF-8 bytes of a string column without nulls, one text after the other."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or ends[0] == ends[-1]:
        return np.zeros(0, np.uint8)
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[int(ends[0]) : int(ends[-1])]


def out_batch(**columns) -> pa.RecordBatch:
    """A record batch of the given columns, in order."""
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))
