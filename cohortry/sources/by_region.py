"""What readers of indexed genome files share: a region from options or filters, and files put in place when a job is done."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

from cohortry.sources import remote


def kinds_of(schema: str) -> dict[str, str]:
    return dict(c.split() for c in schema.split(", "))


class RegionReader(DataSourceReader):
    """A reader whose rows have ``chrom``, ``start`` and ``end``; it decodes the columns of the schema asked for and no others."""

    def __init__(self, known: str, schema: StructType, options: dict[str, str]):
        self.columns = [f.name for f in schema.fields]
        unknown = set(self.columns) - set(kinds_of(known))
        if unknown:
            raise ValueError(f"these files have no column {', '.join(sorted(unknown))}")
        self.path, self.split = options["path"], int(options.get("splitbytes", 64 << 20))
        self.chrom, self.low, self.high = options.get("chrom"), int(options.get("start", 0)), int(options.get("end", (1 << 31) - 1))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """A chromosome, an upper bound of ``start`` and a lower bound of ``end`` narrow the region; Spark tests all filters again."""
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name == "chrom" and isinstance(f, EqualTo) and self.chrom in (None, f.value):
                self.chrom = f.value
            elif name == "start" and isinstance(f, (LessThan, LessThanOrEqual)):
                self.high = min(self.high, f.value + isinstance(f, LessThanOrEqual))
            elif name == "end" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, f.value - isinstance(f, GreaterThanOrEqual))
            yield f


@dataclass
class Written(WriterCommitMessage):
    names: list[str]
    below: str = ""  # the task attempt's own folder within the job's


class FileWriter(DataSourceWriter):
    """Files that each task makes in a folder of the job's own; they move beside the others only when all tasks are done.

    A task that is run twice leaves two files there, and the message of one of them: the other goes with the folder.
    """

    suffix = ""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.scratch = f"{self.path}/_unfinished-{uuid.uuid4().hex}"

    def put(self, parts: dict[str, bytes], stem: str = "part") -> WriterCommitMessage:
        """Files by their endings, under one new name."""
        name = f"{stem}-{uuid.uuid4().hex}"
        for ending, data in parts.items():
            remote.put(f"{self.scratch}/{name}{ending}", data)
        return Written([name + ending for ending in parts])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        kept = [(message.below, name) for message in messages if message is not None for name in message.names]
        new = {f"{self.path}/{name}" for _, name in kept}
        old = [p for p in remote.files(self.path, "") if p not in new] if self.overwrite else []
        for below, name in kept:
            made = f"{self.scratch}/{below}/{name}" if below else f"{self.scratch}/{name}"
            remote.move(made, f"{self.path}/{name}")
        for path in old:
            remote.remove(path)
        remote.remove(self.scratch)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        remote.remove(self.scratch)


_KNOWN: set[tuple[str, str]] = set()
_ONE = threading.Lock()


def register(spark: SparkSession, source: type[DataSource]) -> None:
    """Makes a format known to a session, once, and lets filters reach it; formats are looked up in a thread's active session."""
    spark.createDataFrame([], "none int")  # makes this session the active one of the thread
    with _ONE:
        own = (spark._jsparkSession.sessionUUID(), source.name())
        if own not in _KNOWN:
            spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
            spark.dataSource.register(source)
            _KNOWN.add(own)


def tasks(spark: SparkSession) -> int:
    """Tasks for rows that are few but much work each: as many as a shuffle has, which Spark does not merge if they are asked for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def load(spark: SparkSession, source: type[DataSource], known: str, path: str, columns: Sequence[str], region: tuple[str, int, int] | None, split_bytes: int):
    """The wanted columns of a format, all by default, and of a region where one is given."""
    register(spark, source)
    kinds = kinds_of(known)
    reader = spark.read.format(source.name()).schema(", ".join(f"`{c}` {kinds[c]}" for c in columns or kinds)).option("splitBytes", split_bytes)
    if region is not None:
        reader = reader.option("chrom", region[0]).option("start", region[1]).option("end", region[2])
    return reader.load(path)
