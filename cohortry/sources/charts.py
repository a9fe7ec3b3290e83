"""Chart data as files, one JSON document for each key, put in place only when the whole job has succeeded."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from cohortry.sources import remote
from cohortry.sources.by_region import FileWriter, Written, register


def _plain(value):
    """Numbers that JSON does not have become null; times become text."""
    if isinstance(value, float) and (value != value or value in (float("inf"), float("-inf"))):
        return None
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return value.isoformat() if hasattr(value, "isoformat") else value


class ChartWriter(FileWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        super().__init__(options, overwrite)
        self.key = options["key"]

    def write(self, rows: Iterator) -> WriterCommitMessage:
        names, below = [], uuid.uuid4().hex
        for key, own in groupby((r.asDict(True) for r in rows), key=lambda r: r[self.key]):
            name = f"{quote(str(key), safe=' ')}.json"
            system, inside = remote.located(f"{self.scratch}/{below}/{name}")
            system.create_dir(inside.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(inside) as out:
                for i, record in enumerate(own):
                    record.pop(self.key)
                    out.write((("," if i else "[") + json.dumps(_plain(record), separators=(",", ":"))).encode())
                out.write(b"]\n")
            names.append(name)
        return Written(names, below)


class ChartSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "charts"

    def schema(self) -> str:
        raise ValueError("charts are only written")

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return ChartWriter(self.options, overwrite)


def write_charts(rows: DataFrame, folder: str, key: str, order: list[str], mode: str = "overwrite") -> None:
    """A file ``<key>.json`` for each value of ``key``: an array of that key's rows, by ``order``, as objects.

    Rows stream into their file. A file of the same name is replaced; with overwrite, files of keys that are no longer
    there go. Until the job has succeeded the folder is as it was. A null key is an error. NaN and infinities are null.
    """
    register(rows.sparkSession, ChartSource)
    checked = F.when(F.col(key).isNull(), F.raise_error(F.lit("a chart has no key")).cast("string")).otherwise(F.col(key).cast("string"))
    rows = rows.withColumn(key, checked)
    rows.repartition(F.col(key)).sortWithinPartitions(key, *order).write.format("charts").mode(mode).option("key", key).save(folder)
