"""Readers and parsers callable from SQL: table functions over any table, and files by kind as views."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, udtf
from pyspark.sql.types import StructField, StructType

from cohortry.sources import alignments, signals, text_tables


def _column(table: AnalyzeArgument, name: str) -> StructField:
    found = next((f for f in table.dataType.fields if f.name.lower() == name.lower()), None)
    if found is None:
        raise ValueError(f"the table has no column {name}")
    return found


@udtf
class MetricsBlock:
    """``metrics_block(TABLE(lines), first_column)``: source, metric, value of a header line and the line below it.

    The table has source, line_no and line; the function asks Spark to deal it out by source and order it by line_no
    itself. ``source`` has the type that it has in the table.
    """

    def __init__(self):
        self.head = None

    @staticmethod
    def analyze(lines: AnalyzeArgument, first_column: AnalyzeArgument) -> AnalyzeResult:
        source = _column(lines, "source")
        _column(lines, "line_no"), _column(lines, "line")
        schema = StructType([StructField("source", source.dataType)]).add("metric", "string").add("value", "string")
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn("source")], orderBy=[OrderingColumn("line_no")])

    def eval(self, row, first_column: str) -> Iterator[tuple]:
        line = row["line"]
        head, self.head = self.head, line if line is not None and line.startswith(first_column) else None
        if head is not None and line is not None:
            names, values = head.split("\t"), line.split("\t")
            for i in range(max(len(names), len(values))):
                yield row["source"], names[i] if i < len(names) else None, values[i] if i < len(values) else None


@udtf
class Unpivot:
    """``matrix_long(TABLE(wide), key)``: the key, ``name`` and ``value`` (double) of every other column of any table.

    The columns that are numbers are found from the table's own schema when the query is analysed.
    """

    @staticmethod
    def analyze(wide: AnalyzeArgument, key: AnalyzeArgument) -> AnalyzeResult:
        if key.value is None:
            raise ValueError("the key's name must be a constant")
        own = _column(wide, key.value)
        return AnalyzeResult(StructType([StructField(own.name, own.dataType)]).add("name", "string").add("value", "double"))

    def eval(self, row, key: str) -> Iterator[tuple]:
        own = next(c for c in row.asDict() if c.lower() == key.lower())
        for name, value in row.asDict().items():
            if name != own and isinstance(value, (int, float)) and not isinstance(value, bool):
                yield row[own], name, float(value)


#: Readers of (spark, path) by kind of file.
READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bed": text_tables.read_bed,
    "bedgraph": text_tables.read_bedgraph,
    "chrom_sizes": text_tables.read_chrom_sizes,
    "kmers": text_tables.read_kmers,
    "region_calls": text_tables.read_region_calls,
    "occupancy": text_tables.read_occupancy,
    "protection": text_tables.read_protection,
    "fragment_sizes": text_tables.read_fragment_sizes,
    "sample_sheet": text_tables.read_sample_sheet,
    "manifest": text_tables.read_manifest,
    "alignments": alignments.read_alignments,
    "signals": signals.read_signal,
    "parquet": lambda spark, path: spark.read.parquet(path),
}


def add_reader(kind: str, reader: Callable[[SparkSession, str], DataFrame]) -> None:
    """Makes a further kind of file known; a kind that is known already is an error."""
    if kind in READERS:
        raise ValueError(f"files of kind {kind} have a reader")
    READERS[kind] = reader


def views(spark: SparkSession, files: Mapping[str, tuple[str, str]]) -> None:
    """Temporary views by name, each of a (kind, path); an unknown kind is an error before any view is made."""
    unknown = sorted({kind for kind, _ in files.values()} - set(READERS))
    if unknown:
        raise ValueError(f"no reader for {', '.join(unknown)}; there are {', '.join(sorted(READERS))}")
    for name, (kind, path) in files.items():
        READERS[kind](spark, path).createOrReplaceTempView(name)


def register(spark: SparkSession) -> None:
    """Makes the table functions callable from SQL."""
    spark.udtf.register("metrics_block", MetricsBlock)
    spark.udtf.register("matrix_long", Unpivot)
