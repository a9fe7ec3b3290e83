"""One row of figures for each sample out of all its logs and reports, and the figures of zipped read reports."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators.quality import true_mapped
from cohortry.sources import logs, remote

# fixed values: the modules of a read report by title, and the numbers of their outcomes
MODULES = {
    "Per base sequence quality": "base_quality",
    "Per sequence quality scores": "read_quality",
    "Per base sequence content": "base_content",
    "Per sequence GC content": "gc_content",
    "Per base N content": "n_content",
    "Sequence Length Distribution": "lengths",
    "Sequence Duplication Levels": "duplication",
    "Overrepresented sequences": "overrepresented",
    "Adapter Content": "adapters",
    "Per tile sequence quality": "tile_quality",
}
OUTCOMES = {"pass": 0, "warn": 1, "fail": 2}


def zipped_lines(files: DataFrame, member: str = "fastqc_data.txt") -> DataFrame:
    """``source`` and ``line`` of the first member so named of each zip file (path, content); a damaged file has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        name = next((n for n in z.namelist() if n.endswith(member)), None)
                        text = z.read(name).decode("utf-8", "replace") if name else ""
                except zipfile.BadZipFile:
                    continue
                found = text.splitlines()
                if found:
                    yield pd.DataFrame({"source": [path] * len(found), "line": found})

    return files.select("path", "content").mapInPandas(run, "source string, line string")


def read_reports(lines: DataFrame) -> DataFrame:
    """Figures of read reports (source, line): total_seqs, pct_gc, seq_length (the longest), pct_duplicates (what is left
    after deduplication, from 100), each module's outcome (0 passed, 1 warned, 2 failed) and ``pct_modules_failed``.

    A module without a known outcome failed. The deduplicated share counts with and without the mark of a comment.
    """
    get = lambda name, value=r"(\S+)": logs.captured(rf"^{name}\t\s*{value}\s*$")
    outcome = F.coalesce(*(F.when(F.lower(F.trim(F.element_at(F.split("line", "\t"), -1))) == s, n) for s, n in OUTCOMES.items()), F.lit(2))
    of = lambda title: F.max(F.when(F.col("line").startswith(f">>{title}"), F.when(F.contains("line", F.lit("\t")), outcome).otherwise(2)))
    out = lines.groupBy("source").agg(
        get("Total Sequences").alias("total_seqs"), get("%GC").alias("pct_gc"), get("Sequence length", r"(?:.*?)(\d+)").alias("seq_length"),
        F.bround(100 - get("#?Total Deduplicated Percentage"), 2).alias("pct_duplicates"), *(of(title).alias(name) for title, name in MODULES.items()),
    )
    known = F.array_compact(F.array(*MODULES.values()))
    failed = F.size(F.filter(known, lambda x: x == 2))
    return out.withColumn("pct_modules_failed", F.when(F.size(known) > 0, F.bround(100 * failed / F.size(known), 1)))


#: Kinds of logs: the ending of a file after the sample's name, and what makes figures of its lines.
LOGS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "trimming": ("_R1_trimming_report.txt", logs.trimming),
    "flagstat": (".bam.flagstat", logs.flagstat),
    "stats": (".bam.stats", logs.alignment_stats),
    "duplicates": (".markdup_metrics.txt", logs.duplicates),
}
REPORTS = "_R1_fastqc.zip"


def _sample(path: Column, ending: str) -> Column:
    name = F.element_at(F.split(path, "/"), -1)
    return F.substring(name, F.lit(1), F.length(name) - len(ending))


def figures(spark: SparkSession, folders: Mapping[str, str]) -> dict[str, DataFrame]:
    """A table of figures by ``sample`` for each kind of log or report whose folder is given and there."""
    found = {}
    for kind, folder in folders.items():
        if not remote.exists(folder, folder=True):
            continue
        if kind == "reports":
            files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{REPORTS}").load(folder)
            made = read_reports(zipped_lines(files).withColumn("source", _sample(F.col("source"), REPORTS)))
        else:
            ending, parse = LOGS[kind]
            lines = spark.read.schema("value string").option("pathGlobFilter", f"*{ending}").text(folder)
            made = parse(lines.select(_sample(F.col("_metadata.file_path"), ending).alias("source"), F.col("value").alias("line")))
        found[kind] = made.withColumnRenamed("source", "sample")
    return found


def quality_rows(samples: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``samples`` (sample and any other columns) with the figures of all tables by sample, each column under its table's name.

    A sample that a table does not have keeps its row, with nulls; a sample that a table has twice is an error. With
    trimming and flagstat figures there is ``mapped_pct``: the share of the reads that went into the alignment, at most
    100; where those are unknown, the alignment's own share.
    """
    out = samples
    for name, table in tables.items():
        own = [c for c in table.columns if c != "sample"]
        alone = table.groupBy("sample").agg(F.count(F.lit(1)).alias("__n"), *(F.first(c).alias(f"{name}_{c}") for c in own))
        checked = F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit(f"{name} has figures twice for "), "sample")).cast("string")).otherwise(F.col("sample"))
        out = out.join(alone.select(checked.alias("sample"), *(f"{name}_{c}" for c in own)), "sample", "left")
    if "trimming" in tables and "flagstat" in tables:
        named = out.withColumns({"r1_reads": F.col("trimming_total_reads"), "mapped": F.col("flagstat_mapped"), "tool_pct": F.col("flagstat_mapped_pct")})
        out = true_mapped(named).withColumn("mapped_pct", F.bround("mapped_pct", 3)).drop("r1_reads", "mapped", "tool_pct")
    return out


def scatter(coordinates: DataFrame, variance: DataFrame, configured: DataFrame) -> DataFrame:
    """Points of a scatter of the first two components: modality, trace, trace_ord, sample, x, y, x_label, y_label.

    ``coordinates`` has modality, ord (place in the file), sample, group, pc1, pc2; ``variance`` modality, pc, value;
    ``configured`` group, ord, sample, a row for each member, or one with a null sample. A configured group has the points
    of that group and of its members, in the order configured; groups that are not come after, in the order of the file.
    Shares of variance of at most 1 are fractions.
    """
    groups = configured.groupBy("group").agg(F.min("ord").alias("trace_ord")).withColumnRenamed("group", "trace")
    points = coordinates.select("modality", F.col("ord").alias("at"), "sample", F.col("group").alias("trace"), F.col("pc1").alias("x"), F.col("pc2").alias("y"))
    by_group = points.join(groups, "trace").select("modality", "trace", "trace_ord", "sample", "x", "y")
    members = configured.where("sample is not null").select("sample", F.col("group").alias("trace")).distinct().join(groups, "trace")
    by_member = points.drop("trace").join(members, "sample").select("modality", "trace", "trace_ord", "sample", "x", "y")
    others = points.join(groups, "trace", "left_anti")
    first = others.groupBy("modality", "trace").agg(F.min("at").alias("first"))
    last = groups.agg(F.coalesce(F.max("trace_ord") + 1, F.lit(0)).alias("last"))  # one row
    rest = others.join(first, ["modality", "trace"]).crossJoin(F.broadcast(last)).select("modality", "trace", (F.col("last") + F.col("first")).alias("trace_ord"), "sample", "x", "y")
    share = lambda n: F.max(F.when(F.col("pc") == n, F.col("value")))
    shares = variance.groupBy("modality").agg(share(1).alias("v1"), share(2).alias("v2"))
    percent = lambda n, v: F.concat(F.lit(f"PC{n} ("), F.format_string("%.1f", F.when(F.col("v1") <= 1, 100 * F.col(v)).otherwise(F.col(v))), F.lit("%)"))
    label = lambda n, v: F.when(F.col("v1").isNotNull() & F.col("v2").isNotNull() & (F.col(v) != 0), percent(n, v)).otherwise(f"PC{n}")
    every = by_group.union(by_member).distinct().union(rest)
    return every.join(shares, "modality", "left").select("modality", "trace", "trace_ord", "sample", "x", "y", label(1, "v1").alias("x_label"), label(2, "v2").alias("y_label"))
