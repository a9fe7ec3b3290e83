"""Readers of delimited tables with explicit schemas, and writers. NaN and NA come in as null; malformed rows raise or drop as stated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def resolve_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """The first candidate among the columns, letter case aside."""
    lower = {c.lower(): c for c in columns}
    return next((lower[c.lower()] for c in candidates if c.lower() in lower), None)


def _clean(df: DataFrame) -> DataFrame:
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.select(*(F.when(~F.isnan(c), F.col(c)).alias(c) if c in doubles else F.col(c) for c in df.columns))


def _csv(spark: SparkSession, path: str, schema: str, sep: str = "\t", header: bool = False, mode: str = "FAILFAST", comment: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema).option("sep", sep).option("header", header).option("nullValue", "NA").option("nanValue", "NaN").option("mode", mode).option("enforceSchema", True)
    if comment:
        reader = reader.option("comment", comment)
    return _clean(reader.csv(path))


def read_matrix(spark: SparkSession, path: str, samples: Sequence[str], feature: str = "feature") -> DataFrame:
    """A features-by-samples table with a header; comma-separated if named .csv, else by tabs."""
    fields = ", ".join([f"`{feature}` string", *(f"`{s}` double" for s in samples)])
    return _csv(spark, path, fields, "," if path.endswith(".csv") else "\t", header=True)


def read_protection(spark: SparkSession, path: str) -> DataFrame:
    """``feature`` (chrom:start-end) and ``value`` (the mean score) of a protection score table by tabs with the header chr, start, end, WPS, mean_WPS."""
    rows = _csv(spark, path, "chr string, start long, end long, WPS string, mean_WPS double", "\t", header=True)
    return rows.select(F.format_string("%s:%d-%d", "chr", "start", "end").alias("feature"), F.col("mean_WPS").alias("value"))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end, name of a headerless table; a missing name is chrom:start-end. An invalid interval raises on use."""
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^(#|track|browser)") & (F.trim("value") != ""))
    f = F.split("value", "\t")
    start, end = F.expr("try_cast(get(f, 1) as bigint)"), F.expr("try_cast(get(f, 2) as bigint)")
    rows = lines.select(f.alias("f"), "value").select(F.get("f", F.lit(0)).alias("chrom"), start.alias("start"), end.alias("end"), F.get("f", F.lit(3)).alias("name"), "value")
    bad = F.col("start").isNull() | F.col("end").isNull() | (F.col("start") < 0) | (F.col("end") <= F.col("start"))
    checked = F.when(bad, F.raise_error(F.concat(F.lit("invalid interval: "), "value")).cast("bigint")).otherwise(F.col("start"))
    fallback = F.format_string("%s:%d-%d", "chrom", "start", "end")
    return rows.select("chrom", checked.alias("start"), "end", F.coalesce(F.nullif(F.trim("name"), F.lit("")), fallback).alias("name"))


def read_bedgraph(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """chrom, start, end, value, and m, u where there are six columns; track and comment lines are skipped.

    Strict: a line of fewer than four fields raises on use; else such lines and unreadable numbers are dropped.
    """
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^(#|track|browser)") & (F.trim("value") != "")).withColumnRenamed("value", "line")
    rows = lines.select("line", F.split("line", r"\s+").alias("f"))
    number = lambda i, kind: F.expr(f"try_cast(get(f, {i}) as {kind})")
    out = rows.select(F.get("f", F.lit(0)).alias("chrom"), number(1, "bigint").alias("start"), number(2, "bigint").alias("end"), number(3, "double").alias("value"), number(4, "double").alias("m"), number(5, "double").alias("u"), "line", F.size("f").alias("n"))
    if strict:
        start = F.when(F.col("n") < 4, F.raise_error(F.concat(F.lit("fewer than four fields: "), "line")).cast("bigint")).otherwise(F.col("start"))
        return _clean(out.select("chrom", start.alias("start"), "end", "value", "m", "u"))
    return _clean(out.where("n >= 4 and start is not null and end is not null and value is not null").select("chrom", "start", "end", "value", "m", "u"))


def read_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    """chrom, length of the first two columns of a sizes or index file; a repeated contig or a length under 1 raises."""
    rows = spark.read.text(path).where(F.trim("value") != "").select(F.split("value", "\t").alias("f")).select(F.get("f", F.lit(0)).alias("chrom"), F.expr("try_cast(get(f, 1) as bigint)").alias("length"))
    per = rows.groupBy("chrom").agg(F.count(F.lit(1)).alias("n"), F.min("length").alias("length"), F.count("length").alias("known"))
    bad = (F.col("n") > 1) | (F.col("known") < F.col("n")) | (F.col("length") < 1)
    return per.select("chrom", F.when(bad, F.raise_error(F.concat(F.lit("invalid contig: "), "chrom")).cast("bigint")).otherwise(F.col("length")).alias("length"))


def read_bins(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """contig, start, stop, arm, ratio of a table whose header begins with ``#``; ``columns`` are its names in order.

    The stop column may be named stop or end; a corrected ratio is taken where there is one; no arm gives null.
    """
    names = [c.lstrip("#") for c in columns]
    kinds = {"contig": "string", "start": "bigint", "stop": "bigint", "end": "bigint", "arm": "string"}
    df = _csv(spark, path, ", ".join(f"`{n}` {kinds.get(n, 'double')}" for n in names), header=True)
    stop, ratio = resolve_column(names, ["stop", "end"]), resolve_column(names, ["ratio_corrected", "ratio"])
    return df.select("contig", "start", F.col(stop).alias("stop"), F.col("arm") if "arm" in names else F.lit(None).cast("string").alias("arm"), F.col(ratio).alias("ratio"))


def read_kmers(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, "motif string, freq double")


def read_region_calls(spark: SparkSession, path: str) -> DataFrame:
    """Ten headerless columns of region calls, with ``case_minus_control`` beside the untouched difference."""
    names = "chrom string, start bigint, end bigint, q_value double, mean_diff double, n_sites int, p_rank double, p_ks double, mean_g1 double, mean_g2 double"
    return _csv(spark, path, names).withColumn("case_minus_control", F.col("mean_g2") - F.col("mean_g1"))


def read_occupancy(spark: SparkSession, path: str) -> DataFrame:
    """name and mean of a headerless table of six columns, or nine in the older layout (name fourth)."""
    rows = spark.read.text(path).select(F.split("value", "\t").alias("f"))
    old = F.size("f") >= 9
    return rows.select(F.when(old, F.get("f", F.lit(3))).otherwise(F.get("f", F.lit(0))).alias("name"), F.when(old, F.expr("try_cast(get(f, 8) as double)")).otherwise(F.expr("try_cast(get(f, 5) as double)")).alias("mean"))


def read_fragment_sizes(spark: SparkSession, path: str) -> DataFrame:
    """size, count, sample, ord of a histogram with or without a header; comment lines and the header are skipped.

    ``ord`` orders rows as in the file: by line number within it, from the reader's place of each line.
    """
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("ord"), F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"))
    f = F.split("value", r"[\t,]")
    rows = lines.where(~F.col("value").startswith("#")).select(f.alias("f"), "ord", "file")
    out = rows.select(F.expr("try_cast(f[0] as int)").alias("size"), F.expr("try_cast(get(f, 1) as double)").alias("count"), F.coalesce(F.get("f", F.lit(2)), F.regexp_replace("file", r"\.[^.]*$", "")).alias("sample"), "ord")
    return out.where("size is not null and count is not null")


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The seven columns of a sample sheet; a repeated sample, an unknown role or more than two groups raises at once."""
    names = ("sample", "group", "role", "input_type", "r1", "r2", "bam")
    sheet = _csv(spark, path, ", ".join(f"`{n}` string" for n in names), header=True)
    found = sheet.agg(
        (F.count(F.lit(1)) != F.count_distinct("sample")).alias("a sample is missing or repeated"),
        F.coalesce(F.bool_or(~F.col("role").isin("control", "case")), F.lit(False)).alias("a role is neither control nor case"),
        (F.count_distinct("group") > 2).alias("there are more than two groups"),
    ).first()
    wrong = [k for k, v in found.asDict().items() if v]
    if wrong:
        raise ValueError(f"{path}: {'; '.join(wrong)}")
    return sheet


def read_reference(spark: SparkSession, path: str, depths: Sequence[int], stats: Sequence[str] = ("sd_mean",)) -> DataFrame:
    """Baseline mean and the wanted statistics of the wanted depths, from Parquet partitioned by depth: other partitions and columns are not read."""
    return spark.read.parquet(path).where(F.col("depth").isin(list(depths))).select("site", "baseline_mean", "depth", *stats)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    schema = "run_id string, status string, stages array<struct<id:string,name:string,status:string,command:string,expected:array<struct<path:string,role:string,required:boolean,nonempty:boolean,description:string>>>>"
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("event string, command_id string, label string, command string, timestamp timestamp, returncode int").json(path)


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, bytes, modified of the files under a folder, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def signatures(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path and SHA-256 of the files under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def discover_inputs(files: DataFrame) -> DataFrame:
    """sample, r1, r2 of paths named ``name_R1.fastq.gz`` or ``name_1.fq.gz``; two files for one mate raise on use."""
    name = F.element_at(F.split("path", "/"), -1)
    pattern = r"^(.+?)_R?([12])(?:_001)?\.(?:fastq|fq)(?:\.gz)?$"
    mates = files.select("path", F.regexp_extract(name, pattern, 1).alias("sample"), F.regexp_extract(name, pattern, 2).alias("mate")).where("sample <> ''")
    n = lambda m: F.count(F.when(F.col("mate") == m, 1))
    one = lambda m: F.when(n(m) > 1, F.raise_error(F.concat(F.lit("ambiguous files of "), F.first("sample"))).cast("string")).otherwise(F.max(F.when(F.col("mate") == m, F.col("path"))))
    return mates.groupBy("sample").agg(one("1").alias("r1"), one("2").alias("r2"))


def discover_samples(files: DataFrame) -> DataFrame:
    """sample, group, role, input_type, r1, r2, bam of the reads and alignments among files (path), as a sample sheet has them.

    Reads are named ``name_R1.fastq.gz`` and the like, with a lane before it and a number after it or not; alignments
    ``name.bam``. A sample must have one pair of reads from one lane, or one alignment, and not both; else its row raises
    on use. No sample at all is an error at once.
    """
    name = F.element_at(F.split("path", "/"), -1)
    part = lambda i: F.regexp_extract(name, r"(?i)^(.+?)(?:_L([0-9]{3}))?_R([12])(?:_[0-9]{3})?\.(?:fastq|fq)(?:\.gz)?$", i)
    reads, bam = part(1) != "", F.lower(name).endswith(".bam")
    found = files.where(reads | bam).select("path", F.when(reads, part(1)).otherwise(F.regexp_replace(name, r"(?i)\.bam$", "")).alias("sample"), F.when(reads, part(3)).otherwise("bam").alias("kind"), F.nullif(part(2), F.lit("")).alias("lane"))
    if not found.limit(1).count():
        raise ValueError("there are no pairs of reads and no alignments; a sample sheet must name them")
    n = lambda kind: F.count(F.when(F.col("kind") == kind, 1))
    path = lambda kind: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("path"))), F.lit(""))
    per = found.groupBy("sample").agg(n("1").alias("n1"), n("2").alias("n2"), n("bam").alias("n_bam"), F.count_distinct("lane").alias("lanes"), path("1").alias("r1"), path("2").alias("r2"), path("bam").alias("bam"))
    wrong = (
        F.when((F.col("n_bam") > 0) & (F.col("n1") + F.col("n2") > 0), "both reads and alignments of ")
        .when((F.col("n_bam") == 0) & ((F.col("n1") != 1) | (F.col("n2") != 1) | (F.col("lanes") > 1)), "ambiguous reads of ")
        .when(F.col("n_bam") > 1, "ambiguous alignments of ")
    )
    sample = F.when(wrong.isNotNull(), F.raise_error(F.concat(wrong, "sample")).cast("string")).otherwise(F.col("sample"))
    return per.select(sample.alias("sample"), F.lit("").alias("group"), F.lit("").alias("role"), F.when(F.col("n_bam") > 0, "bam").otherwise("fastq").alias("input_type"), "r1", "r2", "bam")


def _ordered_lines(spark: SparkSession, path: str, keep: Column) -> DataFrame:
    """``ord`` and ``line`` of the lines of one small file that ``keep`` (on ``line``) holds for, numbered from 0."""
    whole = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("at", "line")).where(keep)
    listed = whole.agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("lines"))
    return listed.select(F.posexplode("lines").alias("ord", "of")).select("ord", F.col("of.line").alias("line"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """ord, name, length of the sequences in a dictionary (lines @SQ with SN and LN in any order), in the file's order."""
    lines = _ordered_lines(spark, path, F.col("line").startswith("@SQ\t") & F.col("line").rlike("\tSN:") & F.col("line").rlike("\tLN:"))
    field = lambda k: F.element_at(F.filter(F.split("line", "\t"), lambda x: x.startswith(f"{k}:")), -1)
    return lines.select("ord", F.substring(field("SN"), 4, 1 << 30).alias("name"), F.substring(field("LN"), 4, 1 << 30).cast("long").alias("length"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """ord, name, length of the first two columns of a sequence index, in the file's order; to be held against a dictionary."""
    lines = _ordered_lines(spark, path, F.size(F.split("line", "\t")) >= 2)
    return lines.select("ord", F.get(F.split("line", "\t"), F.lit(0)).alias("name"), F.get(F.split("line", "\t"), F.lit(1)).cast("long").alias("length"))


def write_table(df: DataFrame, path: str, sep: str = "\t", header: bool = True, partition_by: Sequence[str] = ()) -> None:
    """Delimited text with NA for null, replacing what is there once the job has succeeded."""
    df.write.mode("overwrite").partitionBy(*partition_by).option("sep", sep).option("header", header).option("nullValue", "NA").csv(path)


def write_bed(df: DataFrame, path: str) -> None:
    write_table(df.select("chrom", "start", "end", "name"), path, header=False)


def number(text: Column) -> Column:
    """A number written with thousands commas or a percent sign; null if there is none."""
    return F.regexp_replace(text, "[,%]", "").try_cast("double")
