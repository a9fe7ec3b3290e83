"""Per-sample quality: methylation and coverage figures, fragment histograms, value densities and weighted scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry.functions.scalar import ratio


def coverage(sites: DataFrame, min_depth: int = 1) -> DataFrame:
    """Per sample: ``methylation_pct``, ``covered_sites``, ``mean_depth`` over sites (sample, m, u) of at least ``min_depth``."""
    deep = sites.where(F.col("m") + F.col("u") >= min_depth)
    return deep.groupBy("sample").agg(ratio(100 * F.sum("m"), F.sum(F.col("m") + F.col("u"))).alias("methylation_pct"), F.count(F.lit(1)).alias("covered_sites"), F.avg(F.col("m") + F.col("u")).alias("mean_depth"))


def conversion(sites: DataFrame) -> DataFrame:
    """Per sample: ``rate_pct`` of unexpected methylation and ``conversion_pct``, its complement."""
    rate = ratio(100 * F.sum("m"), F.sum(F.col("m") + F.col("u")))
    return sites.groupBy("sample").agg(rate.alias("rate_pct"), (100 - rate).alias("conversion_pct"))


def m_bias(counts: DataFrame, keys: Sequence[str] = ("strand", "read", "pos")) -> DataFrame:
    """Methylation by position in the read: keys, ``n_meth``, ``n_unmeth``, ``pct_meth``; null for no calls."""
    total = F.sum(F.col("m") + F.col("u"))
    return counts.groupBy(*keys).agg(F.sum("m").alias("n_meth"), F.sum("u").alias("n_unmeth"), F.when(total > 0, 100 * F.sum("m") / total).alias("pct_meth"))


def fragment_metrics(sizes: DataFrame, limit: int = 1000) -> DataFrame:
    """Per sample of a histogram (sample, size, count, ord): ``median``, ``peak``, ``short_pct``, ``mono_pct``, ``di_pct``.

    The median is the first size in row order whose running count reaches half; the peak is the most frequent size from
    100 to 400, the first of equals; the shares are of sizes under 120, 140 to 180 and 300 to 360.
    """
    kept = sizes.where(F.col("size") < limit)
    order = Window.partitionBy("sample").orderBy("ord")
    whole = Window.partitionBy("sample")
    run = kept.withColumn("run", F.sum("count").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("count").over(whole))
    share = lambda cond: ratio(100 * F.coalesce(F.sum(F.when(cond, F.col("count"))), F.lit(0.0)), F.sum("count"))
    inside = F.col("size").between(100, 400)
    return run.groupBy("sample").agg(
        F.min_by("size", F.when(F.col("run") >= F.col("total") / 2, F.col("ord"))).alias("median"),
        F.max_by("size", F.when(inside, F.struct("count", -F.col("ord")))).alias("peak"),
        share(F.col("size") < 120).alias("short_pct"),
        share(F.col("size").between(140, 180)).alias("mono_pct"),
        share(F.col("size").between(300, 360)).alias("di_pct"),
    )


def value_density(values: DataFrame, bins: int = 200, floor: float = 1e-10, least: int = 100) -> DataFrame:
    """Per sample of values in 0..1: how much of them lies at the two ends.

    Columns: ``left_peak`` and ``right_peak`` (largest density of a bin centred up to 0.15 and from 0.85), ``middle`` (median
    density of bins centred from 0.35 to 0.65), ``m_score`` (smaller peak over middle), ``peak_balance`` (smaller over larger
    peak), ``boundary_mid_ratio`` (values up to 0.15 or from 0.85 over values from 0.35 to 0.65). Null under ``least`` values.
    """
    spark = values.sparkSession
    v = F.col("value")
    seen = values.where(v.isNotNull())
    at = F.least(F.floor(v * bins), F.lit(bins - 1)).cast("int")
    n = lambda cond: F.count(F.when(cond, 1))
    counts = seen.groupBy("sample", at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), n((v <= 0.15) | (v >= 0.85)).alias("outer"), n((v >= 0.35) & (v <= 0.65)).alias("inner"))
    totals = counts.groupBy("sample").agg(F.sum("n").alias("total"), F.sum("outer").alias("outer"), F.sum("inner").alias("inner"))
    dense = totals.crossJoin(F.broadcast(spark.range(bins).select(F.col("id").cast("int").alias("bin")))).join(counts.select("sample", "bin", "n"), ["sample", "bin"], "left")
    density, centre = F.coalesce("n", F.lit(0)) * bins / F.col("total"), (F.col("bin") + 0.5) / bins
    peak = lambda cond: F.max(F.when(cond, F.col("d")))
    shape = dense.withColumn("d", density).groupBy("sample", "total", "outer", "inner").agg(peak(centre <= 0.15).alias("left_peak"), peak(centre >= 0.85).alias("right_peak"), F.percentile(F.when((centre >= 0.35) & (centre <= 0.65), F.col("d")), 0.5).alias("middle"))
    small, large = F.least("left_peak", "right_peak"), F.greatest("left_peak", "right_peak")
    figures = {"left_peak": F.col("left_peak"), "right_peak": F.col("right_peak"), "middle": F.col("middle"), "m_score": small / F.greatest("middle", F.lit(floor)), "peak_balance": ratio(small, large), "boundary_mid_ratio": ratio(F.col("outer"), F.col("inner"))}
    return shape.select("sample", *(F.when(F.col("total") >= least, c).alias(k) for k, c in figures.items()))


INF = float("inf")
# fixed values: metric, label, weight, lowest and highest value that passes, lowest and highest that warns
RULES = (
    ("flagstat_mapped_pct", "Mapping rate", 20, 80, 100, 60, 100),
    ("flagstat_properly_paired_pct", "Properly paired", 8, 75, 100, 55, 100),
    ("markdup_dup_pct", "Duplication rate", 12, 0, 30, 0, 50),
    ("stats_error_rate", "Sequencing error rate", 5, 0, 1.0, 0, 2.0),
    ("adapter_reads_pct", "Adapter reads", 0, 0, 30, 0, 50),
    ("fqc_pct_modules_failed", "FastQC modules failed", 0, 0, 10, 0, 30),
    ("cpg_global_meth_pct", "Global CpG methylation", 10, 40, 90, 25, 95),
    ("cpg_covered_sites", "CpG covered sites", 8, 500_000, INF, 100_000, INF),
    ("cpg_mean_depth", "Mean CpG depth", 5, 10, INF, 5, INF),
    ("median_frag_len", "Median fragment length", 0, 130, 200, 100, 250),
    ("short_frag_ratio", "Short fragment ratio (<120 bp)", 0, 0, 100, 0, 100),
    ("mono_nuc_ratio", "Mononucleosome ratio (140–180 bp)", 0, 0, 100, 0, 100),
    ("beta_M_score", "β M-score", 0, 2.0, INF, 2.0, INF),
    ("beta_peak_balance", "β Peak Balance", 0, 0.30, INF, 0.30, INF),
    ("beta_boundary_mid_ratio", "β Boundary/Mid Ratio", 0, 2.0, INF, 2.0, INF),
)
# fixed values: sentences of the recommendation
PASSES = "Sample passes all QC thresholds (score %s/100). Suitable for downstream analysis."
WARNS = ("Sample passes with warnings (score %s/100).", "Flagged metrics: %s.", "Proceed with caution; verify these metrics do not affect downstream results.")
FAILS = ("⚠ RECOMMEND EXCLUSION (score %s/100).", "Failed metrics: %s.", "Also flagged: %s.", "Review raw data quality and consider re-sequencing or excluding from analysis.")
LACKS = "Missing data for: %s."


def rules_table(spark: SparkSession, rules: Sequence[tuple] = RULES) -> DataFrame:
    rows = [(i, m, label, *map(float, rest)) for i, (m, label, *rest) in enumerate(rules)]
    return spark.createDataFrame(rows, "rule int, metric string, label string, weight double, pass_lo double, pass_hi double, warn_lo double, warn_hi double")


def metric_status(value: Column) -> Column:
    """PASS or WARN inside the rule's bounds, else FAIL; NA for a missing value."""
    return (
        F.when(value.isNull() | F.isnan(value), "NA")
        .when(value.between(F.col("pass_lo"), F.col("pass_hi")), "PASS")
        .when(value.between(F.col("warn_lo"), F.col("warn_hi")), "WARN")
        .otherwise("FAIL")
    )


def metric_statuses(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Every rule for every sample of long metrics (sample, metric, value), with ``status``."""
    samples = metrics.select("sample").distinct()
    full = samples.crossJoin(F.broadcast(rules)).join(metrics, ["sample", "metric"], "left")
    return full.withColumn("status", metric_status(F.col("value")))


def score_samples(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Per sample: ``qc_score`` 0 to 100 with one decimal, ``qc_status``, ``n_missing`` and ``recommendation``.

    Rules without weight only report. A missing value and a warning count half. The status is FAIL if a weighted metric
    fails, else WARN if one warns, else PASS, so a sample without any value scores 50 and passes.
    """
    active = metric_statuses(metrics, rules).where("weight > 0")
    points = F.when(F.col("status") == "PASS", 1.0).when(F.col("status") == "FAIL", 0.0).otherwise(0.5)
    named = lambda s: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("status") == s, F.struct("rule", "label")))), lambda x: x["label"]), ", ")
    out = active.groupBy("sample").agg((100 * F.sum(F.col("weight") * points) / F.sum("weight")).alias("raw"), F.count(F.when(F.col("status") == "NA", 1)).alias("n_missing"), named("FAIL").alias("failing"), named("WARN").alias("warning"), named("NA").alias("lacking"))
    out = out.withColumn("qc_score", F.bround("raw", 1)).withColumn("qc_status", F.when(F.col("failing") != "", "FAIL").when(F.col("warning") != "", "WARN").otherwise("PASS"))
    say = lambda text, c: F.when(F.col(c) != "", F.format_string(text, c))
    score = F.col("qc_score").cast("string")
    lacks = say(LACKS, "lacking")
    advice = (
        F.when(F.col("qc_status") == "PASS", F.format_string(PASSES, score))
        .when(F.col("qc_status") == "WARN", F.concat_ws(" ", F.format_string(WARNS[0], score), say(WARNS[1], "warning"), F.lit(WARNS[2]), lacks))
        .otherwise(F.concat_ws(" ", F.format_string(FAILS[0], score), say(FAILS[1], "failing"), say(FAILS[2], "warning"), F.lit(FAILS[3]), lacks))
    )
    return out.select("sample", "qc_score", "qc_status", "n_missing", advice.alias("recommendation"))


def wide_scores(metrics: DataFrame, rules: DataFrame, names: Sequence[str]) -> DataFrame:
    """``{metric}_value`` and ``{metric}_status`` of the named metrics, one row for each sample."""
    return metric_statuses(metrics, rules).groupBy("sample").pivot("metric", list(names)).agg(F.first("value").alias("value"), F.first("status").alias("status"))


def true_mapped(metrics: DataFrame) -> DataFrame:
    """``mapped_pct``: mapped reads over twice the first mates, at most 100; where that is unknown, the tool's own figure."""
    own = F.least(F.lit(100.0), 100 * F.col("mapped") / (2 * F.col("r1_reads")))
    return metrics.withColumn("mapped_pct", F.coalesce(F.when(F.col("r1_reads").isNotNull() & F.col("mapped").isNotNull() & (F.col("r1_reads") > 0), own), F.col("tool_pct")))
