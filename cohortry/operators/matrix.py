"""Sample-by-feature matrices in long form: one row for each feature and sample, a missing value is null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.scalar import ratio


def null_if_nan(c: Column) -> Column:
    """NaN as null; every other value stays."""
    return F.when(~F.isnan(c), c)


def to_long(wide: DataFrame, feature: str, samples: Sequence[str] | None = None) -> DataFrame:
    """``feature``, ``sample``, ``value`` of a wide table; NaN becomes null and stays as a row."""
    samples = list(samples or [c for c in wide.columns if c != feature])
    long = wide.select(F.col(feature).alias("feature"), *(F.col(c).cast("double").alias(c) for c in samples)).unpivot("feature", samples, "sample", "value")
    return long.withColumn("value", null_if_nan(F.col("value")))


def to_wide(long: DataFrame, samples: Sequence[str], keys: Sequence[str] = ("feature",)) -> DataFrame:
    """One column for each named sample; the samples are given, so that no job has to look for them."""
    return long.groupBy(*keys).pivot("sample", list(samples)).agg(F.first("value", ignorenulls=True))


def assemble(parts: Sequence[DataFrame]) -> DataFrame:
    """Full outer assembly of per-sample tables (feature, sample, value) as one long matrix."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order; give a full order for a defined result."""
    at = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__at", F.row_number().over(at)).where("__at = 1").drop("__at")


def resolve_groups(samples: DataFrame, names: dict[str, Sequence[str]] | None = None, prefixes: dict[str, str] | None = None) -> DataFrame:
    """``samples`` (column sample) with ``group``: by explicit names, else by prefix; others are left out.

    A name that the samples lack is an error.
    """
    if names:
        spark = samples.sparkSession
        wanted = spark.createDataFrame([(s, g) for g, ss in names.items() for s in ss], "sample string, group string")
        lacking = [r.sample for r in wanted.join(samples, "sample", "left_anti").orderBy("sample").collect()]
        if lacking:
            raise ValueError(f"samples not in the matrix: {', '.join(lacking)}")
        return samples.join(F.broadcast(wanted), "sample")
    group = F.lit(None).cast("string")
    for g, prefix in reversed(list((prefixes or {}).items())):
        group = F.when(F.col("sample").startswith(prefix), g).otherwise(group)
    return samples.withColumn("group", group).where("group is not null")


def feature_stats(long: DataFrame, n_samples: int) -> DataFrame:
    """``feature``, ``n``, ``missing_frac``, ``mean``, ``variance`` (n - 1) and ``variance_n`` of each feature."""
    return long.groupBy("feature").agg(
        F.count("value").alias("n"),
        ((F.lit(n_samples) - F.count("value")) / n_samples).alias("missing_frac"),
        F.avg("value").alias("mean"),
        F.var_samp("value").alias("variance"),
        F.var_pop("value").alias("variance_n"),
    )


def usable_features(long: DataFrame, n_samples: int, max_missing: float = 0.5) -> DataFrame:
    """Statistics of the features observed at all, missing in at most ``max_missing`` of the samples, and not constant."""
    return feature_stats(long, n_samples).where((F.col("n") > 0) & (F.col("missing_frac") <= max_missing) & (F.col("variance") > 0))


def few_missing(long: DataFrame, n_samples: int, ratio: float = 0.1) -> DataFrame:
    """Features missing in at most ``ratio`` of the samples."""
    return feature_stats(long, n_samples).where(F.lit(n_samples) - F.col("n") <= n_samples * ratio)


def observed_in_both(long: DataFrame, sizes: dict[str, int], least: float) -> DataFrame:
    """Features observed in at least the share ``least`` of each group (column group) and not constant."""
    seen = [F.count(F.when(F.col("group") == g, F.col("value"))) / n >= least for g, n in sizes.items()]
    kept = long.groupBy("feature").agg(*(s.alias(f"ok{i}") for i, s in enumerate(seen)), F.median("value").alias("median"), F.var_pop("value").alias("variance_n"))
    everywhere = F.lit(True)
    for i in range(len(seen)):
        everywhere = everywhere & F.col(f"ok{i}")
    return kept.where(everywhere & F.col("median").isNotNull() & (F.col("variance_n") > 0)).select("feature", "median", "variance_n")


def top_variable(stats: DataFrame, n: int) -> DataFrame:
    """The ``n`` features of highest variance, ties by feature; a null variance counts as 0."""
    return stats.withColumn("variance", F.coalesce("variance", F.lit(0.0))).orderBy(F.desc("variance"), "feature").limit(n)


def every_kth(df: DataFrame, ordinal: str, k: int) -> DataFrame:
    """Every k-th row by an ordinal column that counts from 0."""
    return df.where(F.pmod(F.col(ordinal), F.lit(k)) == 0)


def fixed_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` rows, the same ones every time: those of smallest hash of key and seed."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)


def feature_subset(features: DataFrame, key: str, subset: int | float | str = "all", seed: int = 42) -> DataFrame:
    """A random subset of the distinct values of ``key``, the same every time: a number of them, a share (rounded down) or "all".

    Taken are the values whose MD5 of seed and value comes first. Values are counted for each of the 4,096 beginnings of
    that hash, and only the beginning in which the subset ends is put in order, so no sort or limit takes all values in one
    task. More than there are is an error; nulls are left out.
    """
    values = features.select(key).where(F.col(key).isNotNull()).distinct()
    if subset == "all":
        return values
    hashed = values.withColumn("__h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))).withColumn("__tile", F.substring("__h", 1, 3))
    sizes = hashed.groupBy("__tile").agg(F.count(F.lit(1)).alias("__n"))
    upto = F.sum("__n").over(Window.orderBy("__tile"))  # at most 4,096 rows
    n = F.sum("__n").over(Window.partitionBy())
    wanted = F.lit(subset) if isinstance(subset, int) else F.floor(n * F.lit(subset))
    wanted = F.when(wanted <= n, wanted).otherwise(F.raise_error(F.lit(f"fewer than {subset} values of {key}")))
    left = sizes.select("__tile", (wanted - upto + F.col("__n")).alias("__left"), "__n").where("__left > 0")
    inside = hashed.join(F.broadcast(left), "__tile")
    place = F.row_number().over(Window.partitionBy("__tile").orderBy("__h", key))
    whole, last = inside.where("__left >= __n"), inside.where("__left < __n").withColumn("__place", place).where("__place <= __left")
    return whole.select(key).union(last.select(key))


def group_means(long: DataFrame, a: str = "control", b: str = "case") -> DataFrame:
    """``mean_a``, ``mean_b`` and ``meandiff`` (b less a) of each feature over observed values."""
    mean = lambda g: F.avg(F.when(F.col("group") == g, F.col("value")))
    return long.groupBy("feature").agg(mean(a).alias("mean_a"), mean(b).alias("mean_b")).withColumn("meandiff", F.col("mean_b") - F.col("mean_a"))


def z_scores(long: DataFrame, limit: float = 5.0) -> DataFrame:
    """``z`` of each value within its feature: missing values are the feature's mean first, then scaled by the deviation over n,
    and clipped to plus or minus ``limit``."""
    of = Window.partitionBy("feature")
    filled = long.withColumn("filled", F.coalesce("value", F.avg("value").over(of)))
    spread = F.stddev_pop("filled").over(of)
    z = F.when(spread > 0, (F.col("filled") - F.avg("filled").over(of)) / spread).otherwise(0.0)
    return filled.withColumn("z", F.greatest(F.lit(-limit), F.least(F.lit(limit), z))).drop("filled")


def share_of_total(df: DataFrame, keys: Sequence[str], value: str, out: str, scale: float = 1.0) -> DataFrame:
    """``value`` as a share of its total over ``keys``."""
    return df.withColumn(out, ratio(F.lit(scale) * F.col(value), F.sum(value).over(Window.partitionBy(*keys))))


def unit_scale(long: DataFrame) -> DataFrame:
    """Values as fractions: a sample whose largest value is above 1.5 holds percentages; then clipped to 0..1."""
    percent = F.max("value").over(Window.partitionBy("sample")) > 1.5
    scaled = F.when(percent, F.col("value") / 100).otherwise(F.col("value"))
    return long.withColumn("value", F.when(F.col("value").isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), scaled))))


def sample_means(long: DataFrame) -> DataFrame:
    """``sample``, ``group``, ``mean`` of each sample's values, missing ones left out, and ``group_median`` of its group's means."""
    means = long.groupBy("sample", "group").agg(F.avg(F.when(~F.isnan("value"), F.col("value"))).alias("mean"))
    medians = means.groupBy("group").agg(F.median("mean").alias("group_median"))
    return means.join(medians, "group", "left").select("sample", "group", "mean", "group_median")


def column_means(long: DataFrame, samples: Sequence[str]) -> DataFrame:
    """``sample``, ``mean`` over its finite values, ``n_finite`` and ``n_rows`` of each wanted sample; one without rows is an error."""
    finite = F.when(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf")), F.col("value"))
    found = long.where(F.col("sample").isin(list(samples))).groupBy("sample").agg(F.avg(finite).alias("mean"), F.count(finite).alias("n_finite"), F.count(F.lit(1)).alias("n_rows"))
    wanted = long.sparkSession.createDataFrame([(s,) for s in samples], "sample string")
    rows = F.when(F.col("n_rows").isNull(), F.raise_error(F.concat(F.lit("no rows for sample "), "sample")).cast("long")).otherwise(F.col("n_rows"))
    return wanted.join(found, "sample", "left").select("sample", "mean", "n_finite", rows.alias("n_rows"))


def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """``df`` with the place of each row, from 0, in the order in which it is read; rows of one feature keep labels of their own.

    Each partition's size comes to the driver, one number for each. Only tables whose rows come in a fixed order, such as
    files, have fixed places.
    """
    numbered = df.withColumn("__id", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__id", 33))
    sizes = numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).orderBy("__part").collect()
    offsets, total = [], 0
    for r in sizes:
        offsets.append((r["__part"], total))
        total += r.n
    table = F.broadcast(df.sparkSession.createDataFrame(offsets, "__part long, __first long"))
    place = F.col("__first") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.join(table, "__part").withColumn(name, place).drop("__part", "__id", "__first")
