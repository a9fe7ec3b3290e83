"""Rank tests, multiple testing, intervals of proportions and classifier metrics as windows and aggregates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.scalar import ratio
from cohortry.functions.special import exact_rank_p, normal_tail
from cohortry.operators.intervals import with_carry


def average_rank(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Rank of ``value`` within ``keys``, equal values sharing the mean of their ranks; null for a null value."""
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(value))
    ties = Window.partitionBy(*keys, value)
    return df.withColumn(out, F.when(F.col(value).isNotNull(), F.rank().over(order) + (F.count(F.lit(1)).over(ties) - 1) / 2))


def range_of(value: Column, cuts: Column, most: int) -> Column:
    """How many of the ascending ``cuts`` (an array of at most ``most``) are below ``value``, by halving."""
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(max(1, most.bit_length())))))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.coalesce(F.get(cuts, at + step - 1) < value, F.lit(False)), at + step).otherwise(at))


def ranks_by_range(long: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``long`` with the rank of ``value`` within ``key``, equal values sharing the mean of their ranks; null for a null value.

    For keys with very many rows and few keys, such as samples: distinct values are counted and summed up within ranges of
    values, and what a range begins with is one row for each range of a key.
    """
    parts = max(2, int(long.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counted = long.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("__n"))
    cuts = counted.groupBy(F.col(key).alias("__key")).agg(F.percentile_approx(value, [i / parts for i in range(1, parts)], 10_000).alias("__cuts"))
    ranged = counted.join(cuts, F.col(key) == F.col("__key")).withColumn("__tile", range_of(F.col(value), F.col("__cuts"), parts - 1)).drop("__key", "__cuts")
    carried = with_carry(ranged, [key], F.sum("__n"), F.sum, "__before")
    upto = F.sum("__n").over(Window.partitionBy(key, "__tile").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce("__before", F.lit(0))
    ranks = carried.select(F.col(key).alias("__key"), F.col(value).alias("__value"), (upto - (F.col("__n") - 1) / 2).alias(out))
    return long.join(ranks, (F.col(key) == F.col("__key")) & (F.col(value) == F.col("__value")), "left").drop("__key", "__value")


def rank_sum(long: DataFrame, a: str = "control", b: str = "case") -> DataFrame:
    """Mann-Whitney U of group b over group a for each feature (columns feature, group, value), nulls left out.

    Columns: ``feature``, ``n_a``, ``n_b``, ``u`` and ``ties`` (sum of t^3 - t over tied values). Each feature is ranked in a
    task of its own, so the cost is a sort of each feature's samples; samples are few and features many.
    """
    seen = long.where(F.col("value").isNotNull() & F.col("group").isin(a, b))
    ranked = average_rank(seen, ["feature"], "value", "rank")
    tied = Window.partitionBy("feature", "value")
    ranked = ranked.withColumn("t2", F.count(F.lit(1)).over(tied))
    n = lambda g: F.count(F.when(F.col("group") == g, 1))
    return ranked.groupBy("feature").agg(
        n(a).alias("n_a"),
        n(b).alias("n_b"),
        (F.sum(F.when(F.col("group") == b, F.col("rank"))) - n(b) * (n(b) + 1) / 2).alias("u"),
        F.sum(F.pow("t2", F.lit(2)) - 1).alias("ties"),
    )


def rank_p(tests: DataFrame) -> DataFrame:
    """``tests`` (of :func:`rank_sum`) with two-sided ``p``: exact for up to 8 values in the smaller group and no ties, else normal
    with tie and continuity correction. Null if a group is empty; 1 if all values are equal."""
    @F.pandas_udf("double")
    def p(n_a: pd.Series, n_b: pd.Series, u: pd.Series, ties: pd.Series) -> pd.Series:
        n = n_a + n_b
        with np.errstate(divide="ignore", invalid="ignore"):
            spread = np.sqrt(n_a * n_b / 12 * (n + 1 - ties / (n * (n - 1))))
            z = (np.maximum(u, n_a * n_b - u) - n_a * n_b / 2 - 0.5) / spread
        out = pd.Series(np.where(spread > 0, np.minimum(1.0, 2 * normal_tail(z.to_numpy(float))), 1.0))
        exact = (np.minimum(n_a, n_b) <= 8) & (ties == 0) & (np.minimum(n_a, n_b) > 0)
        for i in np.flatnonzero(exact):
            out.iloc[i] = exact_rank_p(int(n_a.iloc[i]), int(n_b.iloc[i]), float(u.iloc[i]))
        return out.where((n_a > 0) & (n_b > 0))

    return tests.withColumn("p", p("n_a", "n_b", "u", "ties"))


def auc_p(tests: DataFrame) -> DataFrame:
    """``tests`` (of :func:`rank_sum`) with ``auc``, that of group b over group a, and ``p``, one-sided: how likely a rank sum of b is as
    large by chance. Normal approximation with tie and continuity correction; 1 if all values are equal, null if a group is empty."""
    n = F.col("n_a") + F.col("n_b")
    spread = F.sqrt(F.col("n_a") * F.col("n_b") / 12 * (n + 1 - F.try_divide("ties", n * (n - 1))))
    whole = F.col("n_a") * F.col("n_b")

    @F.pandas_udf("double")
    def tail(z: pd.Series) -> pd.Series:
        return pd.Series(normal_tail(z.to_numpy(float)))

    z = F.when(spread > 0, (F.col("u") - whole / 2 - 0.5) / spread)
    p = F.when(whole > 0, F.when(z.isNull(), 1.0).otherwise(tail(F.coalesce(z, F.lit(0.0)))))
    return tests.withColumn("auc", F.when(whole > 0, F.col("u") / whole)).withColumn("p", p)


def adjust_p(tests: DataFrame, p: str = "p", out: str = "q", total: int | None = None) -> DataFrame:
    """Benjamini-Hochberg q of every row; null p gives null q, but counts among the tests.

    Equal p have the same q, so distinct values are ranked, each with its number of rows. The rank needs a global order:
    values are dealt into ranges, each range's size gives its first rank, and the running minimum from the largest p down
    is taken within ranges and carried over by the ranges' own minima; only one row for each range meets in one place.
    """
    n = F.lit(total) if total is not None else F.lit(tests.count())
    parts = max(1, int(tests.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    values = tests.where(F.col(p).isNotNull()).groupBy(F.col(p).alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    cuts = sorted(set(values.agg(F.percentile_approx("__p", [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()[0] or []))
    ranged = values.withColumn("__r", range_of(F.col("__p"), F.array(*(F.lit(float(c)) for c in cuts)) if cuts else F.array().cast("array<double>"), parts))
    sizes = ranged.groupBy("__r").agg(F.sum("__n").alias("__m"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__m").over(Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__m")
    # equal p share the rank of the last of them
    rank = F.col("__before") + F.sum("__n").over(Window.partitionBy("__r").orderBy("__p").rowsBetween(Window.unboundedPreceding, 0))
    raw = ranged.join(F.broadcast(before), "__r").withColumn("__raw", F.col("__p") * n / rank)
    least = raw.groupBy("__r").agg(F.min("__raw").alias("__min"))
    later = least.withColumn("__later", F.min("__min").over(Window.orderBy(F.desc("__r")).rowsBetween(Window.unboundedPreceding, -1))).drop("__min")
    own = F.min("__raw").over(Window.partitionBy("__r").orderBy(F.desc("__p")).rowsBetween(Window.unboundedPreceding, 0))
    done = raw.join(F.broadcast(later), "__r").select("__p", F.least(own, F.col("__later"), F.lit(1.0)).alias("__q"))
    return tests.join(done, F.col(p) == F.col("__p"), "left").select(*tests.columns, F.col("__q").alias(out))


def wilson(successes: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """Bounds of Wilson's interval of a proportion; null for no trials."""
    p = successes / n
    centre = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return F.when(n > 0, F.greatest(F.lit(0.0), centre - half)), F.when(n > 0, F.least(F.lit(1.0), centre + half))


def roc(scores: DataFrame, keys: Sequence[str] = (), score: str = "score", label: str = "label") -> DataFrame:
    """Points ``fpr``, ``tpr``, ``threshold`` of the ROC curve for each key: one for each distinct score, from high to low."""
    counted = scores.where(F.col(score).isNotNull() & F.col(label).isin(0, 1)).groupBy(*keys, score).agg(F.sum(label).alias("pos"), F.sum(1 - F.col(label)).alias("neg"))
    down = Window.partitionBy(*keys).orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    rate = lambda c: ratio(F.sum(c).over(down), F.sum(c).over(whole))
    return counted.select(*keys, rate("neg").alias("fpr"), rate("pos").alias("tpr"), F.col(score).alias("threshold"))


def auc(scores: DataFrame, keys: Sequence[str] = (), score: str = "score", label: str = "label") -> DataFrame:
    """Area under the ROC curve for each key, tied scores counting half; null if a class is missing. Distinct scores are
    counted first, so the window holds one row for each."""
    counted = scores.where(F.col(score).isNotNull() & F.col(label).isin(0, 1)).groupBy(*keys, score).agg(F.sum(label).alias("__pos"), F.sum(1 - F.col(label)).alias("__neg"))
    below = F.coalesce(F.sum("__neg").over(Window.partitionBy(*keys).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    won = counted.withColumn("__won", F.col("__pos") * (below + F.col("__neg") / 2))
    pos, neg = F.sum("__pos"), F.sum("__neg")
    return won.groupBy(*keys).agg(F.when((pos > 0) & (neg > 0), F.sum("__won") / (pos * neg)).alias("auc"))


def sensitivity_at(curve: DataFrame, specificity: float, keys: Sequence[str] = ()) -> DataFrame:
    """Largest ``tpr`` whose ``fpr`` is at most 1 - specificity, else 0."""
    return curve.groupBy(*keys).agg(F.coalesce(F.max(F.when(F.col("fpr") <= 1 - specificity + 1e-12, F.col("tpr"))), F.lit(0.0)).alias("sensitivity"))


def brier(scores: DataFrame, keys: Sequence[str] = (), score: str = "score", label: str = "label") -> DataFrame:
    """Mean squared difference of score and label for each key."""
    return scores.groupBy(*keys).agg(F.avg(F.pow(F.col(score) - F.col(label), F.lit(2))).alias("brier"))


def anova_f(long: DataFrame, a: str = "control", b: str = "case") -> DataFrame:
    """F of a one-way analysis of variance of two groups for each feature, from counts, sums and sums of squares."""
    part = lambda g: F.when(F.col("group") == g, F.col("value"))
    sums = long.groupBy("feature").agg(*(f(part(g)).alias(f"{name}{i}") for i, g in enumerate((a, b)) for name, f in (("n", F.count), ("s", F.sum))), F.sum(part(a) * part(a)).alias("q0"), F.sum(part(b) * part(b)).alias("q1"))
    n0, n1, s0, s1, q0, q1 = (F.col(c) for c in ("n0", "n1", "s0", "s1", "q0", "q1"))
    between = s0 * s0 / n0 + s1 * s1 / n1 - (s0 + s1) * (s0 + s1) / (n0 + n1)
    within = q0 + q1 - s0 * s0 / n0 - s1 * s1 / n1
    f = F.when(within > 1e-12, between / (within / (n0 + n1 - 2)))
    return sums.where("n0 > 0 and n1 > 0 and n0 + n1 > 2").select("feature", f.alias("f"))


def lowest_q(tests: DataFrame, keys: Sequence[str], k: int = 10, ties: Sequence[str] = ("feature",)) -> DataFrame:
    """The ``k`` rows of lowest q in each key, then lowest p, nulls last, then by ``ties``; ``place`` counts from 1."""
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("q"), F.asc_nulls_last("p"), *ties)
    return tests.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def sort_predictions(predictions: DataFrame, label: str = "y_true", score: str = "score", ties: Sequence[str] = ("sample",)) -> DataFrame:
    """Predictions by label, then from the highest score down, nulls last, then by ``ties``."""
    return predictions.orderBy(label, F.desc_nulls_last(score), *ties)


def best_features(tests: DataFrame, score: str, k: int) -> DataFrame:
    """The ``k`` features of highest score, nulls last, ties by feature."""
    return tests.orderBy(F.desc_nulls_last(score), "feature").limit(k)


def best_by_rank_p(long: DataFrame, k: int = 100, a: str = "control", b: str = "case") -> DataFrame:
    """The ``k`` features that a two-sided rank test tells apart best: ``place`` (from 1), ``feature``, ``u``, ``p``; ties by feature.

    A feature without a value in either group has no p and is never taken.
    """
    best = rank_p(rank_sum(long, a, b)).where("p is not null").orderBy("p", "feature").limit(k)
    return best.withColumn("place", F.row_number().over(Window.orderBy("p", "feature"))).select("place", "feature", "u", "p")  # k rows


PAIR_SUMS = ("n", "si", "sj", "sii", "sjj", "sij")


def pair_sums(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each two columns (``i <= j``, places in ``columns``), over the rows where both have a value: ``n``, the sums ``si`` and ``sj``,
    the sums of squares ``sii`` and ``sjj`` and of products ``sij``.

    A task adds its rows up in matrices of columns by columns, so the plan does not grow with the pairs, and no pair of rows is made.
    """
    n = len(columns)
    low, high = np.triu_indices(n)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, n, n))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1)
            there = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            sums += np.stack([there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x])
        m, s, q, p = sums
        cells = (m[low, high], s[low, high], s[high, low], q[low, high], q[high, low], p[low, high])
        yield pa.RecordBatch.from_arrays([pa.array(low, pa.int32()), pa.array(high, pa.int32()), *map(pa.array, cells)], names=["i", "j", *PAIR_SUMS])

    cells = wide.select(*columns).mapInArrow(partial, "i int, j int, " + ", ".join(f"{c} double" for c in PAIR_SUMS))
    return cells.groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in PAIR_SUMS))


def with_names(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``cells`` with the columns' names ``a`` and ``b`` for their places ``i`` and ``j``; there are as many names as columns."""
    names = F.broadcast(cells.sparkSession.createDataFrame([(i, s) for i, s in enumerate(columns)], "at int, name string"))
    return cells.join(names.withColumnsRenamed({"at": "i", "name": "a"}), "i").join(names.withColumnsRenamed({"at": "j", "name": "b"}), "j")


def correlations(long: DataFrame, samples: Sequence[str], spearman: bool = False) -> DataFrame:
    """``a``, ``b``, ``r`` for every pair of the given samples, null values filled with the sample's mean (after ranking, for
    Spearman, the rank of the filled value). Features that a sample has no row for are left out of its pairs. Values are
    centred before they are multiplied; a sample without spread gives null."""
    def centred(rows: DataFrame) -> DataFrame:
        """Rows with their sample's mean beside them; there are as many means as samples."""
        means = rows.groupBy(F.col("sample").alias("__of")).agg(F.avg("value").alias("__mean"))
        return rows.join(F.broadcast(means.where(F.col("__of").isin(list(samples)))), F.col("sample") == F.col("__of")).drop("__of")

    filled = centred(long).withColumn("value", F.coalesce("value", "__mean"))
    if spearman:
        filled = centred(ranks_by_range(filled.drop("__mean"), "sample", "value", "rank").drop("value").withColumnRenamed("rank", "value"))
    wide = filled.withColumn("value", F.col("value") - F.col("__mean")).groupBy("feature").pivot("sample", list(samples)).agg(F.first("value"))
    vi, vj, both = F.col("sii") - F.col("si") ** 2 / F.col("n"), F.col("sjj") - F.col("sj") ** 2 / F.col("n"), F.col("sij") - F.col("si") * F.col("sj") / F.col("n")
    least = lambda s: 1e-12 * F.greatest(s, F.lit(1e-300))
    r = F.when((F.col("n") > 0) & (vi > least(F.col("sii"))) & (vj > least(F.col("sjj"))), both / F.sqrt(vi * vj))
    return with_names(pair_sums(wide, samples).where("i < j"), samples).select("a", "b", r.alias("r"))


def ecdf(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``ecdf`` (share of values at most this one) and ``above`` (its complement) of each distinct value within ``keys``."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    up = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    share = F.sum("__n").over(up) / F.sum("__n").over(Window.partitionBy(*keys))
    return counted.select(*keys, value, share.alias("ecdf"), (1 - share).alias("above"))


def higher_quantile(values: Column, q: float) -> Column:
    """Aggregate: the smallest observed value at or above the q-quantile's place, nulls left out."""
    ordered = F.array_sort(F.collect_list(values))
    at = F.ceil((F.size(ordered) - 1) * F.lit(q)).cast("int") + 1
    return F.when(F.size(ordered) > 0, F.element_at(ordered, F.greatest(at, F.lit(1))))


def empirical_p(observed: DataFrame, null: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``p`` of each observed value: one more than the null values at least as large, over one more than all of its key.

    Both sides are merged and swept once by a window in descending order; no pair of rows is formed.
    """
    both = observed.withColumn("__null", F.lit(0)).unionByName(null.select(*keys, value).withColumn("__null", F.lit(1)), allowMissingColumns=True)
    down = Window.partitionBy(*keys).orderBy(F.desc(value)).rangeBetween(Window.unboundedPreceding, 0)
    reached, size = F.sum("__null").over(down), F.sum("__null").over(Window.partitionBy(*keys))
    return both.withColumn("p", (reached + 1) / (size + 1)).where("__null = 0").select(*observed.columns, "p")


def mean_jaccard(sets: DataFrame, key: str, member: str) -> DataFrame:
    """``mean_jaccard`` of all pairs of sets (rows of key and member); sets are few, such as one for each fold.

    Two empty sets count as equal; fewer than two sets give null.
    """
    listed = sets.groupBy(key).agg(F.collect_set(member).alias("items"))
    a, b = listed.select(F.col(key).alias("ka"), F.col("items").alias("ia")), listed.select(F.col(key).alias("kb"), F.col("items").alias("ib"))
    union = F.size(F.array_union("ia", "ib"))
    return a.join(b, F.col("ka") < F.col("kb")).agg(F.avg(F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect("ia", "ib")) / union)).alias("mean_jaccard"))


def kernel_density(long: DataFrame, points: int = 100, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Gaussian kernel density of the values in 0..1 of each key at evenly spaced points, Scott's bandwidth.

    Values are counted in a fine histogram first, so that what a task holds is as long as the histogram whatever the
    number of values.
    """
    cells = 1000
    seen = long.where(F.col("value").isNotNull())
    cell = F.least(F.floor(F.col("value") * cells), F.lit(cells - 1)).cast("int")
    per = seen.groupBy(*keys, cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in per.select(*keys).schema.fields)

    def smooth(part: pd.DataFrame) -> pd.DataFrame:
        x, n = (part["cell"].to_numpy() + 0.5) / cells, part["n"].to_numpy(float)
        total = n.sum()
        mean = (n * x).sum() / total
        width = max(np.sqrt((n * (x - mean) ** 2).sum() / max(total - 1, 1)) * total ** (-1 / 5), 1e-6)
        at = np.linspace(0, 1, points)
        density = (n * np.exp(-0.5 * ((at[:, None] - x[None, :]) / width) ** 2)).sum(axis=1) / (total * width * np.sqrt(2 * np.pi))
        return pd.DataFrame({**{k: part[k].iloc[0] for k in keys}, "x": at, "density": density})

    return per.groupBy(*keys).applyInPandas(smooth, f"{types}, x double, density double")
