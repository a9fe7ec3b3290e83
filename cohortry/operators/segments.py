"""Segments of sites along chromosomes, by a search of change points of its own (no other segmentation's results).

A place between two sites is a change point if the means of the ``width`` sites on either side differ by enough of the
noise, and by more than at any other place within ``width`` sites. That depends on 2 x ``width`` neighbours only: sites
are dealt out in tiles with so many more on each side, and no result depends on where a tile ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortry.operators import stats
from cohortry.operators.intervals import tiled, with_carry
from cohortry.session import materialise

#: Sites of a tile.
SITES = 1 << 17


def site_differences(long: DataFrame, a: str = "control", b: str = "case") -> DataFrame:
    """chrom, pos, diff: mean of group ``b`` less that of ``a`` at each site that both have values of (chrom, pos, group, value)."""
    mean = lambda g: F.avg(F.when(F.col("group") == g, F.col("value")))
    return long.groupBy("chrom", "pos").agg((mean(b) - mean(a)).alias("diff")).where("diff is not null")


def _placed(sites: DataFrame, max_gap: int) -> DataFrame:
    """``sites`` with ``rank`` along the chromosome, ``block`` (a gap above ``max_gap`` begins one) and ``step`` to the site before."""
    last = F.struct("pos", "diff")
    rows = tiled(sites.select("chrom", "pos", "diff"), "pos")
    earlier = Window.partitionBy("chrom").orderBy("__tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = rows.groupBy("chrom", "__tile").agg(F.count(F.lit(1)).alias("__n"), F.max(last).alias("__end"))
    rows = rows.join(tiles.select("chrom", "__tile", F.sum("__n").over(earlier).alias("__before"), F.max("__end").over(earlier).alias("__last")), ["chrom", "__tile"])
    order = Window.partitionBy("chrom", "__tile").orderBy("pos")
    previous = F.coalesce(F.lag(last).over(order), F.col("__last"))
    rows = rows.withColumns({"rank": F.row_number().over(order) + F.coalesce("__before", F.lit(0)) - 1, "__prev": previous}).drop("__before", "__last")
    apart = F.col("__prev").isNull() | (F.col("pos") - F.col("__prev.pos") > max_gap)
    rows = rows.withColumns({"__new": F.when(apart, 1).otherwise(0), "step": F.when(~apart, F.col("diff") - F.col("__prev.diff"))}).drop("__prev")
    rows = with_carry(rows, ["chrom"], F.sum("__new"), F.sum, "__begun")
    block = F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce("__begun", F.lit(0))
    return rows.withColumn("block", block).select("chrom", "pos", "diff", "rank", "block", "step")


def noise(placed: DataFrame) -> DataFrame:
    """``noise``: the standard deviation of a site, from the steps between neighbours, which a few changes hardly move."""
    return placed.agg(F.sqrt(F.avg(F.col("step") * F.col("step")) / 2).alias("noise"))


def site_segments(sites: DataFrame, width: int = 10, least: int = 5, threshold: float = 4.0, max_gap: int = 300, sites_per_tile: int = SITES, level: float | None = None) -> DataFrame:
    """chrom, pos, diff and ``segment`` (a number that grows along the chromosome) of each site (chrom, pos, diff).

    A change point has at least ``least`` sites on either side before a gap of more than ``max_gap``, and a difference of
    means, weighted by the sites on both sides, of ``threshold`` times the noise (``level`` instead, where it is given).
    Of equal differences the first counts. Sites are different places; rows with nulls are left out.
    """
    if sites_per_tile < 2 * width:
        raise ValueError("a tile must hold twice as many sites as a window's width")
    placed = materialise(_placed(sites.dropna(subset=["chrom", "pos", "diff"]), max_gap), "placed-sites")
    own = F.floor(F.col("rank") / sites_per_tile)
    inside = F.col("rank") % sites_per_tile
    copies = F.array_compact(F.array(own, F.when(inside < 2 * width, own - 1), F.when(inside >= sites_per_tile - 2 * width, own + 1)))
    rows = placed.drop("step").withColumn("__own", own).withColumn("__tile", F.explode(copies))
    order = Window.partitionBy("chrom", "__tile", "block").orderBy("rank")
    left, right = order.rowsBetween(1 - width, 0), order.rowsBetween(1, width)
    n_left, n_right = F.count(F.lit(1)).over(left), F.count(F.lit(1)).over(right)
    weighted = F.abs(F.sum("diff").over(right) / n_right - F.sum("diff").over(left) / n_left) * F.sqrt(n_left * n_right / (n_left + n_right))
    rows = rows.withColumn("__stat", F.when((n_left >= least) & (n_right >= least), weighted))
    before, after = F.max("__stat").over(order.rowsBetween(-width, -1)), F.max("__stat").over(order.rowsBetween(1, width))
    peak = (before.isNull() | (F.col("__stat") > before)) & (after.isNull() | (F.col("__stat") >= after))
    rows = rows.withColumn("__peak", peak & F.col("__stat").isNotNull()).where("__tile = __own")
    spread = F.broadcast(placed.sparkSession.range(1).select(F.lit(level).alias("noise")) if level is not None else noise(placed))  # one row
    marked = rows.crossJoin(spread).withColumn("__change", F.when(F.col("__peak") & (F.col("__stat") >= threshold * F.col("noise")), 1).otherwise(0))
    marked = materialise(marked.select("chrom", "pos", "diff", "rank", "block", "__tile", "__change"), "change-points")
    counted = with_carry(marked, ["chrom"], F.sum("__change"), F.sum, "__changes")
    passed = F.sum("__change").over(Window.partitionBy("chrom", "__tile").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1))
    segment = F.col("block") + F.coalesce(passed, F.lit(0)) + F.coalesce("__changes", F.lit(0))
    return counted.select("chrom", "pos", "diff", segment.alias("segment"))


def segments(found: DataFrame) -> DataFrame:
    """chrom, segment, start, end, n_sites, mean_diff of the segments of :func:`site_segments`; ``end`` is past the last site."""
    return found.groupBy("chrom", "segment").agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"), F.count(F.lit(1)).alias("n_sites"), F.avg("diff").alias("mean_diff"))


def region_calls(long: DataFrame, a: str = "control", b: str = "case", min_sites: int = 5, min_diff: float = 0.1, **search) -> DataFrame:
    """chrom, start, end, n_sites, mean_diff, mean_a, mean_b, u, p, q: segments where two groups of samples differ.

    ``long`` has chrom, pos, sample, group, value. Segments with at least ``min_sites`` sites and a mean difference of
    ``min_diff`` are tested: by rank, on the mean of each sample over the segment; p values are adjusted over those.
    """
    found = site_segments(site_differences(long, a, b), **search)
    wanted = segments(found).where((F.col("n_sites") >= min_sites) & (F.abs("mean_diff") >= min_diff))
    values = long.join(found.select("chrom", "pos", "segment"), ["chrom", "pos"]).join(wanted.select("chrom", "segment"), ["chrom", "segment"], "left_semi")
    by_sample = values.groupBy("chrom", "segment", "sample", "group").agg(F.avg("value").alias("value")).withColumn("feature", F.concat_ws(":", "chrom", "segment"))
    tests = stats.adjust_p(stats.rank_p(stats.rank_sum(by_sample.select("feature", "sample", "group", "value"), a, b)))
    means = by_sample.groupBy("feature").agg(*(F.avg(F.when(F.col("group") == g, F.col("value"))).alias(name) for g, name in ((a, "mean_a"), (b, "mean_b"))))
    out = wanted.withColumn("feature", F.concat_ws(":", "chrom", "segment")).join(tests.select("feature", "u", "p", "q"), "feature", "left").join(means, "feature", "left")
    return out.select("chrom", "start", "end", "n_sites", "mean_diff", "mean_a", "mean_b", "u", "p", "q")
