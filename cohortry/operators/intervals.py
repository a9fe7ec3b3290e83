"""Operators on half-open intervals (chrom, start, end): merging, clipping, overlap joins, windows and profiles.

Range joins get an equality first: both sides are cut into bins of a fixed width, pairs meet in a bin and are kept only in
the bin where their overlap begins, so that each pair appears once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Positions of a tile. Running values go on within tiles; what one tile hands to the next is one row for each tile.
TILE = 1 << 22
#: Positions of a tile whose windows one task scores at a time.
SCORED = 1 << 14


def tiled(rows: DataFrame, at: str) -> DataFrame:
    """``rows`` with the number of the tile that position ``at`` lies in, as ``__tile``."""
    return rows.withColumn("__tile", F.floor(F.col(at) / TILE))


def with_carry(rows: DataFrame, keys: Sequence[str], own: Column, total: Callable[[str], Column], name: str, from_later: bool = False) -> DataFrame:
    """``rows`` (of :func:`tiled`) with ``name``: the aggregate ``own`` of each tile, added up by ``total`` over all earlier tiles of the key.

    The first tile has null. With ``from_later`` it is the later tiles that count.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc("__tile") if from_later else F.asc("__tile"))
    tiles = rows.groupBy(*keys, "__tile").agg(own.alias("__own"))
    carried = tiles.select(*(F.col(k).alias(f"__key_{k}") for k in keys), F.col("__tile").alias("__at"), total("__own").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias(name))
    same = F.col("__tile") == F.col("__at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    return rows.join(carried, same).drop("__at", *(f"__key_{k}" for k in keys))


def merge(intervals: DataFrame, keys: Sequence[str] = ("chrom",)) -> DataFrame:
    """Union of the intervals of each key; intervals that touch become one. Keys, ``start``, ``end``.

    Windows run within tiles of a key; each tile is told how far the earlier ones reach and how many unions they began.
    """
    rows = with_carry(tiled(intervals, "start"), keys, F.max("end"), F.max, "__reach")
    order = Window.partitionBy(*keys, "__tile").orderBy("start", "end")
    before = F.greatest(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.col("__reach"))
    marked = rows.withColumn("__new", F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0))
    counted = with_carry(marked, keys, F.sum("__new"), F.sum, "__begun")
    island = F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce("__begun", F.lit(0))
    return counted.withColumn("__island", island).groupBy(*keys, "__island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__island")


def _bins(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    low, high = F.floor(F.col(start) / width), F.floor(F.greatest(F.col(end) - 1, F.col(start)) / width)
    return df.withColumn("__bin", F.explode(F.sequence(low, high)))


def overlap_join(left: DataFrame, right: DataFrame, width: int, keys: Sequence[str] = ("chrom",), how: str = "inner") -> DataFrame:
    """Pairs of rows whose intervals overlap. ``left`` has keys, ``start`` and ``end``; ``right`` has ``r_start`` and ``r_end``.

    ``width`` should be near the usual length of an interval: a row is repeated once for each bin that it spans. ``how``
    is inner, or left_semi for the left rows that overlap anything.
    """
    a, b = _bins(left, "start", "end", width), _bins(right, "r_start", "r_end", width)
    touch = (F.col("start") < F.col("r_end")) & (F.col("end") > F.col("r_start"))
    if how == "left_semi":
        wide = b.withColumnsRenamed({k: f"__{k}" for k in keys} | {"__bin": "__rbin"})
        cond = touch & (F.col("__bin") == F.col("__rbin"))
        for k in keys:
            cond = cond & (F.col(k) == F.col(f"__{k}"))
        return a.join(wide, cond, "left_semi").drop("__bin").distinct()
    once = F.floor(F.greatest("start", "r_start") / width) == F.col("__bin")
    return a.join(b, [*keys, "__bin"]).where(touch & once).drop("__bin")


def clip(source: DataFrame, target: DataFrame, width: int) -> DataFrame:
    """Pieces of the source intervals inside the merged target, numbered from 0 in each source row by place.

    ``source`` has chrom, start, end, name and ord (its order); the pieces are named ``name__panel_k`` and keep ``ord``.
    """
    inside = merge(target).withColumnsRenamed({"start": "r_start", "end": "r_end"})
    cut = overlap_join(source, inside, width)
    piece = F.row_number().over(Window.partitionBy("ord").orderBy("r_start")) - 1
    return cut.select("chrom", F.greatest("start", "r_start").alias("start"), F.least("end", "r_end").alias("end"), F.concat("name", F.lit("__panel_"), piece.cast("string")).alias("name"), "ord")


def region_means(regions: DataFrame, points: DataFrame, width: int) -> DataFrame:
    """Mean of the points with ``start < pos <= end`` for every region; a region without points has null.

    ``regions`` has chrom, start, end, name; ``points`` has chrom, pos, value. Points meet regions in bins.
    """
    binned = regions.withColumn("__bin", F.explode(F.sequence(F.floor((F.col("start") + 1) / width), F.floor(F.col("end") / width))))
    at = points.withColumn("__bin", F.floor(F.col("pos") / width))
    met = binned.join(at, ["chrom", "__bin"]).where((F.col("pos") > F.col("start")) & (F.col("pos") <= F.col("end")))
    found = met.groupBy("chrom", "start", "end", "name").agg(F.avg("value").alias("mean"))
    keys = ["chrom", "start", "end", "name"]
    same = None
    got = found.select(*(F.col(k).alias(f"__{k}") for k in keys), "mean")
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__{k}"))
        same = c if same is None else same & c
    return regions.select(*keys).join(got, same, "left").select(*keys, "mean")


def atomic_union(samples: DataFrame) -> DataFrame:
    """Intervals of several samples split at every end of any of them: chrom, start, end, sample, value, nothing filled in.

    ``samples`` has chrom, start, end, sample, value. Each interval is cut at the break points inside it, which are numbered
    by windows over tiles, without pairing intervals.
    """
    points = tiled(samples.select("chrom", F.explode(F.array("start", "end")).alias("at")).distinct(), "at")
    points = with_carry(points, ["chrom"], F.count(F.lit(1)), F.sum, "__before")
    points = with_carry(points, ["chrom"], F.min("at"), F.min, "__next", from_later=True)
    order = Window.partitionBy("chrom", "__tile").orderBy("at")
    number = F.row_number().over(order) + F.coalesce("__before", F.lit(0))
    cells = points.select("chrom", F.col("at").alias("start"), F.coalesce(F.lead("at").over(order), "__next").alias("end"), number.alias("cell")).where("end is not null")
    first = cells.select("chrom", F.col("start").alias("start"), F.col("cell").alias("c0"))
    last = cells.select("chrom", F.col("end").alias("end"), F.col("cell").alias("c1"))
    spans = samples.join(first, ["chrom", "start"]).join(last, ["chrom", "end"])
    split = spans.select("chrom", "sample", "value", F.explode(F.sequence("c0", "c1")).alias("cell"))
    return split.join(cells, ["chrom", "cell"]).select("chrom", "start", "end", "sample", "value")


def protection_scores(windows: DataFrame, reads: DataFrame, step: int = 10, half: int = 60, low: int = 100, high: int = 220) -> DataFrame:
    """Window protection scores: chrom, start, end, name, ``wps`` (array in order of position) and ``mean_wps``.

    At every ``step``-th position from start to end (each one with 1), both included, each read of a span (end - start + 1) from
    ``low`` to ``high`` that overlaps position +- ``half`` adds 1 if it spans that window and takes 1 off if it does not. Each read
    counts once.

    Different windows and reads, with their number, meet in tiles of positions. There a score comes from sorted ends: the reads that
    begin before a place less those that end before it, so no row is made for a position or a pair. A place is scored once for all
    windows of its tile.
    """
    spans = reads.where((F.col("end") - F.col("start") + 1).between(low, high) & F.col("chrom").isNotNull()).groupBy("chrom", "start", "end").agg(F.count(F.lit(1)).alias("n"))
    tile = lambda c: F.floor(c / SCORED)
    near = spans.select("chrom", F.explode(F.sequence(tile(F.col("start") - half), tile(F.col("end") + half))).alias("tile"), F.col("start").cast("long").alias("r_start"), F.col("end").cast("long").alias("r_end"), "n")
    different = windows.select("chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")).where("start is not null and end is not null").distinct()
    pieces = different.withColumn("tile", F.explode(F.sequence(tile(F.col("start")), tile(F.col("end")))))

    def run(own: pa.Table, met: pa.Table) -> pa.Table:
        chrom, start, end, at = own.column("chrom").combine_chunks(), *(own.column(c).to_numpy() for c in ("start", "end", "tile"))
        r_start, r_end, n = (met.column(c).to_numpy() for c in ("r_start", "r_end", "n"))
        first = np.maximum(0, -(-(at * SCORED - start) // step))
        sizes = np.maximum(0, (np.minimum(end, (at + 1) * SCORED - 1) - start) // step + 1 - first)
        before = np.cumsum(sizes) - sizes
        pos = np.repeat(start + step * (first - before), sizes) + step * np.arange(sizes.sum())

        def fewer(values: np.ndarray, weights: np.ndarray, limits: np.ndarray, side: str) -> np.ndarray:
            order = np.argsort(values)
            return np.concatenate([[0], np.cumsum(weights[order])])[np.searchsorted(values[order], limits, side)]

        wide, base = r_end - r_start >= 2 * half, at[0] * SCORED if len(at) else 0
        place = np.flatnonzero(np.bincount(pos - base, minlength=SCORED)) + base
        over = fewer(r_start, n, place + half, "left") - fewer(r_end, n, place - half, "right")
        whole = fewer(r_start[wide] + half, n[wide], place, "right") - fewer(r_end[wide] - half, n[wide], place, "left")
        score = np.zeros(SCORED, np.int64)
        score[place - base] = 2 * whole - over
        lists = pa.LargeListArray.from_arrays(pa.array(np.append(before, sizes.sum())), pa.array(score[pos - base])).cast(pa.list_(pa.int64()))
        return pa.table({"chrom": chrom, "start": start, "end": end, "tile": at, "scores": lists})

    schema = "chrom string, start long, end long, tile long, scores array<long>"
    scored = pieces.groupBy("chrom", "tile").cogroup(near.groupBy("chrom", "tile")).applyInArrow(run, schema)
    joined = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("tile", "scores"))), lambda s: s["scores"]))
    found = scored.groupBy(F.col("chrom").alias("__chrom"), F.col("start").alias("__start"), F.col("end").alias("__end")).agg(joined.alias("wps"))
    same = F.col("chrom").eqNullSafe(F.col("__chrom")) & (F.col("start") == F.col("__start")) & (F.col("end") == F.col("__end"))
    total = F.aggregate("wps", F.lit(0).cast("long"), lambda a, b: a + b)
    return windows.select("chrom", "start", "end", "name").join(found, same).select("chrom", "start", "end", "name", "wps", (total / F.size("wps")).alias("mean_wps"))


def genome_order(rows: DataFrame, chroms: Sequence[str]) -> DataFrame:
    """``gpos``: place of each row, from 0, in the order of the listed chromosomes and start; other chromosomes are left out.

    Ranks are taken within tiles of a chromosome; a tile's offset is the number of rows of those before it.
    """
    order = F.array_position(F.array(*(F.lit(c) for c in chroms)), F.col("chrom"))
    ranked = with_carry(tiled(rows.withColumn("chrom_ord", order).where("chrom_ord > 0"), "start"), ["chrom_ord"], F.count(F.lit(1)), F.sum, "__before")
    sizes = ranked.groupBy("chrom_ord").agg(F.count(F.lit(1)).alias("__n"))  # a row for each listed chromosome
    offsets = sizes.withColumn("__off", F.coalesce(F.sum("__n").over(Window.orderBy("chrom_ord").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    at = F.row_number().over(Window.partitionBy("chrom_ord", "__tile").orderBy("start", "end")) - 1 + F.coalesce("__before", F.lit(0))
    return ranked.withColumn("__at", at).join(F.broadcast(offsets), "chrom_ord").withColumn("gpos", F.col("__at") + F.col("__off")).drop("__at", "__off", "__before", "__tile", "chrom_ord")


def chrom_positions(ordered: DataFrame) -> DataFrame:
    """First ``gpos`` of each chromosome."""
    return ordered.groupBy("chrom").agg(F.min("gpos").alias("first_gpos"))


def moving_average(df: DataFrame, keys: Sequence[str], order: str, value: str, width: int, out: str) -> DataFrame:
    """Mean over ``width`` neighbours, from width/2 before to (width - 1)/2 after; past the ends values count as 0."""
    near = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(width // 2), (width - 1) // 2)
    return df.withColumn(out, F.sum(value).over(near) / width)


def whole_windows(regions: DataFrame, lengths: DataFrame, up: int, down: int) -> DataFrame:
    """chrom and centre of the regions whose window around the centre lies on its chromosome as a whole.

    ``lengths`` has chrom and length, a row for each chromosome; regions on others are left out.
    """
    centres = regions.select("chrom", F.floor((F.col("start") + F.col("end")) / 2).alias("centre"))
    return centres.join(lengths, "chrom").where((F.col("centre") >= up) & (F.col("centre") + down <= F.col("length"))).select("chrom", "centre")


def profile(regions: DataFrame, signal: DataFrame, up: int, down: int, smooth: int = 10) -> DataFrame:
    """Mean signal at each offset from the regions' centres, and its moving average.

    ``signal`` has chrom, start, end, value (intervals); a base without signal counts 0. Columns: ``offset``, ``mean``, ``smooth``.
    """
    centres = regions.select("chrom", F.floor((F.col("start") + F.col("end")) / 2).alias("centre"))
    boxes = centres.select("chrom", "centre", (F.col("centre") - up).alias("start"), (F.col("centre") + down).alias("end"))
    met = overlap_join(boxes, signal.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"), "value"), up + down)
    bases = met.select(F.explode(F.sequence(F.greatest("start", "r_start") - F.col("centre"), F.least("end", "r_end") - 1 - F.col("centre"))).alias("offset"), "value")
    n = centres.agg(F.count(F.lit(1)).alias("n"))
    sums = bases.groupBy("offset").agg(F.sum("value").alias("total"))
    spark = regions.sparkSession
    dense = spark.range(-up, down).select(F.col("id").alias("offset")).crossJoin(F.broadcast(n))
    means = dense.join(sums, "offset", "left").select("offset", (F.coalesce("total", F.lit(0.0)) / F.col("n")).alias("mean"))
    return moving_average(means.withColumn("__all", F.lit(1)), ["__all"], "offset", "mean", smooth, "smooth").drop("__all")


def centred_cells(fragments: DataFrame, window: int = 250, cell: int = 2) -> DataFrame:
    """Cells of a window centred on each fragment: ``pos`` from 0, ``start``, ``end`` and all other columns."""
    half = F.floor((F.lit(window) - (F.col("end") - F.col("start"))) / 2)
    cells = fragments.withColumn("pos", F.explode(F.sequence(F.lit(0), F.lit(window - 1))))
    first = F.col("start") - half + F.col("pos")
    return cells.withColumn("cell_start", first).withColumn("cell_end", first + cell)


def position_id(chrom: Column, start: Column) -> Column:
    """Name of a one-base site, counted from 1: chromosome, underscore, start + 1."""
    return F.concat_ws("_", chrom, (start + 1).cast("string"))


def out_of_bounds(intervals: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows that are no valid interval of the genome, with a ``reason``. ``sizes`` has chrom and length."""
    with_size = intervals.join(sizes.select("chrom", F.col("length").alias("__len")), "chrom", "left")
    reason = (
        F.when(F.col("__len").isNull(), "unknown contig")
        .when(F.col("start") < 0, "negative start")
        .when(F.col("end") <= F.col("start"), "empty interval")
        .when(F.col("end") > F.col("__len"), "past the end")
    )
    return with_size.withColumn("reason", reason).where("reason is not null").drop("__len")
