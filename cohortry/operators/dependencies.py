"""Stages and what they need as tables: the closure of wanted stages, and the order in which to run them.

Both go on by joins until nothing is left to add, a written table for each round; only counts reach the driver. Rounds are
as many as the longest chain of needs, so no join of theirs broadcasts: tables just small enough for that would add up there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortry.operators.intervals import with_carry
from cohortry.session import materialise

#: Larger than any place among a stage's needs.
LAST = 2**31 - 1


def _met(left: DataFrame, right: DataFrame, how: str = "inner", by: str = "stage") -> DataFrame:
    """A join in which neither side goes through the driver."""
    return left.join(right.hint("merge"), by, how)


def closure(needs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``stage``: every stage of ``wanted`` (stage) and all that those need (stage, need), directly or not; cycles are fine."""
    new = materialise(wanted.select("stage").where("stage is not null").distinct(), "stages")
    found = [new]
    while new.count():
        reached = reduce(DataFrame.union, found)
        further = _met(_met(needs, new).select(F.col("need").alias("stage")).distinct(), reached, "left_anti")
        new = materialise(further, "stages")
        found.append(new)
    return reduce(DataFrame.union, found)


def _members(edges: DataFrame) -> list[str]:
    """Some stages of cycles: what is left when stages that need nothing else of the rest are taken away again and again."""
    left, before = materialise(edges.select("stage", "need"), "cycle"), -1
    while (n := left.count()) != before:
        before = n
        left = materialise(_met(left, left.select(F.col("stage").alias("need")).distinct(), "left_semi", "need"), "cycle")
    return [str(r[0]) for r in left.select("stage").distinct().orderBy("stage").limit(20).collect()]


def run_order(stages: DataFrame, needs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``stage`` and ``at`` (from 0): wanted stages with all that they need, each after what it needs.

    ``needs`` has stage, need, ord and ``wanted`` stage, ord: the order is that of going through the wanted stages and the
    needs of each in turn, to the end of every chain first. A stage that ``stages`` does not have, or a cycle, is an error.

    That order needs no walk: each stage is met on the first path to it, in the order of the places along paths, and stands
    after all longer paths that begin alike.
    """
    inside = materialise(closure(needs, wanted), "closure")
    unknown = _met(inside, stages.select("stage"), "left_anti").orderBy("stage").first()
    if unknown is not None:
        raise ValueError(f"unknown stage {unknown[0]}")
    edges = materialise(_met(needs, inside).groupBy("stage", "need").agg(F.min("ord").cast("int").alias("ord")), "needs")
    roots = wanted.where("stage is not null").groupBy("stage").agg(F.array(F.min("ord").cast("int")).alias("path"))
    known = materialise(_met(inside, roots, "left"), "roots")
    n, placed = inside.count(), None
    while True:
        waiting = edges if placed is None else _met(edges, placed.select("stage"), "left_anti")
        rest = known if placed is None else _met(known, placed.select("stage"), "left_anti")
        ready = _met(rest, waiting.select(F.col("need").alias("stage")).distinct(), "left_anti")
        if placed is None:
            paths = ready
        else:
            through = _met(edges, placed).groupBy(F.col("need").alias("stage")).agg(F.min(F.concat("path", F.array("ord"))).alias("through"))
            paths = _met(ready, through, "left").select("stage", F.least("path", "through").alias("path"))
        paths = materialise(paths, "run-order")
        if not paths.count():
            break
        placed = paths if placed is None else materialise(placed.union(paths), "run-order")
    if placed is None or placed.count() < n:
        if n == 0:
            return inside.select("stage", F.lit(0).cast("long").alias("at"))
        left = edges if placed is None else _met(edges, placed.select("stage"), "left_anti")
        raise ValueError(f"cycle among {', '.join(_members(left))}")
    key = F.concat("path", F.array(F.lit(LAST)))
    ranged = materialise(placed.select("stage", key.alias("key")).repartitionByRange("key").withColumn("__tile", F.spark_partition_id()).withColumn("all", F.lit(1)), "run-order")
    carried = with_carry(ranged, ["all"], F.count(F.lit(1)), F.sum, "__before")
    at = F.row_number().over(Window.partitionBy("__tile").orderBy("key")) + F.coalesce("__before", F.lit(0)) - 1
    return carried.select("stage", at.cast("long").alias("at"))
