"""Connected components of a link table as iterated joins; nothing of the graph reaches the driver but a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import materialise


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node of ``links`` (columns ``a`` and ``b``).

    Large-star and small-star steps alternate until nothing changes; each round is written to the shared folder, so a
    lost executor repeats one round at most. Self-links, repeated links and links in both directions are fine; rows
    with a null end are ignored. No links give no rows. Not converging within ``rounds`` raises.
    """
    edges = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialise(edges, "links")
    before, rows = None, edges.count()
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(small.union(least).where("u <> v").select("u", "v").distinct(), "links", rows)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            root = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return root.union(root.select(F.col("root").alias("node"), "root")).distinct()
        before, rows = now, now[0]
    raise RuntimeError(f"components did not settle in {rounds} rounds")
