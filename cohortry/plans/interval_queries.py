"""Interval queries over whole tables: events and orders are two sets of intervals.

Event types are chromosomes, seconds are positions, and an event's value is its length. Orders stand on the same
chromosomes, dealt by customer, at places that their keys scatter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import intervals, segments
from cohortry.plans.registry import query, table

E = """e AS (SELECT event_id AS ord, event_type AS chrom, (epoch_us(ts) - 1704067200000000) // 1000000 AS start, (epoch_us(ts) - 1704067200000000) // 1000000 + 1 + floor(value)::BIGINT AS "end", user_id, value FROM events)"""
O = """o AS (SELECT o_orderkey AS ord, ['purchase', 'view', 'click', 'signup', 'error'][o_custkey % 5 + 1] AS chrom, o_orderkey * 7919 % 2592000 AS start, o_orderkey * 7919 % 2592000 + 1 + o_custkey % 200 AS "end", o_totalprice AS value FROM orders)"""
T = f"""{O}, t AS (SELECT chrom, start, "end" FROM o)"""
MERGED = """b AS (SELECT chrom, start, "end", max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM t),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR start > before THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM b),
mg AS (SELECT chrom, min(start) AS start, max("end") AS "end" FROM i GROUP BY chrom, island)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - 1704067200000000) / 1000000)
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), F.col("event_type").alias("chrom"), start.alias("start"), "user_id", "value")
    return e.withColumn("end", F.col("start") + 1 + F.floor("value"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    chrom = F.element_at(F.array(*map(F.lit, ("purchase", "view", "click", "signup", "error"))), (F.col("o_custkey") % 5 + 1).cast("int"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ord"), chrom.alias("chrom"), (F.col("o_orderkey") * 7919 % 2592000).alias("start"), "o_custkey", F.col("o_totalprice").alias("value"))
    return o.withColumn("end", F.col("start") + 1 + F.col("o_custkey") % 200).drop("o_custkey")


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select("chrom", "start", "end")


@query(f'WITH {E}, {T}, {MERGED} SELECT chrom, start, "end" FROM mg')
def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.merge(targets(spark, sf_dir))


@query(f"""WITH {E}, {T}, {MERGED} SELECT e.chrom, greatest(e.start, mg.start) AS start, least(e."end", mg."end") AS "end", 'r' || ord || '__panel_' || (row_number() OVER (PARTITION BY ord ORDER BY mg.start) - 1) AS name
FROM e JOIN mg ON e.chrom = mg.chrom AND e.start < mg."end" AND e."end" > mg.start""")
def interval_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    source = e.withColumn("name", F.concat(F.lit("r"), "ord")).select("chrom", "start", "end", "name", "ord")
    return intervals.clip(source, targets(spark, sf_dir), 128).drop("ord")


@query(f'WITH {E}, {O} SELECT a.ord AS a, b.ord AS b FROM e a JOIN o b ON a.chrom = b.chrom AND a.start < b."end" AND a."end" > b.start')
def interval_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = events(spark, sf_dir).select("chrom", "start", "end", F.col("ord").alias("a"))
    right = orders(spark, sf_dir).select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"), F.col("ord").alias("b"))
    return intervals.overlap_join(left, right, 64).select("a", "b")


@query(f'WITH {E}, {T} SELECT ord, chrom, start, "end" FROM e WHERE EXISTS (SELECT 1 FROM t WHERE t.chrom = e.chrom AND e.start < t."end" AND e."end" > t.start)')
def interval_overlap_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    right = targets(spark, sf_dir).withColumnsRenamed({"start": "r_start", "end": "r_end"})
    return intervals.overlap_join(e.select("ord", "chrom", "start", "end"), right, 64, how="left_semi")


@query(f"""WITH {E}, {O}, r AS (SELECT chrom, start, "end", 'r' || ord AS name FROM o), p AS (SELECT chrom, start AS pos, value FROM e)
SELECT r.chrom, r.start, r."end", r.name, round(avg(p.value) + 1e-9, 6) AS mean FROM r LEFT JOIN p ON p.chrom = r.chrom AND p.pos > r.start AND p.pos <= r."end" GROUP BY ALL""")
def region_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = orders(spark, sf_dir).select("chrom", "start", "end", F.concat(F.lit("r"), "ord").alias("name"))
    points = events(spark, sf_dir).select("chrom", F.col("start").alias("pos"), "value")
    return intervals.region_means(regions, points, 64).withColumn("mean", F.round(F.col("mean") + 1e-9, 6))


@query(f"""WITH {E}, s AS (SELECT chrom, start, max("end") AS "end", user_id % 3 AS sample, max(value) AS value FROM e GROUP BY chrom, start, user_id % 3),
p AS (SELECT DISTINCT chrom, unnest([start, "end"]) AS pt FROM s), c AS (SELECT chrom, pt AS start, lead(pt) OVER (PARTITION BY chrom ORDER BY pt) AS "end" FROM p)
SELECT c.chrom, c.start, c."end", s.sample, s.value FROM c JOIN s ON s.chrom = c.chrom AND s.start <= c.start AND s."end" >= c."end" WHERE c."end" IS NOT NULL""")
def interval_union_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("sample", F.col("user_id") % 3)
    s = e.groupBy("chrom", "start", "sample").agg(F.max("end").alias("end"), F.max("value").alias("value"))
    return intervals.atomic_union(s)


@query(f"""WITH {E}, {O}, w AS (SELECT chrom, start, start + 100 AS "end", 'w' || ord AS name FROM o), rd AS (SELECT chrom, start, "end" FROM e WHERE "end" - start + 1 BETWEEN 100 AND 220),
s AS (SELECT chrom, start, "end", name, unnest(range(start, "end" + 1)) AS pos FROM w), sc AS (SELECT s.chrom, s.start, s."end", s.name, s.pos, coalesce(sum(CASE WHEN rd.chrom IS NULL THEN 0 WHEN rd.start <= pos - 60 AND rd."end" >= pos + 60 THEN 1 ELSE -1 END), 0) AS score
FROM s LEFT JOIN rd ON rd.chrom = s.chrom AND rd.start < pos + 60 AND rd."end" > pos - 60 GROUP BY ALL)
SELECT chrom, start, "end", name, string_agg(score::VARCHAR, ',' ORDER BY pos) AS wps, round(avg(score) + 1e-9, 6) AS mean_wps FROM sc GROUP BY ALL""")
def protection_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    windows = orders(spark, sf_dir).select("chrom", "start", (F.col("start") + 100).alias("end"), F.concat(F.lit("w"), "ord").alias("name"))
    out = intervals.protection_scores(windows, e.select("chrom", "start", "end"), step=1)
    return out.withColumn("wps", F.array_join(F.col("wps").cast("array<string>"), ",")).withColumn("mean_wps", F.round(F.col("mean_wps") + 1e-9, 6))


CHROMS = ["purchase", "view", "click", "signup"]


@query(f"""WITH {E}, c AS (SELECT * FROM (VALUES ('purchase', 1), ('view', 2), ('click', 3), ('signup', 4)) v(chrom, o))
SELECT ord, chrom, row_number() OVER (ORDER BY o, start, "end") - 1 AS gpos FROM (SELECT DISTINCT ON (chrom, start, "end") * FROM e ORDER BY chrom, start, "end", ord) JOIN c USING (chrom)""")
def genome_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).groupBy("chrom", "start", "end").agg(F.min("ord").alias("ord"))
    return intervals.genome_order(e, CHROMS).select("ord", "chrom", "gpos")


@query(f"""WITH {E}, c AS (SELECT * FROM (VALUES ('purchase', 1), ('view', 2), ('click', 3), ('signup', 4)) v(chrom, o)), g AS (SELECT chrom, row_number() OVER (ORDER BY o, start, "end", ord) - 1 AS gpos FROM e JOIN c USING (chrom)) SELECT chrom, min(gpos) AS first_gpos FROM g GROUP BY chrom""")
def chromosome_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.chrom_positions(intervals.genome_order(events(spark, sf_dir), CHROMS))


@query(f"""WITH {E}, {O}, r AS (SELECT chrom, (start + "end") // 2 AS centre FROM o), b AS (SELECT chrom, centre, unnest(range(-40, 40)) AS off FROM r),
sg AS (SELECT chrom, pos, sum(value) AS value FROM (SELECT chrom, round_even(value, 0) AS value, unnest(range(start, "end")) AS pos FROM e) GROUP BY chrom, pos), s AS (SELECT off, coalesce(sum(sg.value), 0) AS total FROM b LEFT JOIN sg ON sg.chrom = b.chrom AND sg.pos = centre + off GROUP BY off),
m AS (SELECT off, total / (SELECT count(*) FROM r) AS mean FROM s)
SELECT off::BIGINT AS "offset", round(mean + 1e-9, 6) AS mean, round(sum(mean) OVER (ORDER BY off ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) / 10 + 1e-9, 6) AS smooth FROM m""")
def signal_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = intervals.profile(orders(spark, sf_dir), events(spark, sf_dir).withColumn("value", F.rint("value")), 40, 40)
    return out.select("offset", F.round(F.col("mean") + 1e-9, 6).alias("mean"), F.round(F.col("smooth") + 1e-9, 6).alias("smooth"))


@query(f"""WITH {E}, c AS (SELECT chrom, (start - floor((250 - ("end" - start)) / 2) + pos)::BIGINT AS cell_start, pos::INTEGER AS pos FROM e, (SELECT unnest(range(0, 250)) AS pos)) SELECT chrom, pos, count(*) AS n, min(cell_start) AS first, max(cell_start) AS last, sum(cell_start)::BIGINT AS total FROM c GROUP BY ALL""")
def centred_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = intervals.centred_cells(events(spark, sf_dir)).withColumn("cell_start", F.col("cell_start").cast("long"))
    return cells.groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("n"), F.min("cell_start").alias("first"), F.max("cell_start").alias("last"), F.sum("cell_start").alias("total"))


@query(f"""WITH {E}, z AS (SELECT chrom, max(start) AS length FROM e WHERE chrom <> 'error' GROUP BY chrom)
SELECT ord, CASE WHEN length IS NULL THEN 'unknown contig' WHEN start < 0 THEN 'negative start' WHEN "end" <= start THEN 'empty interval' ELSE 'past the end' END AS reason FROM e LEFT JOIN z USING (chrom) WHERE length IS NULL OR start < 0 OR "end" <= start OR "end" > length""")
def invalid_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    sizes = e.where("chrom <> 'error'").groupBy("chrom").agg(F.max("start").alias("length"))
    return intervals.out_of_bounds(e, sizes).select("ord", "reason")


@query("""WITH s AS (SELECT 'chr' || (o_custkey % 5) AS chrom, o_orderkey AS pos, ((o_orderkey // 6000 % 3) * 8 + o_custkey % 7)::DOUBLE AS diff FROM orders),
p AS (SELECT *, lag(pos) OVER c AS ppos, lag(diff) OVER c AS pdiff FROM s WINDOW c AS (PARTITION BY chrom ORDER BY pos)),
b AS (SELECT *, ppos IS NULL OR pos - ppos > 60 AS fresh, sum((ppos IS NULL OR pos - ppos > 60)::INT) OVER (PARTITION BY chrom ORDER BY pos) AS block FROM p),
z AS (SELECT sqrt(avg((diff - pdiff) * (diff - pdiff)) / 2) AS noise FROM b WHERE NOT fresh),
n AS (SELECT *, count(*) OVER l AS nl, count(*) OVER r AS nr, sum(diff) OVER l AS sl, sum(diff) OVER r AS sr FROM b
  WINDOW l AS (PARTITION BY chrom, block ORDER BY pos ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), r AS (PARTITION BY chrom, block ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING)),
t AS (SELECT *, CASE WHEN nl >= 6 AND nr >= 6 THEN abs(sr / nr - sl / nl) * sqrt(nl * nr / (nl + nr)) END AS stat FROM n),
k AS (SELECT *, max(stat) OVER (PARTITION BY chrom, block ORDER BY pos ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS before, max(stat) OVER (PARTITION BY chrom, block ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING) AS after FROM t),
m AS (SELECT k.*, (stat >= 4 * noise AND (before IS NULL OR stat > before) AND (after IS NULL OR stat >= after))::INT AS change FROM k, z),
g AS (SELECT *, block + coalesce(sum(change) OVER (PARTITION BY chrom ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS segment FROM m)
SELECT chrom, segment::BIGINT AS segment, min(pos) AS start, max(pos) + 1 AS "end", count(*) AS n_sites, round(avg(diff) + 1e-9, 6) AS mean_diff FROM g GROUP BY chrom, segment""")
def change_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sites: levels that change with the key, the customer as noise."""
    level = F.floor(F.col("o_orderkey") / 6000) % 3 * 8 + F.col("o_custkey") % 7
    sites = table(spark, sf_dir, "orders").select(F.concat(F.lit("chr"), F.col("o_custkey") % 5).alias("chrom"), F.col("o_orderkey").alias("pos"), level.cast("double").alias("diff"))
    out = segments.segments(segments.site_segments(sites, width=12, least=6, max_gap=60))
    return out.withColumn("mean_diff", F.round(F.col("mean_diff") + 1e-9, 6))
