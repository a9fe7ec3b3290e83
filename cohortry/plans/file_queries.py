"""Queries that write the tables as indexed genome files, ledgers and kept stages to the shared folder, and read those back.

Line items are alignments on five chromosomes, suppliers are regions; events are a signal and orders its windows.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import dependencies, fragments
from cohortry.plans.interval_queries import E, O, events, orders
from cohortry.plans.registry import query, table
from cohortry.plans.stages import Stage, run
from cohortry.session import shared_folder
from cohortry.sources import alignments, signals, table_functions
from cohortry.streaming import ledger

CHROMS = [(f"chr{i}", 1_000_400) for i in range(1, 6)]
CIGARS = ("50M", "20M3D30M", "10S40M", "25M1000N25M", "50M2I8M")
A = """al AS (SELECT 'r' || l_orderkey AS qname, (l_partkey % 4096 & ~4)::INTEGER AS flag, 'chr' || (l_suppkey % 5 + 1) AS chrom, (l_partkey * 7919 + l_orderkey * 31 + l_linenumber) % 999000 AS start, [50, 53, 40, 1050, 58][l_linenumber % 5 + 1] AS span, least(greatest(l_quantity::INTEGER - 10, 0), 60) AS mapq, l_quantity::INTEGER AS tlen FROM lineitem)"""


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as alignments; none is flagged as unmapped."""
    cigar = F.element_at(F.array(*map(F.lit, CIGARS)), (F.col("l_linenumber") % 5 + 1).cast("int"))
    chrom = F.concat(F.lit("chr"), (F.col("l_suppkey") % 5 + 1).cast("string"))
    flag = (F.col("l_partkey") % 4096).cast("int").bitwiseAND(F.lit(~4))
    quantity = F.col("l_quantity").cast("int")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("r"), F.col("l_orderkey")).alias("qname"), flag.alias("flag"), chrom.alias("chrom"), ((F.col("l_partkey") * 7919 + F.col("l_orderkey") * 31 + F.col("l_linenumber")) % 999000).alias("start"),
        F.least(F.greatest(quantity - 10, F.lit(0)), F.lit(60)).alias("mapq"), cigar.alias("cigar"), quantity.cast("long").alias("template_length"),
    )


def alignment_files(spark: SparkSession, sf_dir: str) -> str:
    folder = f"{shared_folder(spark)}/alignments-{uuid.uuid4().hex}"
    alignments.write_alignments(reads(spark, sf_dir), folder, CHROMS)
    return folder


@query(f"""WITH {A} SELECT chrom, flag & 64 <> 0 AS first_mate, count(*) AS n, count(*) FILTER (flag & 1024 <> 0) AS duplicate, sum(start)::BIGINT AS starts, sum(start + span)::BIGINT AS ends, sum(mapq)::BIGINT AS mapq, sum(tlen)::BIGINT AS lengths, count(DISTINCT qname) AS names FROM al GROUP BY ALL""")
def alignment_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full scan of alignment files; only the columns asked for are decoded."""
    rows = alignments.read_alignments(spark, alignment_files(spark, sf_dir), ["qname", "flag", "chrom", "start", "end", "mapq", "template_length"])
    total = lambda c, name: F.sum(c).cast("long").alias(name)
    return rows.groupBy("chrom", fragments.has_flag(F.col("flag"), 0x40).alias("first_mate")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(fragments.has_flag(F.col("flag"), 0x400), 1)).alias("duplicate"),
        total("start", "starts"), total("end", "ends"), total("mapq", "mapq"), total("template_length", "lengths"), F.count_distinct("qname").alias("names"),
    )


@query(f"""WITH {A}, r AS (SELECT s_suppkey, 'chr' || (s_suppkey % 5 + 1) AS chrom, s_suppkey * 104729 % 990000 AS low, s_suppkey * 104729 % 990000 + 100 + s_suppkey % 900 AS high FROM supplier)
SELECT s_suppkey, count(*) AS n, min(al.start) AS first, sum(flag)::BIGINT AS flags FROM r JOIN al ON al.chrom = r.chrom AND al.start < high AND al.start + span > low GROUP BY s_suppkey""")
def alignment_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments over each supplier's region, read by the files' indexes."""
    s = F.col("s_suppkey")
    low = s * 104729 % 990000
    regions = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("chr"), (s % 5 + 1).cast("string")).alias("chrom"), low.alias("start"), (low + 100 + s % 900).alias("end"))
    counts = alignments.region_totals(spark, alignment_files(spark, sf_dir), regions, ["flag"]).withColumnRenamed("flag", "flags")
    asked = regions.withColumnsRenamed({"chrom": "region_chrom", "start": "region_start", "end": "region_end"})
    return asked.join(counts, ["region_chrom", "region_start", "region_end"]).select("s_suppkey", "n", "first", "flags")


SECONDS = 2_592_000


@query(f"""WITH {E}, {O}, sg AS (SELECT chrom, start AS pos, sum(round_even(value, 0)) AS value FROM e WHERE start < {SECONDS} GROUP BY chrom, start), r AS (SELECT chrom, (start + "end") // 2 AS centre FROM o WHERE (start + "end") // 2 >= 20000 AND (start + "end") // 2 + 20000 <= {SECONDS} AND chrom IN (SELECT chrom FROM sg)),
h AS (SELECT pos - centre AS off, value FROM r JOIN sg ON sg.chrom = r.chrom AND pos >= centre - 20000 AND pos < centre + 20000)
SELECT floor(off / 100.0)::BIGINT AS cell, round(sum(value) / (SELECT count(*) FROM r) + 1e-9, 6) AS mean FROM h GROUP BY cell""")
def signal_file_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean signal around orders, from signal files and over windows that lie on their chromosome as a whole."""
    signal = events(spark, sf_dir).where(F.col("start") < SECONDS).groupBy("chrom", "start").agg(F.sum(F.rint("value")).alias("value")).withColumn("end", F.col("start") + 1)
    folder = f"{shared_folder(spark)}/signals-{uuid.uuid4().hex}"
    signals.write_signal(signal, folder, [(c, SECONDS) for c in ("purchase", "view", "click", "signup", "error")])
    out = signals.window_profile(spark, folder, orders(spark, sf_dir), 20_000, 20_000)
    cells = out.groupBy(F.floor(F.col("offset") / 100).alias("cell")).agg(F.sum("mean").alias("mean"))
    return cells.where("mean <> 0").select("cell", F.round(F.col("mean") + 1e-9, 6).alias("mean"))


@query(f"""WITH {E} SELECT chrom, count(*) AS n, sum(start)::BIGINT AS starts, sum(value) AS total FROM (SELECT chrom, start, sum(round_even(value, 0)) AS value FROM e WHERE start >= 1000000 AND start < 1200000 GROUP BY chrom, start) WHERE chrom = 'click' GROUP BY chrom""")
def signal_file_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One region of signal files; the filters reach the files' trees."""
    signal = events(spark, sf_dir).groupBy("chrom", "start").agg(F.sum(F.rint("value")).alias("value")).withColumn("end", F.col("start") + 1)
    folder = f"{shared_folder(spark)}/signals-{uuid.uuid4().hex}"
    signals.write_signal(signal, folder, [(c, 2 * SECONDS) for c in ("purchase", "view", "click", "signup", "error")])
    rows = signals.read_signal(spark, folder).where("chrom = 'click' and start < 1200000 and end > 1000000")
    return rows.groupBy("chrom").agg(F.count(F.lit(1)).alias("n"), F.sum("start").alias("starts"), F.sum("value").alias("total"))


@query("SELECT writer, event_type AS event, count(*) AS n, sum(event_id)::BIGINT AS ids FROM (SELECT *, CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS writer FROM events) GROUP BY ALL")
def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that two writers have put into one ledger; one of them repeats its batch."""
    folder = f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("command_id"), F.col("event_type").alias("event"), "user_id")
    for writer, rest in (("even", 0), ("odd", 1), ("even", 0)):
        ledger.append(rows.where(F.col("user_id") % 2 == rest), folder, writer, batch="all")
    return ledger.read_ledger(spark, folder, "command_id long, event string").groupBy("writer", "event").agg(F.count(F.lit(1)).alias("n"), F.sum("command_id").alias("ids"))


@query("""WITH RECURSIVE needs AS (SELECT p_partkey AS stage, p_partkey // 2 AS need, 0 AS ord FROM part WHERE p_partkey > 1 UNION ALL SELECT p_partkey, p_partkey // 3, 1 FROM part WHERE p_partkey > 2),
wanted AS (SELECT p_partkey AS stage, row_number() OVER (ORDER BY p_size, p_partkey) - 1 AS ord FROM part WHERE p_size > 25),
paths AS (SELECT stage, [ord] AS path FROM wanted UNION ALL SELECT need, list_append(path, ord) FROM paths JOIN needs USING (stage))
SELECT stage, row_number() OVER (ORDER BY list_append(min(path), 2147483647)) - 1 AS at FROM paths GROUP BY stage""")
def run_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as stages that need those of half and a third of their number, in the order in which to run the larger ones."""
    part, p = table(spark, sf_dir, "part"), F.col("p_partkey")
    need = lambda by, ord_: part.where(p >= by).select(p.alias("stage"), F.floor(p / by).alias("need"), F.lit(ord_).alias("ord"))
    wanted = part.where("p_size > 25").select(p.alias("stage"), (F.col("p_size") * 40_000_000 + p).alias("ord"))
    return dependencies.run_order(part.select(p.alias("stage")), need(2, 0).union(need(3, 1)), wanted)


def _by_customer(spark: SparkSession, given: Mapping[str, DataFrame], options: Mapping) -> DataFrame:
    return given["orders"].groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("last"))


def _by_nation(spark: SparkSession, given: Mapping[str, DataFrame], options: Mapping) -> DataFrame:
    frequent = given["by_customer"].where(F.col("n") >= options["least"])
    return given["customer"].join(frequent, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"), F.sum("n").alias("orders"))


@query("""WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT c_nationkey, count(*) AS customers, sum(n)::BIGINT AS orders, '' AS made_again FROM customer JOIN c ON c_custkey = o_custkey WHERE n >= 5 GROUP BY 1""")
def kept_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stages over orders and customers, run twice: the second run reads what the first kept and makes nothing again."""
    folder = f"{shared_folder(spark)}/stages-{uuid.uuid4().hex}"
    todo = {"by_customer": Stage(_by_customer, ["orders"]), "by_nation": Stage(_by_nation, ["by_customer", "customer"], {"least": 5})}
    inputs = {name: f"{sf_dir}/{name}.parquet" for name in ("orders", "customer")}
    run(spark, folder, todo, inputs, ["by_nation"])
    again = run(spark, folder, todo, inputs, ["by_nation"], tidy=True)
    return again.tables["by_nation"].withColumn("made_again", F.lit(",".join(again.made)))


@query("""WITH l AS (SELECT user_id AS source, event_type AS kind, lead(CASE WHEN event_id % 5 = 0 THEN 'h' || event_type ELSE event_type END) OVER (PARTITION BY user_id ORDER BY event_id) AS below, event_id FROM events) SELECT 'h' || kind AS metric, below AS value, count(*) AS n, sum(source)::BIGINT AS sources FROM l WHERE event_id % 5 = 0 AND below IS NOT NULL GROUP BY ALL""")
def metric_blocks_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header lines and the lines below them, through the table function."""
    table_functions.register(spark)
    line = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("h"), "event_type")).otherwise(F.col("event_type"))
    lines = table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), F.col("event_id").alias("line_no"), line.alias("line"))
    return spark.sql("SELECT metric, value, count(*) AS n, sum(source) AS sources FROM metrics_block(TABLE({lines}), 'h') GROUP BY metric, value", lines=lines)
