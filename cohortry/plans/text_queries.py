"""Text queries: events spell log lines, names and numbers that the parsers take apart."""

from __future__ import annotations

import base64
import gzip
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import intervals
from cohortry.plans.registry import query, table
from cohortry.sources import logs, quality_summary, report_plots, text_tables


@query("""SELECT event_id, TRY_CAST(regexp_replace(CASE event_id % 4 WHEN 0 THEN '1,' || lpad((event_id % 1000)::VARCHAR, 3, '0') WHEN 1 THEN (event_id % 100) || '.5%' WHEN 2 THEN 'n/a' ELSE event_id::VARCHAR END, '[,%]', '', 'g') AS DOUBLE) AS number FROM events""")
def cleaned_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    text = F.when(i % 4 == 0, F.concat(F.lit("1,"), F.lpad((i % 1000).cast("string"), 3, "0"))).when(i % 4 == 1, F.concat(i % 100, F.lit(".5%"))).when(i % 4 == 2, "n/a").otherwise(i.cast("string"))
    return table(spark, sf_dir, "events").select("event_id", text_tables.number(text).alias("number"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, kind = F.col("event_id"), F.col("event_type")
    line = (
        F.when(kind == "view", F.concat(1000 + i % 1000, F.lit(" + 0 in total (passed)")))
        .when(kind == "click", F.concat(i % 1000, F.lit(" + 0 mapped (x%)")))
        .when(kind == "signup", F.concat(F.lit("found "), i % 50, F.lit(" duplicates")))
        .when(kind == "purchase", F.concat(F.lit("sorted "), 100 + i % 50, F.lit(" end pairs")))
        .otherwise(F.concat(F.lit("SN\taverage length:\t"), i % 300))
    )
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), i.alias("line_no"), line.alias("line"))


@query("""WITH f AS (SELECT user_id AS source, max(1000 + event_id % 1000) FILTER (event_type = 'view')::DOUBLE AS total, max(event_id % 1000) FILTER (event_type = 'click')::DOUBLE AS mapped FROM events GROUP BY 1) SELECT source, total, mapped, round(100 * mapped / total + 1e-9, 6) AS mapped_pct FROM f""")
def flagstat_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.flagstat(log_lines(spark, sf_dir)).select("source", "total", "mapped", F.round(F.col("mapped_pct") + 1e-9, 6).alias("mapped_pct"))


@query("""WITH f AS (SELECT user_id AS source, max(event_id % 50) FILTER (event_type = 'signup') AS found, max(100 + event_id % 50) FILTER (event_type = 'purchase') AS pairs FROM events GROUP BY 1) SELECT source, round(100 * found / (2 * pairs) + 1e-9, 6) AS dup_pct FROM f""")
def duplicate_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.duplicates(log_lines(spark, sf_dir)).select("source", F.round(F.col("dup_pct") + 1e-9, 6).alias("dup_pct"))


@query("SELECT user_id AS source, max(event_id % 300) FILTER (event_type = 'error')::DOUBLE AS mean_length FROM events GROUP BY 1")
def alignment_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.alignment_stats(log_lines(spark, sf_dir)).select("source", "mean_length")


@query("SELECT event_type, sum((props->>'$.k')::BIGINT)::BIGINT AS k FROM events GROUP BY 1")
def json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").cast("long")).alias("k"))


@query("""WITH l AS (SELECT user_id AS source, event_type AS kind, lead(CASE WHEN event_id % 5 = 0 THEN 'h' || event_type ELSE event_type END) OVER (PARTITION BY user_id ORDER BY event_id) AS below, event_id FROM events) SELECT source, 'h' || kind AS metric, below AS value, count(*) AS n FROM l WHERE event_id % 5 = 0 AND below IS NOT NULL GROUP BY ALL""")
def metric_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("h"), "event_type")).otherwise(F.col("event_type"))
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), F.col("event_id").alias("line_no"), line.alias("line"))
    return logs.metrics_block(rows, "h").groupBy("source", "metric", "value").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, 'chr' || (p_size % 22 + 1) || '_' || (p_partkey + 1) AS id, p_partkey AS start FROM part")
def site_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    chrom = F.concat(F.lit("chr"), (F.col("p_size") % 22 + 1).cast("string"))
    ids = table(spark, sf_dir, "part").select("p_partkey", intervals.position_id(chrom, F.col("p_partkey")).alias("id"))
    return ids.withColumn("start", F.regexp_extract("id", r"^chr([0-9XYM]+)_([0-9]+)$", 2).cast("long") - 1)


@query("SELECT p_partkey, sha256(p_name || p_brand) AS sha256, left(sha256(p_type), 16) AS scope FROM part")
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.sha2(F.concat("p_name", "p_brand"), 256).alias("sha256"), F.substring(F.sha2("p_type", 256), 1, 16).alias("scope"))


@query("SELECT c_custkey, regexp_extract(lower(c_mktsegment) || '_' || (c_custkey % 9), '^(.+?)(?:_[0-9]+)?$', 1) AS prefix FROM customer")
def group_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lower("c_mktsegment"), F.lit("_"), (F.col("c_custkey") % 9).cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.regexp_extract(name, r"^(.+?)(?:_[0-9]+)?$", 1).alias("prefix"))


def report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports (path, html) on line items, one for each 50th supplier: bars, lines in the older layout and a heat map by part."""
    by = table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 50).alias("report"), (F.col("l_partkey") % 10).alias("s"))
    got = by.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("q"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("r"))
    rows = got.groupBy("report").agg(F.sort_array(F.collect_list(F.struct(F.concat(F.lit("part "), "s").alias("name"), "n", "q", "r", "s"))).alias("rows"))
    each = lambda f: F.transform("rows", f)
    names = each(lambda x: x["name"])
    cat = lambda name, data, pct: F.struct(F.lit(name).alias("name"), data.alias("data"), pct.alias("data_pct"))
    bar = F.struct(F.array(F.struct(names.alias("samples"), F.array(cat("lines", each(lambda x: x["n"]), each(lambda x: x["r"])), cat("quantity", each(lambda x: x["q"]), each(lambda x: x["n"]))).alias("cats"))).alias("datasets"))
    line = F.struct(F.lit("xy_line").alias("plot_type"), F.array(each(lambda x: F.struct(x["name"].alias("name"), F.array(x["n"], x["q"], x["r"]).alias("data")))).alias("datasets"), F.struct(F.array(F.lit(5), F.lit(10), F.lit(20)).alias("categories")).alias("config"))
    heat = F.struct(F.lit("heatmap").alias("plot_type"), F.array(F.lit("lines"), F.lit("returned")).alias("xcats"), names.alias("ycats"), F.concat(each(lambda x: F.array(F.lit(0).cast("long"), x["s"], x["n"])), F.transform(F.filter("rows", lambda x: x["r"] > 0), lambda x: F.array(F.lit(1).cast("long"), x["s"], x["r"]))).alias("data"))
    body = F.to_json(F.struct(bar.alias("counts"), line.alias("steps"), heat.alias("checks-1")))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            html = [f'<html><script id="mqc_compressed_plotdata" type="text/plain">{base64.b64encode(gzip.compress(b.encode())).decode()}</script></html>' for b in batch["body"]]
            yield pd.DataFrame({"path": batch["path"], "html": html})

    return rows.select(F.concat(F.lit("report "), F.lpad("report", 2, "0")).alias("path"), body.alias("body")).mapInPandas(packed, "path string, html string")


@query("""WITH g AS (SELECT l_suppkey % 50 AS report, l_partkey % 10 AS s, count(*) AS n, sum(l_quantity::BIGINT) AS q, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY ALL),
p AS (SELECT 'report ' || lpad(report::VARCHAR, 2, '0') AS source, 'part ' || s AS item, s, n, q, r FROM g),
full_report AS (SELECT source FROM p GROUP BY source HAVING min(s) = 0 AND count(*) = max(s) + 1),
o AS (SELECT 'counts' AS plot, source, item, 'lines' AS axis, n::DOUBLE AS value, r::DOUBLE AS pct FROM p UNION ALL SELECT 'counts', source, item, 'quantity', q, n FROM p
UNION ALL SELECT 'steps', source, item, '5', n, NULL FROM p UNION ALL SELECT 'steps', source, item, '10', q, NULL FROM p UNION ALL SELECT 'steps', source, item, '20', r, NULL FROM p
UNION ALL SELECT 'checks-1', source, item, 'lines', n, NULL FROM p JOIN full_report USING (source) UNION ALL SELECT 'checks-1', source, item, 'returned', r, NULL FROM p JOIN full_report USING (source))
SELECT * FROM o""")
def report_plot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = report_plots.plots(report_plots.payloads(report_pages(spark, sf_dir)))
    none = F.lit(None).cast("double").alias("pct")
    bars = report_plots.bars(found).select("plot", "source", F.col("sample").alias("item"), F.col("category").alias("axis"), "value", "pct")
    lines = report_plots.lines(found).select("plot", "source", F.col("line").alias("item"), F.col("x_text").alias("axis"), F.col("y").alias("value"), none)
    cells = report_plots.named(report_plots.heat_maps(found), "checks")
    # a point names its row by number, so only reports with all parts up to their largest have it in place
    whole = cells.groupBy("source").agg(F.max(F.regexp_extract("y", r"\d+", 0).cast("int") - F.col("y_ord")).alias("off")).where("off = 0")
    heat = cells.join(whole.select("source"), "source").select("plot", "source", F.col("y").alias("item"), F.col("x").alias("axis"), "value", none)
    return bars.union(lines).union(heat)


@query("""WITH g AS (SELECT l_suppkey % 50 AS report, l_partkey % 10 AS s, count(*) AS n, sum(l_quantity::BIGINT) AS q FROM lineitem GROUP BY ALL),
p AS (SELECT 'report ' || lpad(report::VARCHAR, 2, '0') AS source, 'part ' || s AS sample, n, q, row_number() OVER (ORDER BY report, s) - 1 AS sample_ord FROM g)
SELECT 'lines' AS category, 0 AS category_ord, source, sample, sample_ord, n::DOUBLE AS value FROM p UNION ALL SELECT 'quantity', 1, source, sample, sample_ord, q FROM p""")
def merged_report_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = report_plots.bars(report_plots.plots(report_plots.payloads(report_pages(spark, sf_dir))))
    return report_plots.merged_bars(bars).select("category", "category_ord", "source", "sample", "sample_ord", "value")


@query("""WITH c AS (SELECT c_custkey AS sample, c_nationkey AS nation, c_custkey % 500 + 1 AS reads FROM customer),
f AS (SELECT user_id AS source, max(1000 + event_id % 1000) FILTER (event_type = 'view')::DOUBLE AS total, max(event_id % 1000) FILTER (event_type = 'click')::DOUBLE AS mapped, max(event_id % 50) FILTER (event_type = 'signup') AS found, max(100 + event_id % 50) FILTER (event_type = 'purchase') AS pairs, max(event_id % 300) FILTER (event_type = 'error')::DOUBLE AS length FROM events GROUP BY 1)
SELECT sample, nation, total, length, round(100 * found / (2 * pairs) + 1e-9, 6) AS dup_pct, CASE WHEN sample % 3 > 0 AND mapped IS NOT NULL THEN round_even(least(100, 100 * mapped / (2 * reads)), 3) ELSE round_even(100 * mapped / total, 3) END AS mapped_pct FROM c LEFT JOIN f ON sample = source""")
def quality_summary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as samples: their figures from the lines that events spell, and from trimming reports of two thirds of them."""
    c = F.col("c_custkey")
    samples = table(spark, sf_dir, "customer").select(c.cast("string").alias("sample"), F.col("c_nationkey").alias("nation"), c.alias("key"))
    lines = log_lines(spark, sf_dir).withColumn("source", F.col("source").cast("string"))
    trimmed = samples.where("key % 3 > 0").select(F.col("sample").alias("source"), F.concat(F.lit("Total reads processed:   "), F.format_number(F.col("key") % 500 + 1, 0)).alias("line"))
    made = {"trimming": logs.trimming(trimmed), "flagstat": logs.flagstat(lines), "stats": logs.alignment_stats(lines), "duplicates": logs.duplicates(lines)}
    rows = quality_summary.quality_rows(samples, {k: t.withColumnRenamed("source", "sample") for k, t in made.items()})
    return rows.select(F.col("sample").cast("long").alias("sample"), "nation", F.col("flagstat_total").alias("total"), F.col("stats_mean_length").alias("length"), F.round(F.col("duplicates_dup_pct") + 1e-9, 6).alias("dup_pct"), "mapped_pct")


@query("""SELECT s_suppkey AS report, (s_suppkey * 10)::DOUBLE AS total_seqs, (s_suppkey % 60 + 1)::DOUBLE AS seq_length, round_even(100 - (s_suppkey % 1000) / 10.0, 2)::DOUBLE AS pct_duplicates, s_suppkey % 3 AS adapters, CASE WHEN s_suppkey % 3 = 2 THEN 50.0 ELSE 0.0 END AS pct_modules_failed FROM supplier""")
def read_report_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' numbers as zipped read reports, and their figures."""
    s = F.col("s_suppkey")
    text = F.concat(
        F.lit("##FastQC\t0.12\n>>Basic Statistics\tpass\n#Measure\tValue\nTotal Sequences\t"), s * 10, F.lit("\nSequence length\t1-"), s % 60 + 1, F.lit("\n>>END_MODULE\n>>Per base N content\tpass\n>>END_MODULE\n>>Adapter Content\t"),
        F.element_at(F.array(*map(F.lit, ("pass", "warn", "fail"))), (s % 3 + 1).cast("int")), F.lit("\n>>END_MODULE\n#Total Deduplicated Percentage\t"), F.format_string("%.1f", (s % 1000) / 10), F.lit("\n"),
    )

    def zipped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for body in batch["text"]:
                raw = io.BytesIO()
                with zipfile.ZipFile(raw, "w") as z:
                    z.writestr("x_fastqc/fastqc_data.txt", body)
                out.append(raw.getvalue())
            yield pd.DataFrame({"path": batch["path"], "content": out})

    files = table(spark, sf_dir, "supplier").select(s.cast("string").alias("path"), text.alias("text")).mapInPandas(zipped, "path string, content binary")
    found = quality_summary.read_reports(quality_summary.zipped_lines(files))
    return found.select(F.col("source").cast("long").alias("report"), "total_seqs", "seq_length", "pct_duplicates", F.col("adapters").cast("long").alias("adapters"), "pct_modules_failed")
