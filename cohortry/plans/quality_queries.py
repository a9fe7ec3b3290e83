"""Quality and fragment queries: suppliers are samples, quantities are methylated counts out of 50, prices are sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import fragments, quality
from cohortry.plans.interval_queries import E, O, events, orders
from cohortry.plans.registry import query, table

SITES = "si AS (SELECT l_suppkey AS sample, l_quantity AS m, 50 - l_quantity AS u FROM lineitem)"


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sample"), F.col("l_quantity").alias("m"), (50 - F.col("l_quantity")).alias("u"))


def near(c: str, digits: int = 6):
    return F.round(F.col(c) + 0.001 * 10**-digits, digits).alias(c)


@query(f"WITH {SITES} SELECT sample, round(100 * sum(m) / sum(m + u) + 1e-9, 6) AS methylation_pct, count(*) AS covered_sites, round(avg(m + u) + 1e-9, 6) AS mean_depth FROM si WHERE m + u >= 1 GROUP BY sample")
def methylation_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.coverage(sites(spark, sf_dir)).select("sample", near("methylation_pct"), "covered_sites", near("mean_depth"))


@query(f"WITH {SITES} SELECT sample, round(100 * sum(m) / sum(m + u) + 1e-9, 6) AS rate_pct, round(100 - 100 * sum(m) / sum(m + u) + 1e-9, 6) AS conversion_pct FROM si GROUP BY sample")
def conversion_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.conversion(sites(spark, sf_dir)).select("sample", near("rate_pct"), near("conversion_pct"))


@query("SELECT l_linestatus AS strand, l_returnflag AS read, l_linenumber AS pos, sum(l_quantity)::BIGINT AS n_meth, sum(50 - l_quantity)::BIGINT AS n_unmeth, round(100 * sum(l_quantity) / sum(50.0::DOUBLE) + 1e-9, 6) AS pct_meth FROM lineitem GROUP BY ALL")
def m_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("strand"), F.col("l_returnflag").alias("read"), F.col("l_linenumber").alias("pos"), F.col("l_quantity").alias("m"), (50 - F.col("l_quantity")).alias("u"))
    return quality.m_bias(counts).select("strand", "read", "pos", F.col("n_meth").cast("long").alias("n_meth"), F.col("n_unmeth").cast("long").alias("n_unmeth"), near("pct_meth"))


SIZES = "sz AS (SELECT o_orderpriority AS sample, floor(o_totalprice / 100)::INTEGER % 1200 AS size, count(*)::DOUBLE AS n FROM orders GROUP BY ALL), fh AS (SELECT *, size AS ord FROM sz WHERE size < 1000)"


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = (F.floor(F.col("o_totalprice") / 100) % 1200).cast("int").alias("size")
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("sample"), size).agg(F.count(F.lit(1)).cast("double").alias("count")).withColumn("ord", F.col("size"))


@query(f"""WITH {SIZES}, r AS (SELECT *, sum(n) OVER (PARTITION BY sample ORDER BY ord ROWS UNBOUNDED PRECEDING) AS run, sum(n) OVER (PARTITION BY sample) AS total FROM fh)
SELECT sample, min(size) FILTER (run >= total / 2) AS median, (array_agg(size ORDER BY n DESC, size) FILTER (size BETWEEN 100 AND 400))[1] AS peak,
round(100 * sum(CASE WHEN size < 120 THEN n ELSE 0 END) / sum(n) + 1e-9, 6) AS short_pct, round(100 * sum(CASE WHEN size BETWEEN 140 AND 180 THEN n ELSE 0 END) / sum(n) + 1e-9, 6) AS mono_pct, round(100 * sum(CASE WHEN size BETWEEN 300 AND 360 THEN n ELSE 0 END) / sum(n) + 1e-9, 6) AS di_pct FROM r GROUP BY sample""")
def fragment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fragment_metrics(sizes(spark, sf_dir)).select("sample", "median", "peak", near("short_pct"), near("mono_pct"), near("di_pct"))


@query("""WITH v AS (SELECT l_suppkey AS sample, (l_extendedprice::BIGINT % 1000) / 1000.0::DOUBLE AS value FROM lineitem), c AS (SELECT sample, least(floor(value * 200), 199)::INTEGER AS bin, count(*) AS n FROM v GROUP BY ALL), t AS (SELECT sample, count(*) AS total, count(*) FILTER (value <= 0.15 OR value >= 0.85) AS o, count(*) FILTER (value >= 0.35 AND value <= 0.65) AS i FROM v GROUP BY sample),
d AS (SELECT t.*, (b.bin + 0.5) / 200 AS c, coalesce(c.n, 0) * 200 / t.total AS d FROM t CROSS JOIN (SELECT unnest(range(0, 200))::DOUBLE AS bin) b LEFT JOIN c ON c.sample = t.sample AND c.bin = b.bin),
s AS (SELECT sample, total, o, i, max(d) FILTER (c <= 0.15) AS l, max(d) FILTER (c >= 0.85) AS r, median(d) FILTER (c >= 0.35 AND c <= 0.65) AS m FROM d GROUP BY ALL)
SELECT sample, round(l + 1e-9, 6) AS left_peak, round(r + 1e-9, 6) AS right_peak, round(m + 1e-9, 6) AS middle, round(least(l, r) / greatest(m, 1e-10) + 1e-9, 4) AS m_score, round(least(l, r) / nullif(greatest(l, r), 0) + 1e-9, 4) AS peak_balance, round(o / nullif(i, 0) + 1e-9, 4) AS boundary_mid_ratio FROM s WHERE total >= 100
UNION ALL SELECT sample, NULL, NULL, NULL, NULL, NULL, NULL FROM s WHERE total < 100""")
def value_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = (F.rint("l_extendedprice").cast("long") % 1000) / 1000.0
    v = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sample"), value.alias("value"))
    fine = [F.round(F.col(c) + 1e-9, 4).alias(c) for c in ("m_score", "peak_balance", "boundary_mid_ratio")]
    return quality.value_density(v).select("sample", *(near(c) for c in ("left_peak", "right_peak", "middle")), *fine)


bound = lambda x: "1e308" if x == quality.INF else str(float(x))
RULE_ROWS = ", ".join(f"({i}, '{m}', '{label}', {float(w)}::DOUBLE, {', '.join(f'{bound(x)}::DOUBLE' for x in rest)})" for i, (m, label, w, *rest) in enumerate(quality.RULES))
METRICS = ("flagstat_mapped_pct", "flagstat_properly_paired_pct", "markdup_dup_pct", "cpg_global_meth_pct", "cpg_covered_sites", "cpg_mean_depth", "beta_M_score")


@query(f"""WITH x AS (SELECT l_suppkey AS sample, round(100 - 600 * avg(l_discount) + l_suppkey % 7 * 3, 6) AS flagstat_mapped_pct, round(100 - 100 * avg(l_tax) * (l_suppkey % 4 + 5), 6) AS flagstat_properly_paired_pct, round(100 * avg(l_tax) * (l_suppkey % 13), 6) AS markdup_dup_pct, CASE WHEN l_suppkey % 5 > 0 THEN round(2 * avg(l_quantity), 6) END AS cpg_global_meth_pct, round(sum(l_quantity) * 40, 0) AS cpg_covered_sites, CASE WHEN l_suppkey % 11 > 0 THEN round(avg(l_quantity) / 2.2, 6) END AS cpg_mean_depth, 1.0::DOUBLE AS "beta_M_score" FROM lineitem GROUP BY l_suppkey),
l AS (UNPIVOT x ON {", ".join(f'"{m}"' for m in METRICS)} INTO NAME metric VALUE value), ru AS (SELECT * FROM (VALUES {RULE_ROWS}) v(rule, metric, label, weight, pl, ph, wl, wh)),
f AS (SELECT s.sample, ru.*, l.value FROM (SELECT DISTINCT sample FROM x) s CROSS JOIN ru LEFT JOIN l ON l.sample = s.sample AND l.metric = ru.metric WHERE ru.weight > 0),
st AS (SELECT *, CASE WHEN value IS NULL THEN 'NA' WHEN value BETWEEN pl AND ph THEN 'PASS' WHEN value BETWEEN wl AND wh THEN 'WARN' ELSE 'FAIL' END AS status FROM f),
g AS (SELECT sample, round_even(100 * sum(weight * CASE status WHEN 'PASS' THEN 1.0 WHEN 'FAIL' THEN 0.0 ELSE 0.5 END)::DOUBLE / sum(weight), 1) AS qc_score, count(*) FILTER (status = 'NA') AS n_missing, string_agg(label, ', ' ORDER BY rule) FILTER (status = 'FAIL') AS fa, string_agg(label, ', ' ORDER BY rule) FILTER (status = 'WARN') AS wa, string_agg(label, ', ' ORDER BY rule) FILTER (status = 'NA') AS na FROM st GROUP BY sample)
SELECT sample, qc_score, CASE WHEN fa IS NOT NULL THEN 'FAIL' WHEN wa IS NOT NULL THEN 'WARN' ELSE 'PASS' END AS qc_status, n_missing, CASE WHEN fa IS NULL AND wa IS NULL THEN 'Sample passes all QC thresholds (score ' || qc_score || '/100). Suitable for downstream analysis.'
WHEN fa IS NULL THEN concat_ws(' ', 'Sample passes with warnings (score ' || qc_score || '/100).', 'Flagged metrics: ' || wa || '.', 'Proceed with caution; verify these metrics do not affect downstream results.', 'Missing data for: ' || na || '.')
ELSE concat_ws(' ', '⚠ RECOMMEND EXCLUSION (score ' || qc_score || '/100).', 'Failed metrics: ' || fa || '.', 'Also flagged: ' || wa || '.', 'Review raw data quality and consider re-sequencing or excluding from analysis.', 'Missing data for: ' || na || '.') END AS recommendation FROM g""")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("sample")
    x = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("sample")).agg(F.avg("l_discount").alias("d"), F.avg("l_tax").alias("t"), F.avg("l_quantity").alias("q"), F.sum("l_quantity").alias("s"))
    x = x.select(
        "sample",
        F.round(100 - 600 * F.col("d") + k % 7 * 3, 6).alias("flagstat_mapped_pct"),
        F.round(100 - 100 * F.col("t") * (k % 4 + 5), 6).alias("flagstat_properly_paired_pct"),
        F.round(100 * F.col("t") * (k % 13), 6).alias("markdup_dup_pct"),
        F.when(k % 5 > 0, F.round(2 * F.col("q"), 6)).alias("cpg_global_meth_pct"),
        F.round(F.col("s") * 40, 0).alias("cpg_covered_sites"),
        F.when(k % 11 > 0, F.round(F.col("q") / 2.2, 6)).alias("cpg_mean_depth"),
        F.lit(1.0).alias("beta_M_score"),
    )
    return quality.score_samples(x.unpivot("sample", list(METRICS), "metric", "value"), quality.rules_table(spark))


@query("SELECT c_custkey, round(CASE WHEN c_custkey % 3 > 0 AND c_nationkey > 0 THEN least(100.0, 100 * c_acctbal / (2 * c_nationkey)) ELSE c_acctbal / 100 END + 1e-9, 6) AS mapped_pct FROM customer")
def mapped_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("mapped"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_nationkey")).alias("r1_reads"), (F.col("c_acctbal") / 100).alias("tool_pct"))
    return quality.true_mapped(x).select("c_custkey", near("mapped_pct"))


DENSE = f"{SIZES}, p AS (SELECT t.sample, b.size, 100 * coalesce(sz.n, 0) / t.total AS pct FROM (SELECT sample, sum(n) AS total FROM sz WHERE size < 500 GROUP BY sample) t CROSS JOIN (SELECT unnest(range(0, 500))::INTEGER AS size) b LEFT JOIN sz ON sz.sample = t.sample AND sz.size = b.size)"


@query(f"WITH {DENSE} SELECT sample, size, round(pct + 1e-9, 6) AS pct FROM p")
def fragment_length_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.length_shares(sizes(spark, sf_dir)).select("sample", "size", near("pct"))


@query(f"WITH {DENSE}, m AS (SELECT size, round(avg(pct) + 1e-9, 6) AS mean_pct FROM p GROUP BY size) SELECT size, mean_pct, size = (SELECT size FROM m ORDER BY mean_pct DESC, size LIMIT 1) AS is_peak FROM m")
def fragment_length_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.length_profile(fragments.length_shares(sizes(spark, sf_dir))).select("size", near("mean_pct"), "is_peak")


@query(f"WITH {SIZES} SELECT sample, (array_agg(size ORDER BY n DESC, size))[1] AS peak FROM sz WHERE size < 500 GROUP BY sample")
def fragment_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.sample_peaks(sizes(spark, sf_dir))


READS = "rd AS (SELECT l_linenumber AS sample, l_orderkey AS qname, l_partkey % 400 AS start, l_partkey % 400 + l_quantity::BIGINT AS \"end\" FROM lineitem)"


@query(f'WITH {READS}, f AS (SELECT sample, qname, max("end") - min(start) AS size FROM rd GROUP BY ALL) SELECT sample, size, count(*) AS count FROM f GROUP BY ALL')
def fragments_from_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    start = F.col("l_partkey") % 400
    return fragments.from_reads(lines.select(F.col("l_linenumber").alias("sample"), F.col("l_orderkey").alias("qname"), start.alias("start"), (start + F.col("l_quantity").cast("long")).alias("end")))


MOTIFS = "mo AS (SELECT lang AS sample, upper(left(text, 4)) AS motif, count(*) AS n FROM documents WHERE regexp_matches(text, '^[A-Za-z]{4}') GROUP BY ALL), fq AS (SELECT *, n / sum(n) OVER (PARTITION BY sample) AS freq FROM mo)"


def motifs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.motif_frequencies(table(spark, sf_dir, "documents").where(F.col("text").rlike("^[A-Za-z]{4}")).select(F.col("lang").alias("sample"), F.col("text").alias("seq")))


@query(f"WITH {MOTIFS} SELECT sample, motif, n, round(freq + 1e-12, 9) AS freq FROM fq")
def end_motifs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return motifs(spark, sf_dir).select("sample", "motif", "n", near("freq", 9))


@query(f"WITH {MOTIFS}, m AS (SELECT motif, round(avg(freq) + 1e-12, 9) AS mean_freq FROM fq GROUP BY motif) SELECT * FROM m ORDER BY mean_freq DESC, motif LIMIT 20")
def top_end_motifs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.top_motifs(motifs(spark, sf_dir).withColumn("freq", near("freq", 12))).select("motif", near("mean_freq", 9))


@query(f"WITH {MOTIFS} SELECT sample, motif, round(freq + 1e-12, 9) AS mean_freq FROM fq QUALIFY row_number() OVER (PARTITION BY sample ORDER BY freq DESC, motif) <= 20")
def top_end_motifs_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.top_motifs(motifs(spark, sf_dir), by=["sample"]).select("sample", "motif", near("mean_freq", 9))


BINS = f"""{E}, bn AS (SELECT user_id % 3 AS sample, chrom AS contig, floor((start + "end") / 2 / 500)::BIGINT * 500 AS start, count(*) FILTER ("end" - start BETWEEN 100 AND 150) AS n_short, count(*) FILTER ("end" - start BETWEEN 151 AND 220) AS n_long FROM e GROUP BY ALL)"""


def bins(spark: SparkSession, sf_dir: str, width: int = 500) -> DataFrame:
    e = events(spark, sf_dir).withColumn("sample", F.concat(F.lit("s"), F.col("user_id") % 3))
    return fragments.bin_ratios(e, width)


@query(f"WITH {BINS} SELECT 's' || sample AS sample, contig, start, start + 500 AS stop, n_short, n_long, CASE WHEN n_long > 0 THEN round(n_short / n_long + 1e-9, 6) END AS ratio FROM bn WHERE n_short + n_long > 0")
def short_long_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bins(spark, sf_dir).withColumn("ratio", near("ratio"))


@query(f"""WITH {BINS.replace("500", "500000")}, k AS (SELECT sample, contig, start, n_short FROM bn WHERE n_short + n_long > 0)
SELECT a.contig, a.start, a.start + 500000 AS stop, a.n_short AS s0, b.n_short AS s1, c.n_short AS s2 FROM k a JOIN k b ON a.contig = b.contig AND a.start = b.start JOIN k c ON a.contig = c.contig AND a.start = c.start WHERE a.sample = 0 AND b.sample = 1 AND c.sample = 2""")
def aligned_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.align_bins(bins(spark, sf_dir, 500000), ["s0", "s1", "s2"], "n_short")


@query(f"""WITH {E}, {O}, rg AS (SELECT chrom, start, "end", 'r' || ord AS name FROM o), sg AS (SELECT chrom, g * 10 AS start, g * 10 + 7 AS "end", (g % 9)::DOUBLE AS value FROM (SELECT DISTINCT chrom, start // 10 AS g FROM e)),
m AS (SELECT rg.name, sum(least(rg."end", sg."end") - greatest(rg.start, sg.start)) AS covered, sum((least(rg."end", sg."end") - greatest(rg.start, sg.start)) * value) AS s FROM rg JOIN sg ON rg.chrom = sg.chrom AND rg.start < sg."end" AND rg."end" > sg.start GROUP BY rg.name)
SELECT rg.name, rg."end" - rg.start AS size, coalesce(covered, 0)::BIGINT AS covered, coalesce(s, 0.0) AS sum, round(coalesce(s, 0.0) / (rg."end" - rg.start) + 1e-9, 6) AS mean0, round(coalesce(s / covered, 0.0) + 1e-9, 6) AS mean FROM rg LEFT JOIN m USING (name)""")
def region_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    regions = orders(spark, sf_dir).select("chrom", "start", "end", F.concat(F.lit("r"), "ord").alias("name"))
    g = e.select("chrom", F.floor(F.col("start") / 10).alias("g")).distinct()
    signal = g.select("chrom", (F.col("g") * 10).alias("start"), (F.col("g") * 10 + 7).alias("end"), (F.col("g") % 9).cast("double").alias("value"))
    return fragments.occupancy(regions, signal, 64).select("name", "size", "covered", "sum", near("mean0"), near("mean"))


@query(f"""WITH {E}, s AS (SELECT chrom, start AS pos, 1 AS step, 1 AS ends FROM e UNION ALL SELECT chrom, "end", -1, 0 FROM e UNION ALL SELECT chrom, "end" - 1, 0, 1 FROM e), g AS (SELECT chrom, pos, sum(step) AS step, sum(ends) AS ends FROM s GROUP BY ALL), d AS (SELECT *, sum(step) OVER (PARTITION BY chrom ORDER BY pos ROWS UNBOUNDED PRECEDING) AS depth FROM g)
SELECT chrom, pos, ends::BIGINT AS ends, depth::BIGINT AS depth, round(ends / depth + 1e-9, 6) AS share FROM d WHERE ends > 0""")
def cut_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.cut_sites(events(spark, sf_dir)).select("chrom", "pos", "ends", "depth", near("share"))


@query(r"""WITH w AS (SELECT translate(regexp_replace(text, '[^ -~]', 'n', 'g'), 'abcdefghijklmnopqrstuvwxyz .,', 'acgtacgtacgtacgtacgtacgtacgta') AS text FROM documents),
q AS (SELECT upper(text[60 * i + 1:60 * i + 60]) AS seq FROM (SELECT text, unnest(range(0, (length(text) + 59) // 60)) AS i FROM w)), c AS (SELECT p AS pos, seq[p + 1:p + 2] AS pair FROM (SELECT seq, unnest(range(0, length(seq) - 1)) AS p FROM q)), cl AS (SELECT CASE WHEN pair IN ('AA','AT','TA','TT') THEN 'weak' WHEN pair IN ('GG','GC','CG','CC') THEN 'strong' END AS class, pos FROM c), k AS (SELECT class, pos, count(*) AS n FROM cl WHERE class IS NOT NULL GROUP BY class, pos)
SELECT class, pos - 30 AS pos, n, round(100 * n / sum(n) OVER (PARTITION BY class) + 1e-9, 6) AS pct FROM k""")
def dinucleotide_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts of all documents as sequences, in pieces of 60 letters."""
    text = F.translate(F.regexp_replace("text", "[^ -~]", "n"), "abcdefghijklmnopqrstuvwxyz .,", "acgtacgtacgtacgtacgtacgtacgta")
    whole = table(spark, sf_dir, "documents").select(text.alias("text")).where("text <> ''")
    # all pieces in one pass: a substring of its own for each would count letters from the start of the text again
    pieces = whole.select(F.explode(F.regexp_extract_all("text", F.lit("(?s).{1,60}"), F.lit(0))).alias("seq"))
    return fragments.dinucleotides(pieces, 30).select("class", F.col("pos").cast("long").alias("pos"), "n", near("pct"))


FLAGS = "fl AS (SELECT l_suppkey % 4 AS sample, l_orderkey AS qname, l_linenumber % 2 AS mate, l_partkey % 4096 AS flag, l_quantity::INTEGER - 10 AS mapq FROM lineitem)"


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 4).alias("sample"), F.col("l_orderkey").alias("qname"), (F.col("l_linenumber") % 2).alias("mate"), (F.col("l_partkey") % 4096).alias("flag"), (F.col("l_quantity").cast("int") - 10).alias("mapq"))


@query(f"WITH {FLAGS} SELECT sample, count(*) AS n FROM fl WHERE (flag & 2) <> 0 AND (flag & 256) = 0 AND (flag & 512) = 0 AND (flag & 2048) = 0 AND mapq > 0 GROUP BY sample")
def usable_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.usable_reads(flagged(spark, sf_dir)).groupBy("sample").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {FLAGS}, p AS (SELECT *, (flag & 256) = 0 AND (flag & 2048) = 0 AS prim, (flag & 1024) <> 0 AS dup FROM fl)
SELECT sample, count(*) FILTER (prim) AS "primary", count(*) FILTER (prim AND dup) AS duplicate, count(*) FILTER ((flag & 256) <> 0) AS secondary, count(*) FILTER ((flag & 2048) <> 0) AS supplementary, count(DISTINCT (qname, mate)) FILTER (prim AND dup) AS duplicate_mates, count(DISTINCT qname) FILTER (prim AND dup) AS duplicate_names FROM p GROUP BY sample""")
def read_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.read_counts(flagged(spark, sf_dir))


@query("""WITH a AS (SELECT o_orderkey AS k, o_totalprice > 200000 AS marked FROM orders WHERE o_orderstatus <> 'P'), b AS (SELECT o_orderkey AS k, o_totalprice > 220000 AS marked FROM orders WHERE o_orderpriority <> '5-LOW'), f AS (SELECT coalesce(a.marked, false) AS x, coalesce(b.marked, false) AS y FROM a FULL JOIN b USING (k))
SELECT count(*) FILTER (x AND y) AS n_both, count(*) FILTER (x OR y) AS n_either, round(count(*) FILTER (x AND y) / count(*) FILTER (x OR y) + 1e-9, 6) AS jaccard, count(*) FILTER (x <> y) AS n_differ, round(count(*) FILTER (x = y) / count(*) + 1e-9, 6) AS agreement FROM f""")
def duplicate_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    a = orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), (F.col("o_totalprice") > 200000).alias("marked"))
    b = orders.where("o_orderpriority <> '5-LOW'").select(F.col("o_orderkey").alias("k"), (F.col("o_totalprice") > 220000).alias("marked"))
    return fragments.compare_marks(a, b, ["k"]).select("n_both", "n_either", near("jaccard"), "n_differ", near("agreement"))


@query("""WITH a AS (SELECT l_partkey AS k, avg(l_quantity) AS v, count(*) AS d FROM lineitem WHERE l_linenumber < 4 GROUP BY 1), b AS (SELECT l_partkey AS k, avg(l_quantity) AS v, count(*) AS d FROM lineitem WHERE l_linenumber >= 4 GROUP BY 1), f AS (SELECT a.v AS va, b.v AS vb, a.d + b.d AS w FROM a FULL JOIN b USING (k))
SELECT count(*) FILTER (va IS NOT NULL AND vb IS NOT NULL) AS n_shared, count(*) AS n_all, round(count(*) FILTER (va IS NOT NULL AND vb IS NOT NULL) / count(*) + 1e-9, 6) AS shared_fraction, round(avg(abs(va - vb)) + 1e-9, 6) AS mean_abs_delta, round(sum(abs(va - vb) * w) / sum(w) FILTER (va IS NOT NULL AND vb IS NOT NULL) + 1e-9, 6) AS weighted_delta FROM f""")
def site_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    side = lambda cond: lines.where(cond).groupBy(F.col("l_partkey").alias("k")).agg(F.avg("l_quantity").alias("value"), F.count(F.lit(1)).alias("depth"))
    return fragments.compare_sites(side("l_linenumber < 4"), side("l_linenumber >= 4"), ["k"]).select("n_shared", "n_all", near("shared_fraction"), near("mean_abs_delta"), near("weighted_delta"))


@query("""SELECT 's' || (l_suppkey % 20) AS sample, CASE WHEN l_suppkey % 2 = 0 THEN 'control' ELSE 'case' END AS "group", 'chr' || (l_partkey % 25) AS chrom, count(*) AS n_bins, round(avg(l_quantity / 50) + 1e-9, 6) AS ratio
FROM lineitem WHERE l_partkey % 25 BETWEEN 1 AND 22 AND l_orderkey % 6 > 1 GROUP BY ALL""")
def chromosome_ratio_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are bins; some ratios are texts that are no numbers."""
    key = F.col("l_orderkey")
    ratio_ = F.when(key % 6 == 0, "NA").when(key % 6 == 1, "nan").otherwise((F.col("l_quantity") / 50).cast("string"))
    bins_ = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("s"), F.col("l_suppkey") % 20).alias("sample"), F.when(F.col("l_suppkey") % 2 == 0, "control").otherwise("case").alias("group"), F.concat(F.lit("chr"), F.col("l_partkey") % 25).alias("chrom"), ratio_.alias("ratio"))
    out = fragments.chromosome_ratios(bins_, [f"chr{i}" for i in range(1, 23)])
    return out.select("sample", "group", "chrom", "n_bins", F.round(F.col("ratio") + 1e-9, 6).alias("ratio"))
