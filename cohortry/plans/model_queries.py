"""Model and power queries: orders are replicates, line numbers samples, parts sites of a reference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import matrix, models, power
from cohortry.plans.matrix_queries import SAMPLES, M, long_matrix
from cohortry.plans.registry import query, table
from cohortry.session import spread


def near(c: str, digits: int = 6):
    return F.round(F.col(c) + 0.001 * 10**-digits, digits).alias(c)


REPS = "rp AS (SELECT o_custkey % 20 AS template, o_custkey % 3 * 20 + 20 AS n, o_orderkey % 2 * 20 + 10 AS depth, o_orderkey AS sim, o_totalprice > 200000 AS detected, (o_totalprice::BIGINT % 1000) / 1000.0::DOUBLE AS auc FROM orders)"


def replicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select((c % 20).alias("template"), (c % 3 * 20 + 20).alias("n"), (k % 2 * 20 + 10).alias("depth"), k.alias("sim"), (F.col("o_totalprice") > 200000).alias("detected"), (F.rint("o_totalprice").cast("long") % 1000 / 1000.0).alias("auc"))


PER = f"""{REPS}, pt AS (SELECT template, n, depth, count(*) AS n_sims, count(*) FILTER (detected) AS hits, avg(auc) AS mean_auc, stddev_samp(auc) AS sd_auc, median(auc) AS median_auc FROM rp GROUP BY ALL), pw AS (SELECT *, hits / n_sims AS power, 1.959963984540054 AS z FROM pt)"""


@query(f"WITH {PER} SELECT template, n, depth, n_sims, hits, round(mean_auc + 1e-9, 6) AS mean_auc, round(sd_auc + 1e-9, 6) AS sd_auc, round(median_auc + 1e-9, 6) AS median_auc, round(power + 1e-9, 6) AS power, round(greatest(0, (power + z*z/(2*n_sims) - z*sqrt(power*(1-power)/n_sims + z*z/(4*n_sims*n_sims))) / (1 + z*z/n_sims)) + 1e-9, 6) AS power_low FROM pw")
def template_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = power.template_summary(replicates(spark, sf_dir))
    return out.select("template", "n", "depth", "n_sims", "hits", near("mean_auc"), near("sd_auc"), near("median_auc"), near("power"), near("power_low"))


@query(f"WITH {PER} SELECT n, depth, count(*) AS n_templates, round(avg(power) + 1e-9, 6) AS power, round(stddev_samp(power) + 1e-9, 6) AS between_sd, round(quantile_cont(power, 0.025) + 1e-9, 6) AS q025, round(quantile_cont(power, 0.975) + 1e-9, 6) AS q975 FROM pw GROUP BY ALL")
def power_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = power.power_curve(power.template_summary(replicates(spark, sf_dir)))
    return out.select("n", "depth", "n_templates", *(near(c) for c in ("power", "between_sd", "q025", "q975")))


@query()
def power_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return power.bootstrap_bounds(replicates(spark, sf_dir), reps=500)


@query("""WITH r AS (SELECT l_suppkey AS template, l_linenumber AS n, 10 AS depth, l_partkey AS sim, round(avg(l_discount) FILTER (l_returnflag = 'A'), 6) AS a, round(avg(l_discount) FILTER (l_returnflag = 'R'), 6) AS b FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1, 2, 4), d AS (SELECT *, b - a AS d FROM r)
SELECT n, depth, count(d) AS n_pairs, round(avg(d) + 1e-9, 6) AS mean_diff, round(avg((d > 0)::INT) FILTER (d IS NOT NULL) + 1e-9, 6) AS p_above_0 FROM d GROUP BY ALL""")
def paired_model_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    # nearly every line is a group of its own: tasks grow in number, not in the groups that each holds
    lines = spread(items.where("l_returnflag in ('A', 'R')"), ["l_suppkey", "l_linenumber", "l_partkey"], items.count())
    r = lines.groupBy(F.col("l_suppkey").alias("template"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("sim"), F.col("l_returnflag").alias("model")).agg(F.round(F.avg("l_discount"), 6).alias("auc"))
    return power.paired_models(r.withColumn("depth", F.lit(10)), ["A", "R"]).select("n", "depth", "n_pairs", near("mean_diff"), near("p_above_0"))


REF = "rf AS (SELECT p_partkey AS site, 0.05 + (p_partkey % 91) / 101.0::DOUBLE AS mean, 0.02 + p_size / 200.0::DOUBLE AS sd FROM part)"


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("site"), (0.05 + F.col("p_partkey") % 91 / 101.0).alias("mean"), (0.02 + F.col("p_size") / 200.0).alias("sd"))


@query(f"WITH {REF} SELECT site::VARCHAR AS site, round(mean * (mean * (1 - mean) / (sd * sd) - 1) + 1e-9, 6) AS alpha, round((1 - mean) * (mean * (1 - mean) / (sd * sd) - 1) + 1e-9, 6) AS beta FROM rf WHERE sd * sd < mean * (1 - mean)")
def beta_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    alpha, beta = power.beta_shape(F.col("mean"), F.col("sd"))
    return reference(spark, sf_dir).select("site", F.round(alpha + 1e-9, 6).alias("alpha"), F.round(beta + 1e-9, 6).alias("beta")).where("alpha is not null")


@query(f"WITH {REF} SELECT site::VARCHAR AS site FROM rf WHERE mean > 1e-6 AND mean < 1 - 1e-6 AND sd * sd < mean * (1 - mean) AND (sd * 0.8) * (sd * 0.8) < mean * (1 - mean)")
def feasible_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reference(spark, sf_dir)
    return power.feasible(r.withColumn("depth", F.lit(10)).unionByName(r.withColumn("sd", F.col("sd") * 0.8).withColumn("depth", F.lit(30))))


@query("""WITH d AS (SELECT p_partkey, p_size + 14 AS depth, ((p_size + 14) / (1.3409309326892476 * (p_size + 14) + 3.526927718332715) - 0.6291928395185754) / 0.02390549241316919 AS r FROM part WHERE p_size > 0)
SELECT p_partkey, depth, round(least(1.0, greatest(0.0, (depth * r * -0.0007582750922856895 + 4.56905302776041) / 100)) + 1e-10, 7) AS missing FROM d""")
def missing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    depth = (F.col("p_size") + 14).alias("depth")
    rate = power.missing_rate((F.col("p_size") + 14).cast("double"))
    return table(spark, sf_dir, "part").where("p_size > 0").select("p_partkey", depth, F.round(rate + 1e-10, 7).alias("missing"))


@query()
def site_power_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of sites with enough power at each cohort size; tail probabilities have no SQL form."""
    sizes = spark.createDataFrame([(n,) for n in (3, 10, 20, 50, 100)], "n int")
    sites = reference(spark, sf_dir).crossJoin(F.broadcast(sizes))
    return power.powered_fraction(sites.withColumn("power", power.site_power(F.lit(0.2), F.col("sd"), F.col("n")))).select("n", near("fraction"))


@query()
def power_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small grid end to end: templates, signal and null cohorts, calibration, curve."""
    r = reference(spark, sf_dir)
    sites = r.withColumn("depth", F.lit(10)).unionByName(r.withColumn("sd", F.col("sd") * 0.8).withColumn("depth", F.lit(30)))
    templates = power.prepare_templates(sites, 2, 40, 6, 0.2, 0.02, 11)
    missing = {10: 0.05, 30: 0.01}
    signal = power.run_replicates(power.replicate_plan(spark, 2, [20], 5), templates, missing, 11, k=8)
    null = power.run_replicates(power.replicate_plan(spark, 2, [20], 19), power.null_templates(templates), missing, 11, k=8, null=True)
    return power.power_curve(power.template_summary(power.calibrate(signal, null)))


FILLED = f"{M}, f AS (SELECT DISTINCT feature FROM m), s AS (SELECT 's' || unnest(range(1, 8)) AS sample), w AS (SELECT f.feature, s.sample, coalesce(m.value, avg(m.value) OVER (PARTITION BY f.feature)) AS v FROM f CROSS JOIN s LEFT JOIN m ON m.feature = f.feature AND m.sample = s.sample), c AS (SELECT feature, sample, v - avg(v) OVER (PARTITION BY feature) AS c FROM w)"


@query(f"WITH {FILLED} SELECT x.sample AS a, y.sample AS b, round(sum(x.c * y.c) + 1e-9, 6) + 0.0 AS g FROM c x JOIN c y ON x.feature = y.feature AND x.sample <= y.sample GROUP BY ALL")
def gram_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = matrix.to_long(matrix.to_wide(long_matrix(spark, sf_dir), SAMPLES), "feature")
    return models.gram(long, SAMPLES, scale=False).select("a", "b", near("g"))


@query()
def explained_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the samples; their eigenvalues have no SQL form, the Gram matrix they come from has."""
    long = matrix.to_long(matrix.to_wide(long_matrix(spark, sf_dir), SAMPLES), "feature")
    return models.principal_components(long, SAMPLES, 5)[1].select("pc", F.round("pct", 4).alias("pct"))


def cohort(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, int]]:
    sample = F.lpad((F.col("l_suppkey") % 12).cast("string"), 2, "0").alias("sample")
    shift = F.when(F.col("l_returnflag") == "A", F.col("l_suppkey") % 2 * 0.02).otherwise(0.0)
    long = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("modality"), F.concat(F.lit("f"), F.col("l_partkey") % 12).alias("feature"), sample).agg(F.avg(F.col("l_discount") + shift).alias("value"))
    return long, {f"{i:02d}": i % 2 for i in range(12)}


@query()
def modality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    long, labels = cohort(spark, sf_dir)
    return models.modality_performance(long, labels, folds=3, repeats=2, k=6)


@query()
def held_out_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    long, labels = cohort(spark, sf_dir)
    return models.leave_one_out(long, labels, {"A": 2, "N": 2, "R": 2}, k=6)


MOMENTS = """mo AS (SELECT l_partkey AS site, l_linenumber AS depth, 0.05 + (l_partkey % 91) / 101.0::DOUBLE AS mean, 0.02 + max(l_quantity) / 150.0::DOUBLE AS sd FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part) GROUP BY ALL),
ok AS (SELECT *, mean > 1e-6 AND mean < 1 - 1e-6 AND sd > 0 AND sd * sd < mean * (1 - mean) AS good FROM mo)"""


@query(f"WITH {MOMENTS} SELECT depth, count(*) AS n_aligned, count(*) FILTER (good) AS n_feasible, round(count(*) FILTER (good) / count(*) + 1e-9, 6) AS fraction, (SELECT count(*) FROM (SELECT site FROM ok WHERE good GROUP BY site HAVING count(*) = (SELECT count(DISTINCT depth) FROM mo))) AS n_common FROM ok GROUP BY depth")
def site_feasibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of the parts meet deviations at the line numbers, their depths; many parts have no line of some number."""
    sd = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("site"), F.col("l_linenumber").alias("depth")).agg((0.02 + F.max("l_quantity") / 150.0).alias("sd"))
    return power.feasibility(power.site_moments(reference(spark, sf_dir).select("site", "mean"), sd)).select("depth", "n_aligned", "n_feasible", near("fraction"), "n_common")


@query("""WITH pe AS (SELECT o_custkey, min(o_orderkey) AS o FROM orders GROUP BY o_custkey)
SELECT c_custkey AS modality, c_custkey % 100 AS ord, coalesce(CASE o % 4 WHEN 0 THEN NULL WHEN 1 THEN [2, 1, 3][1 + o % 5] ELSE [2, 1, 3][1 + o % 3] END, 2) AS classifier FROM customer LEFT JOIN pe ON c_custkey = o_custkey""")
def classifier_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers are modalities: those without orders have no performance, others no number in it, or a place beyond the end."""
    o = F.col("o")
    text = F.when(o % 4 == 0, "LR").when(o % 4 == 1, F.concat(F.lit("SVC, "), o % 5)).otherwise(F.concat(F.lit("RF2 ("), o % 3, F.lit(")")))
    best = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("modality")).agg(F.min("o_orderkey").alias("o")).select("modality", text.alias("best"))
    modalities = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("modality"), (F.col("c_custkey") % 100).alias("ord"))
    return models.resolve_classifiers(modalities, [2, 1, 3], best)
