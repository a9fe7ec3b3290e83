"""Matrix and statistics queries: parts are features, line numbers are samples, discounts are values.

Line numbers 1 to 3 are the control group, 4 to 7 the case group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import matrix, stats
from cohortry.plans.registry import query, table

SAMPLES = [f"s{i}" for i in range(1, 8)]
M = """m AS (
  SELECT l_partkey AS feature, 's' || l_linenumber AS sample, CASE WHEN l_linenumber <= 3 THEN 'control' ELSE 'case' END AS grp, round(avg(l_discount), 6) AS value
  FROM lineitem GROUP BY ALL)"""


def long_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    long = lines.groupBy(F.col("l_partkey").alias("feature"), F.concat(F.lit("s"), F.col("l_linenumber")).alias("sample"), "l_linenumber").agg(F.round(F.avg("l_discount"), 6).alias("value"))
    return long.withColumn("group", F.when(F.col("l_linenumber") <= 3, "control").otherwise("case")).drop("l_linenumber")


def r6(c: str):
    """Six decimals; averages of rounded values often end in exactly half a unit, which a nudge sends up in both engines."""
    return F.round(F.col(c) + 1e-9, 6).alias(c)


@query(f"WITH {M} SELECT feature, round(avg(value) FILTER (grp = 'control') + 1e-9, 6) AS mean_a, round(avg(value) FILTER (grp = 'case') + 1e-9, 6) AS mean_b, round(avg(value) FILTER (grp = 'case') - avg(value) FILTER (grp = 'control') + 1e-9, 6) + 0.0 AS meandiff FROM m GROUP BY feature")
def diff_group_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.group_means(long_matrix(spark, sf_dir)).select("feature", r6("mean_a"), r6("mean_b"), r6("meandiff"))


RANKED = f"""{M}, r AS (
  SELECT *, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS rk, count(*) OVER (PARTITION BY feature, value) AS t FROM m),
u AS (SELECT feature, count(*) FILTER (grp = 'control') AS n_a, count(*) FILTER (grp = 'case') AS n_b,
  coalesce(sum(rk) FILTER (grp = 'case'), NULL) - count(*) FILTER (grp = 'case') * (count(*) FILTER (grp = 'case') + 1) / 2.0 AS u, sum(t * t - 1)::DOUBLE AS ties FROM r GROUP BY feature)"""


@query(f"WITH {RANKED} SELECT feature, n_a, n_b, u::DOUBLE AS u, ties FROM u")
def diff_rank_u(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.rank_sum(long_matrix(spark, sf_dir))


@query()
def diff_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole differential table: U, p, q and means; p values have no SQL form and are held against their definition in tests."""
    long = long_matrix(spark, sf_dir)
    tests = stats.rank_p(stats.rank_sum(long))
    return stats.adjust_p(tests).join(matrix.group_means(long), "feature").select("feature", "n_a", "n_b", "u", "p", "q", "mean_a", "mean_b", "meandiff")


@query(f"WITH {M} SELECT feature, value, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0::DOUBLE AS rank, sample FROM m".replace("/ 2.0::DOUBLE", "/ 2.0"))
def rank_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.average_rank(long_matrix(spark, sf_dir), ["feature"], "value", "rank").select("feature", "sample", "value", F.col("rank").cast("double").alias("rank"))


@query("""WITH p AS (SELECT p_partkey AS feature, round(p_size / 50.0 * (p_partkey % 97 + 1) / 97, 9) AS p FROM part),
r AS (SELECT *, p * (SELECT count(*) FROM p) / count(*) OVER (ORDER BY p RANGE UNBOUNDED PRECEDING) AS raw FROM p)
SELECT feature, p, round(least(1.0, min(raw) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING)), 9) AS q FROM r""")
def adjusted_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    p = part.select(F.col("p_partkey").alias("feature"), F.round(F.col("p_size") / 50.0 * (F.col("p_partkey") % 97 + 1) / 97, 9).alias("p"))
    return stats.adjust_p(p).select("feature", "p", F.round("q", 9).alias("q"))


@query(f"WITH {M} PIVOT (SELECT feature, sample, value FROM m) ON sample IN ('s1','s2','s3','s4','s5','s6','s7') USING first(value) GROUP BY feature")
def matrix_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.to_wide(long_matrix(spark, sf_dir), SAMPLES)


@query(f"WITH {M}, f AS (SELECT DISTINCT feature FROM m), s AS (SELECT 's' || unnest(range(1, 8)) AS sample) SELECT f.feature, s.sample, m.value FROM f CROSS JOIN s LEFT JOIN m ON m.feature = f.feature AND m.sample = s.sample")
def matrix_long_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.to_long(matrix.to_wide(long_matrix(spark, sf_dir), SAMPLES), "feature")


@query(f"WITH {M} SELECT feature, count(*) AS n, round((7 - count(*)) / 7 + 1e-9, 6) AS missing_frac, round(avg(value) + 1e-9, 6) AS mean, round(var_samp(value) + 1e-12, 9) AS variance, round(var_pop(value) + 1e-12, 9) AS variance_n FROM m GROUP BY feature HAVING count(*) >= 3.5 AND var_samp(value) > 1e-15")
def feature_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = matrix.usable_features(long_matrix(spark, sf_dir), 7).where("variance > 1e-15")
    return kept.select("feature", "n", r6("missing_frac"), r6("mean"), F.round(F.col("variance") + 1e-12, 9).alias("variance"), F.round(F.col("variance_n") + 1e-12, 9).alias("variance_n"))


@query(f"WITH {M} SELECT feature, count(*) AS n FROM m GROUP BY feature HAVING 7 - count(*) <= 0.7")
def feature_few_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.few_missing(long_matrix(spark, sf_dir), 7).select("feature", "n")


@query(f"WITH {M} SELECT feature, round(median(value) + 1e-9, 6) AS median FROM m GROUP BY feature HAVING count(*) FILTER (grp = 'control') / 3 >= 0.6 AND count(*) FILTER (grp = 'case') / 4 >= 0.6 AND max(value) > min(value)")
def feature_observed_in_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.observed_in_both(long_matrix(spark, sf_dir), {"control": 3, "case": 4}, 0.6).where("variance_n > 1e-15").select("feature", r6("median"))


@query(f"WITH {M} SELECT feature, round(coalesce(var_samp(value), 0), 9) AS variance FROM m GROUP BY feature ORDER BY round(coalesce(var_samp(value), 0), 9) DESC, feature LIMIT 500")
def top_variable_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matrix.feature_stats(long_matrix(spark, sf_dir), 7)
    return matrix.top_variable(found.withColumn("variance", F.round("variance", 9)), 500).select("feature", "variance")


@query(f"""WITH {M}, f AS (SELECT DISTINCT feature FROM m), s AS (SELECT 's' || unnest(range(1, 8)) AS sample), w AS (
  SELECT f.feature, s.sample, coalesce(m.value, avg(m.value) OVER (PARTITION BY f.feature)) AS v FROM f CROSS JOIN s LEFT JOIN m ON m.feature = f.feature AND m.sample = s.sample),
z AS (SELECT feature, sample, v, avg(v) OVER (PARTITION BY feature) AS mu, stddev_pop(v) OVER (PARTITION BY feature) AS sd FROM w)
SELECT feature, sample, round(CASE WHEN sd > 1e-9 THEN greatest(-5.0, least(5.0, (v - mu) / sd)) ELSE 0 END, 5) + 0.0 AS z FROM z""")
def heatmap_z(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = matrix.to_long(matrix.to_wide(long_matrix(spark, sf_dir), SAMPLES), "feature")
    scored = matrix.z_scores(long)
    return scored.select("feature", "sample", F.when(F.abs("z") < 1e-6, 0.0).otherwise(F.round("z", 5)).alias("z"))


@query(f"WITH {M} SELECT sample, feature, round(value / sum(value) OVER (PARTITION BY sample), 9) AS share FROM m")
def value_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.share_of_total(long_matrix(spark, sf_dir), ["sample"], "value", "share").select("sample", "feature", F.round("share", 9).alias("share"))


@query("""WITH m AS (SELECT l_partkey AS feature, 's' || l_linenumber AS sample, round(avg(l_discount * CASE WHEN l_linenumber = 2 THEN 1000 ELSE 1 END), 6) AS value FROM lineitem GROUP BY ALL)
SELECT feature, sample, round(least(1.0, greatest(0.0, CASE WHEN max(value) OVER (PARTITION BY sample) > 1.5 THEN value / 100 ELSE value END)) + 1e-9, 6) AS value FROM m""")
def unit_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    value = F.round(F.avg(F.col("l_discount") * F.when(F.col("l_linenumber") == 2, 1000).otherwise(1)), 6)
    long = lines.groupBy(F.col("l_partkey").alias("feature"), F.concat(F.lit("s"), F.col("l_linenumber")).alias("sample")).agg(value.alias("value"))
    return matrix.unit_scale(long).select("feature", "sample", r6("value"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.first_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 7 = 0")
def every_seventh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.every_kth(table(spark, sf_dir, "orders"), "o_orderkey", 7).select("o_orderkey", "o_totalprice")


@query("SELECT c_mktsegment AS sample, CASE WHEN c_mktsegment LIKE 'B%' THEN 'control' ELSE 'case' END AS grp, count(*) AS n FROM customer WHERE c_mktsegment LIKE 'B%' OR c_mktsegment LIKE 'A%' GROUP BY ALL")
def groups_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "sample")
    return matrix.resolve_groups(samples, prefixes={"control": "B", "case": "A"}).groupBy("sample", F.col("group").alias("grp")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH t AS (SELECT l_shipmode, count(*) n, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) k FROM (SELECT l_linestatus || l_linenumber AS l_shipmode, l_returnflag FROM lineitem) GROUP BY 1), w AS (SELECT *, k / n AS p, 1.959963984540054 AS z FROM t)
SELECT l_shipmode AS key, n, k::BIGINT AS k, round((p + z*z/(2*n) - z*sqrt(p*(1-p)/n + z*z/(4*n*n))) / (1 + z*z/n), 6) AS low, round((p + z*z/(2*n) + z*sqrt(p*(1-p)/n + z*z/(4*n*n))) / (1 + z*z/n), 6) AS high FROM w""")
def wilson_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    counts = lines.groupBy(F.concat("l_linestatus", "l_linenumber").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("k"))
    low, high = stats.wilson(F.col("k"), F.col("n"))
    return counts.select("key", "n", "k", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


SCORED = "s AS (SELECT l.toxic AS label, d.n_chars % 1000 AS score, d.lang FROM labels l JOIN documents d USING (doc_id) WHERE l.toxic IS NOT NULL)"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", (F.col("n_chars") % 1000).alias("score"))
    return table(spark, sf_dir, "labels").where("toxic is not null").join(docs, "doc_id").select(F.col("toxic").alias("label"), "score", "lang")


@query(f"""WITH {SCORED}, c AS (SELECT lang, score, sum(label) AS p, sum(1 - label) AS n FROM s GROUP BY ALL)
SELECT lang, score AS threshold, round(sum(n) OVER w / nullif(sum(n) OVER (PARTITION BY lang), 0), 9) AS fpr, round(sum(p) OVER w / nullif(sum(p) OVER (PARTITION BY lang), 0), 9) AS tpr FROM c WINDOW w AS (PARTITION BY lang ORDER BY score DESC ROWS UNBOUNDED PRECEDING)""")
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = stats.roc(scored(spark, sf_dir), ["lang"])
    return curve.select("lang", "threshold", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


@query(f"""WITH {SCORED}, r AS (SELECT *, rank() OVER (PARTITION BY lang ORDER BY score) + (count(*) OVER (PARTITION BY lang, score) - 1) / 2.0 AS rk FROM s)
SELECT lang, CASE WHEN sum(label) > 0 AND sum(1 - label) > 0 THEN round((sum(rk * label) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * sum(1 - label)), 9) END AS auc FROM r GROUP BY lang""")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.auc(scored(spark, sf_dir), ["lang"]).select("lang", F.round("auc", 9).alias("auc"))


@query(f"""WITH {SCORED}, c AS (SELECT lang, score, sum(label) AS p, sum(1 - label) AS n FROM s GROUP BY ALL), k AS (SELECT lang, sum(n) OVER w / nullif(sum(n) OVER (PARTITION BY lang), 0) AS fpr, sum(p) OVER w / nullif(sum(p) OVER (PARTITION BY lang), 0) AS tpr FROM c WINDOW w AS (PARTITION BY lang ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
SELECT lang, round(coalesce(max(tpr) FILTER (fpr <= 0.1 + 1e-12), 0.0), 9) AS sensitivity FROM k GROUP BY lang""")
def sensitivity_at_specificity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.sensitivity_at(stats.roc(scored(spark, sf_dir), ["lang"]), 0.9, ["lang"]).select("lang", F.round("sensitivity", 9).alias("sensitivity"))


@query(f"WITH {SCORED} SELECT lang, round(avg((score / 1000.0 - label) * (score / 1000.0 - label)) + 1e-9, 6) AS brier FROM s GROUP BY lang")
def brier_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.brier(scored(spark, sf_dir).withColumn("score", F.col("score") / 1000), ["lang"]).select("lang", r6("brier"))


@query(f"""WITH {M}, a AS (SELECT feature, count(*) FILTER (grp='control') n0, count(*) FILTER (grp='case') n1, sum(value) FILTER (grp='control') s0, sum(value) FILTER (grp='case') s1, sum(value*value) FILTER (grp='control') q0, sum(value*value) FILTER (grp='case') q1 FROM m GROUP BY feature)
SELECT feature, CASE WHEN q0+q1-s0*s0/n0-s1*s1/n1 > 1e-12 THEN round((s0*s0/n0+s1*s1/n1-(s0+s1)*(s0+s1)/(n0+n1)) / ((q0+q1-s0*s0/n0-s1*s1/n1)/(n0+n1-2)), 5) + 0.0 END AS f FROM a WHERE n0 > 0 AND n1 > 0 AND n0+n1 > 2""")
def anova_f_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.anova_f(long_matrix(spark, sf_dir)).select("feature", F.when(F.abs("f") < 1e-5, 0.0).otherwise(F.round("f", 5)).alias("f"))


@query(f"WITH {RANKED} SELECT feature, u::DOUBLE AS u FROM u ORDER BY u DESC NULLS LAST, feature LIMIT 100")
def best_hundred_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.best_features(stats.rank_sum(long_matrix(spark, sf_dir)), "u", 100).select("feature", "u")


PAIRS = "(SELECT i, j FROM range(1, 8) a(i), range(1, 8) b(j) WHERE i < j) p"


@query(f"""WITH {M}, f AS (SELECT feature, sample, coalesce(value, avg(value) OVER (PARTITION BY sample)) AS v FROM m)
SELECT 's' || i AS a, 's' || j AS b, round(corr(x.v, y.v) + 1e-9, 6) AS r FROM {PAIRS} JOIN f x ON x.sample = 's' || i JOIN f y ON y.sample = 's' || j AND x.feature = y.feature GROUP BY ALL""")
def pearson_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.correlations(long_matrix(spark, sf_dir), SAMPLES).select("a", "b", r6("r"))


@query(f"""WITH {M}, f AS (SELECT feature, sample, rank() OVER (PARTITION BY sample ORDER BY value) + (count(*) OVER (PARTITION BY sample, value) - 1) / 2.0 AS v FROM m)
SELECT 's' || i AS a, 's' || j AS b, round(corr(x.v, y.v) + 1e-9, 6) AS r FROM {PAIRS} JOIN f x ON x.sample = 's' || i JOIN f y ON y.sample = 's' || j AND x.feature = y.feature GROUP BY ALL""")
def spearman_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.correlations(long_matrix(spark, sf_dir), SAMPLES, spearman=True).select("a", "b", r6("r"))


@query("SELECT DISTINCT l_returnflag, l_quantity, round(cume_dist() OVER (PARTITION BY l_returnflag ORDER BY l_quantity), 9) AS ecdf, round(1 - cume_dist() OVER (PARTITION BY l_returnflag ORDER BY l_quantity), 9) AS above FROM lineitem")
def ecdf_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.ecdf(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity")
    return out.select("l_returnflag", "l_quantity", F.round("ecdf", 9).alias("ecdf"), F.round("above", 9).alias("above"))


@query("SELECT o_orderpriority, quantile_disc(o_totalprice, 0.95) AS higher, round(quantile_cont(o_totalprice, 0.95), 4) AS linear FROM (SELECT o_orderpriority, o_totalprice FROM orders) GROUP BY 1".replace("quantile_disc(o_totalprice, 0.95)", "list_sort(list(o_totalprice))[ceil((count(*) - 1) * 0.95)::BIGINT + 1]"))
def quantile_higher(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(stats.higher_quantile(F.col("o_totalprice"), 0.95).alias("higher"), F.round(F.percentile("o_totalprice", 0.95), 4).alias("linear"))


@query("""WITH o AS (SELECT s_suppkey, s_nationkey AS k, s_acctbal AS v FROM supplier), n AS (SELECT c_nationkey AS k, c_acctbal AS v FROM customer)
SELECT s_suppkey, k, v, round((1 + (SELECT count(*) FROM n WHERE n.k = o.k AND n.v >= o.v)) / (1 + (SELECT count(*) FROM n WHERE n.k = o.k)), 9) AS p FROM o""")
def empirical_p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"), F.col("s_acctbal").alias("v"))
    null = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_acctbal").alias("v"))
    out = stats.empirical_p(seen, null, ["k"], "v")
    return out.withColumn("p", F.round("p", 9))


@query("""WITH s AS (SELECT DISTINCT l_linenumber AS k, l_partkey AS m FROM lineitem)
SELECT round(avg(i / u) + 1e-9, 6) AS mean_jaccard FROM (SELECT a.k AS x, b.k AS y, (SELECT count(*) FROM (SELECT m FROM s WHERE k = a.k INTERSECT SELECT m FROM s WHERE k = b.k)) AS i, (SELECT count(*) FROM (SELECT m FROM s WHERE k = a.k UNION SELECT m FROM s WHERE k = b.k)) AS u FROM (SELECT DISTINCT k FROM s) a, (SELECT DISTINCT k FROM s) b WHERE a.k < b.k)""")
def jaccard_of_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_partkey").distinct()
    return stats.mean_jaccard(sets, "l_linenumber", "l_partkey").select(r6("mean_jaccard"))


@query(f"WITH {M}, s AS (SELECT sample, grp, avg(value) AS mean FROM m GROUP BY ALL) SELECT sample, grp AS \"group\", round(mean + 1e-9, 6) AS mean, round(median(mean) OVER (PARTITION BY grp) + 1e-9, 6) AS group_median FROM s")
def sample_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.sample_means(long_matrix(spark, sf_dir)).select("sample", "group", r6("mean"), r6("group_median"))


@query(f"WITH {M} SELECT sample, round(avg(value) + 1e-9, 6) AS mean, count(value) AS n_finite, count(*) AS n_rows FROM m GROUP BY sample")
def column_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.column_means(long_matrix(spark, sf_dir), SAMPLES).select("sample", r6("mean"), "n_finite", "n_rows")


@query("""WITH t AS (SELECT o_orderpriority AS modality, o_orderkey AS feature, CASE WHEN o_custkey % 5 > 0 THEN o_custkey % 50 / 50.0 END AS q, CASE WHEN o_custkey % 7 > 0 THEN o_totalprice END AS p FROM orders)
SELECT modality, feature, q::DOUBLE AS q, p, row_number() OVER (PARTITION BY modality ORDER BY q NULLS LAST, p NULLS LAST, feature) AS place FROM t QUALIFY place <= 10""")
def lowest_q_per_modality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, p = F.when(F.col("o_custkey") % 5 > 0, F.col("o_custkey") % 50 / 50.0), F.when(F.col("o_custkey") % 7 > 0, F.col("o_totalprice"))
    tests = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("modality"), F.col("o_orderkey").alias("feature"), q.alias("q"), p.alias("p"))
    return stats.lowest_q(tests, ["modality"])


@query(f"WITH {RANKED} SELECT feature, n_a, n_b, round(u / (n_a * n_b) + 1e-9, 6) AS auc FROM u WHERE n_a * n_b > 0")
def feature_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The area under the curve of every feature; its one-sided p has no SQL form and is held against its definition in tests."""
    return stats.auc_p(stats.rank_sum(long_matrix(spark, sf_dir))).where("n_a * n_b > 0").select("feature", "n_a", "n_b", r6("auc"))


@query("SELECT o_custkey % 2 AS y_true, o_totalprice AS score, o_orderkey AS sample FROM orders ORDER BY 1, 2 DESC, 3")
def sorted_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 2).alias("y_true"), F.col("o_totalprice").alias("score"), F.col("o_orderkey").alias("sample"))
    return stats.sort_predictions(rows)


@query("SELECT l_suppkey AS feature FROM (SELECT l_suppkey, row_number() OVER (ORDER BY md5('42:' || l_suppkey), l_suppkey) AS place, count(*) OVER () AS n FROM (SELECT DISTINCT l_suppkey FROM lineitem)) WHERE place <= floor(n * 0.3::DOUBLE)")
def feature_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.feature_subset(table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("feature")), "feature", 0.3)


@query()
def best_rank_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 features of lowest rank-test p; p values have no SQL form, a test holds the choice against them."""
    return stats.best_by_rank_p(long_matrix(spark, sf_dir))
