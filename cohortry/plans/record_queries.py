"""Region and provenance queries: orders are region calls, part brands genes, events ledger entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import provenance, regions
from cohortry.plans.registry import query, table

CALLS = """ca AS (SELECT o_orderstatus AS chrom, o_orderkey * 10 AS start, o_orderkey * 10 + 5 + o_custkey % 20 AS "end", CASE WHEN o_orderkey % 211 = 0 THEN 0.0 ELSE (o_custkey % 1000 + 1) / 10000.0::DOUBLE END AS q_value, ((o_totalprice::BIGINT % 2001) - 1000) / 1000.0::DOUBLE AS mean_diff,
  CASE WHEN o_orderkey % 17 = 0 THEN ' NA ' WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 'LINC' || o_custkey % 50 WHEN o_orderkey % 29 = 0 THEN 'G' || o_custkey % 50 || 'AS1' ELSE 'G' || o_custkey % 300 END AS symbol, CASE WHEN o_orderkey % 3 = 0 THEN 'promoter' ELSE 'exon' END AS annot_type FROM orders)"""


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    symbol = (
        F.when(key % 17 == 0, " NA ")
        .when(key % 19 == 0, F.lit(None).cast("string"))
        .when(key % 23 == 0, F.concat(F.lit("LINC"), cust % 50))
        .when(key % 29 == 0, F.concat(F.lit("G"), cust % 50, F.lit("AS1")))
        .otherwise(F.concat(F.lit("G"), cust % 300))
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("chrom"), (key * 10).alias("start"), (key * 10 + 5 + cust % 20).alias("end"),
        F.when(key % 211 == 0, 0.0).otherwise((cust % 1000 + 1) / 10000.0).alias("q_value"),
        ((F.rint("o_totalprice").cast("long") % 2001 - 1000) / 1000.0).alias("mean_diff"),
        symbol.alias("symbol"), F.when(key % 3 == 0, "promoter").otherwise("exon").alias("annot_type"),
    )


CLEAN = "CASE WHEN lower(trim(coalesce(symbol, ''))) IN ('na', 'nan', 'none', '', '.', '-') THEN '' ELSE trim(coalesce(symbol, '')) END"


@query(f"WITH {CALLS} SELECT chrom, start, {CLEAN} AS symbol FROM ca")
def clean_gene_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls(spark, sf_dir).select("chrom", "start", regions.clean_name(F.col("symbol")).alias("symbol"))


@query(f"WITH {CALLS} SELECT chrom, start, symbol FROM ca WHERE annot_type = 'promoter' AND symbol IS NOT NULL AND NOT regexp_matches(symbol, '^(LOC|LINC|MIR)[0-9]') AND NOT symbol LIKE '%AS1'")
def coding_promoters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.coding_promoters(calls(spark, sf_dir), "promoter").select("chrom", "start", "symbol")


BEST = f"be AS (SELECT * FROM (SELECT * EXCLUDE (symbol), {CLEAN} AS symbol FROM ca) WHERE symbol <> '' QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY q_value, abs(mean_diff) DESC, chrom, start, \"end\") = 1)"


@query(f"WITH {CALLS}, {BEST} SELECT symbol, chrom, start, q_value, mean_diff FROM be")
def best_call_per_gene(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.best_per_gene(calls(spark, sf_dir)).select("symbol", "chrom", "start", "q_value", "mean_diff")


VOLCANO = f"""{CALLS}, th AS (SELECT quantile_cont(abs(mean_diff), 0.1) AS t FROM ca WHERE q_value < 0.05), lg AS (SELECT *, -log10(greatest(CASE WHEN q_value = 0 THEN (SELECT min(q_value) FROM ca WHERE q_value > 0) ELSE q_value END, 1e-300)) AS nl FROM ca),
vo AS (SELECT chrom, start, symbol, mean_diff, q_value, nl, least(nl, ceil((SELECT max(nl) FROM lg) / 10) * 10) AS capped, CASE WHEN q_value < 0.05 AND abs(mean_diff) >= t AND mean_diff > 0 THEN 'Hyper' WHEN q_value < 0.05 AND abs(mean_diff) >= t AND mean_diff < 0 THEN 'Hypo' ELSE 'NS' END AS direction FROM lg, th)"""


@query(f"WITH {VOLCANO} SELECT chrom, start, direction, round(nl + 1e-9, 6) AS neg_log_q, round(capped + 1e-9, 6) AS capped FROM vo")
def volcano_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.volcano(calls(spark, sf_dir)).select("chrom", "start", "direction", F.round(F.col("neg_log_q") + 1e-9, 6).alias("neg_log_q"), F.round(F.col("capped") + 1e-9, 6).alias("capped"))


@query(f"WITH {VOLCANO} SELECT direction, row_number() OVER w AS place, symbol, mean_diff FROM vo WHERE direction <> 'NS' WINDOW w AS (PARTITION BY direction ORDER BY abs(mean_diff) DESC, symbol NULLS FIRST, chrom, start) QUALIFY row_number() OVER w <= 10")
def strongest_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.strongest_labels(regions.volcano(calls(spark, sf_dir))).select("direction", F.col("at").alias("place"), "symbol", "mean_diff")


@query(f"""WITH {VOLCANO}, nm AS (SELECT * EXCLUDE (symbol), {CLEAN} AS symbol FROM vo WHERE direction <> 'NS'), b AS (SELECT * FROM nm WHERE symbol <> '' QUALIFY row_number() OVER (PARTITION BY direction, symbol ORDER BY nl DESC, chrom, start) = 1)
SELECT direction, row_number() OVER (PARTITION BY direction ORDER BY nl DESC, symbol) AS place, symbol, start FROM b QUALIFY row_number() OVER (PARTITION BY direction ORDER BY nl DESC, symbol) <= 10""")
def top_genes_by_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.top_genes(regions.volcano(calls(spark, sf_dir))).select("direction", F.col("at").alias("place"), "symbol", "start")


@query(f"WITH {CALLS}, {BEST.replace('FROM ca)', 'FROM ca WHERE q_value < 0.05)')} SELECT symbol, q_value, mean_diff FROM be ORDER BY q_value, symbol LIMIT 50")
def leading_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.leading_genes(calls(spark, sf_dir)).select("symbol", "q_value", "mean_diff")


@query(f"WITH {CALLS} SELECT count(*) AS n_rows, count(*) FILTER (q_value < 0.05) AS n_significant, count(DISTINCT CASE WHEN q_value < 0.05 THEN nullif({CLEAN}, '') END) AS n_genes FROM ca")
def region_call_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.call_counts(calls(spark, sf_dir))


@query(f"""WITH {CALLS}, an AS (SELECT o_orderstatus AS chrom, o_orderkey * 13 AS start, o_orderkey * 13 + 8 AS "end", 'a' || o_orderkey AS id FROM orders) SELECT ca.start, an.id FROM ca JOIN an ON ca.chrom = an.chrom AND ca.start < an."end" AND ca."end" > an.start""")
def annotated_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    notes = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("chrom"), (key * 13).alias("start"), (key * 13 + 8).alias("end"), F.concat(F.lit("a"), key).alias("id"))
    return regions.annotate(calls(spark, sf_dir).select("chrom", "start", "end"), notes, 32).select("start", "id")


ART = "ar AS (SELECT o_orderpriority AS stage, 'p' || o_orderkey AS path, o_custkey % 3 > 0 AS required FROM orders), li AS (SELECT 'p' || o_orderkey AS path, (o_totalprice::BIGINT % 10) AS bytes FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderstatus = 'P')"


@query(f"""WITH {ART}, t AS (SELECT ar.*, coalesce(bytes > 0, false) AS present FROM ar LEFT JOIN li USING (path)) SELECT stage, count(*) AS n_expected, count(*) FILTER (required) AS n_required, count(*) FILTER (present) AS n_present, count(*) FILTER (required AND NOT present) AS n_missing FROM t GROUP BY stage""")
def artifact_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = F.concat(F.lit("p"), "o_orderkey").alias("path")
    entry = F.struct(path, (F.col("o_custkey") % 3 > 0).alias("required"))
    stages = orders.groupBy("o_orderpriority", (F.col("o_orderkey") % 100).alias("run")).agg(F.collect_list(entry).alias("expected"))
    manifests = stages.groupBy("run").agg(F.collect_list(F.struct(F.col("o_orderpriority").alias("id"), F.lit("complete").alias("status"), "expected")).alias("stages")).withColumnRenamed("run", "run_id")
    listing = orders.where("o_orderpriority <> '5-LOW' or o_orderstatus = 'P'").select(path, (F.rint("o_totalprice").cast("long") % 10).alias("bytes"))
    return provenance.artifact_counts(provenance.artifact_rows(manifests), listing)


LEDGER = "le AS (SELECT CASE WHEN event_type IN ('signup', 'view') THEN 'start' ELSE 'finish' END AS event, user_id * 100 + day(ts) AS command_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS returncode FROM events)"


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return rows.select(F.when(F.col("event_type").isin("signup", "view"), "start").otherwise("finish").alias("event"), (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("command_id"), F.when(F.col("event_type") == "error", 1).otherwise(0).alias("returncode"))


@query(f"WITH {LEDGER}, p AS (SELECT command_id, max((event = 'start')::INT) AS s, max((event = 'finish')::INT) AS f, max((event = 'finish' AND returncode <> 0)::INT) AS x FROM le GROUP BY 1) SELECT sum(s)::BIGINT AS n_started, sum(f)::BIGINT AS n_finished, sum(x)::BIGINT AS n_failed, count(*) FILTER (s = 1 AND f = 0)::BIGINT AS n_unfinished FROM p")
def ledger_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance.ledger_summary(ledger(spark, sf_dir))


@query(f"WITH {LEDGER} SELECT DISTINCT command_id FROM le WHERE event = 'start' AND command_id NOT IN (SELECT command_id FROM le WHERE event = 'finish')")
def unfinished_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance.unfinished(ledger(spark, sf_dir))


@query("SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O') QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def newest_trusted_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "status")
    return provenance.newest_trusted(rows, ["o_custkey"], "o_orderdate", ["F", "O"], "o_orderkey").select("o_custkey", "o_orderkey")


@query("SELECT l_partkey, root, score FROM (SELECT l_partkey, l_linenumber AS root, max(l_quantity) AS score FROM lineitem GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY root) = 1")
def first_root_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy("l_partkey", F.col("l_linenumber").alias("root")).agg(F.max("l_quantity").alias("score"))
    return provenance.first_root_wins(rows, "l_partkey", "root")


@query("SELECT c_custkey, c_mktsegment || ' ' || row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS alias, CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END AS place FROM customer")
def sample_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("group"), F.col("c_custkey").alias("ord"))
    return provenance.aliases(rows, "BUILDING").select("c_custkey", "alias", "place")


CHECKS = """ck AS (SELECT DISTINCT ON (user_id, event_type) user_id AS sample, event_type AS "check", CASE WHEN value < 20 THEN 'PASS' WHEN value < 80 THEN 'WARN' ELSE 'FAIL' END AS status FROM events ORDER BY user_id, event_type, event_id),
mx AS (SELECT s.sample, n."check", coalesce(ck.status, 'MISSING') AS status FROM (SELECT DISTINCT user_id AS sample FROM events) s CROSS JOIN (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS "check") n LEFT JOIN ck ON ck.sample = s.sample AND ck."check" = n."check")"""


def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortry.operators.matrix import first_per_key

    events = table(spark, sf_dir, "events")
    rows = first_per_key(events, ["user_id", "event_type"], ["event_id"])
    made = rows.select(F.col("user_id").alias("sample"), F.col("event_type").alias("check"), F.when(F.col("value") < 20, "PASS").when(F.col("value") < 80, "WARN").otherwise("FAIL").alias("status"))
    samples = events.select(F.col("user_id").alias("sample")).distinct()
    return provenance.check_matrix(made, samples, ["click", "error", "purchase", "signup", "view"])


@query(f'WITH {CHECKS} SELECT sample, "check", status FROM mx')
def readiness_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks(spark, sf_dir)


@query(f"""WITH {CHECKS} SELECT "check", count(*) FILTER (status = 'PASS') AS pass, count(*) FILTER (status = 'WARN') AS warn, count(*) FILTER (status = 'FAIL') AS fail, count(*) FILTER (status = 'MISSING') AS missing FROM mx GROUP BY ALL""")
def readiness_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance.status_counts(checks(spark, sf_dir), ["check"])


@query("""WITH t AS (SELECT o_custkey % 400 AS stage, max(CASE WHEN o_custkey % 400 % 4 > 0 THEN o_custkey % 400 - 1 END) AS dep, bool_and(o_totalprice > 20000) AS done, bool_or(o_orderstatus = 'P') AND (o_custkey % 400) % 3 > 0 AS marker FROM orders GROUP BY 1)
SELECT t.stage, CASE WHEN t.done AND t.marker THEN 'complete' WHEN t.marker THEN 'stale' WHEN t.dep IS NULL OR coalesce(d.done AND d.marker, false) THEN 'ready' ELSE 'pending' END AS state FROM t LEFT JOIN t d ON d.stage = t.dep""")
def task_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = F.col("o_custkey") % 400
    rows = table(spark, sf_dir, "orders").select(stage.alias("stage"), F.when(stage % 4 > 0, stage - 1).alias("depends_on"), (F.col("o_totalprice") > 20000).alias("done"), ((F.col("o_orderstatus") == "P") & (stage % 3 > 0)).alias("marker"))
    return provenance.task_states(rows)


@query("""WITH a AS (SELECT o_custkey AS k, string_agg(o_orderpriority, chr(10) ORDER BY o_orderpriority) AS s FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1), b AS (SELECT o_custkey AS k, string_agg(o_orderpriority, chr(10) ORDER BY o_orderpriority) AS s FROM orders WHERE o_orderstatus <> 'P' OR o_totalprice > 150000 GROUP BY 1)
SELECT a.k AS o_custkey, coalesce(a.s = b.s, false) AS same FROM a LEFT JOIN b USING (k)""")
def resumable_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    return provenance.resumable(rows.where("o_orderstatus <> 'P'"), rows.where("o_orderstatus <> 'P' or o_totalprice > 150000"), ["o_custkey"], "o_orderpriority")


@query("""WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS v FROM orders WHERE o_orderstatus <> 'P'), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderstatus END AS v FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT k, CASE WHEN b.v IS NULL AND b.k2 IS NULL THEN 'only first' WHEN a.k2 IS NULL THEN 'only second' ELSE 'differs' END AS difference FROM (SELECT *, k AS k2 FROM a) a FULL JOIN (SELECT *, k AS k2 FROM b) b USING (k) WHERE a.k2 IS NULL OR b.k2 IS NULL OR a.v IS DISTINCT FROM b.v""")
def contract_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"), "o_orderpriority")
    b = rows.where("o_orderpriority <> '5-LOW'").withColumn("v", F.when(F.col("k") % 9 != 0, F.col("v")))
    return provenance.contract_differences(rows.where("v <> 'P'"), b, ["k"], ["v"])


@query("SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)")
def missing_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "orders").where("o_totalprice > 100000").select(F.col("o_custkey").alias("k"))
    return provenance.missing_from(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), known, "k")


@query("SELECT o_orderpriority, min(o_orderkey) AS at FROM orders GROUP BY 1".replace("AS at", 'AS "at"'))
def ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance.ordered_distinct(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderkey")


@query("WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_linenumber < 7), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_linenumber = 7) (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)")
def symmetric_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "lineitem")
    return provenance.symmetric_difference(keys.where("l_linenumber < 7").select(F.col("l_partkey").alias("k")), keys.where("l_linenumber = 7").select(F.col("l_partkey").alias("k")))


@query("""WITH a AS (SELECT row_number() OVER (ORDER BY n_nationkey) AS ord, n_name AS name, n_nationkey AS length FROM nation), b AS (SELECT row_number() OVER (ORDER BY n_nationkey) AS ord, CASE WHEN n_nationkey = 7 THEN 'other' ELSE n_name END AS name, n_nationkey AS length FROM nation WHERE n_nationkey < 20)
SELECT ord, coalesce(a.name, '-') AS first_name, coalesce(a.length, -1) AS first_length, coalesce(b.name, '-') AS second_name, coalesce(b.length, -1) AS second_length FROM a FULL JOIN b USING (ord) WHERE a.name IS DISTINCT FROM b.name OR a.length IS DISTINCT FROM b.length""")
def dictionary_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    a = nation.select((F.col("n_nationkey") + 1).alias("ord"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("length"))
    b = nation.where("n_nationkey < 20").select((F.col("n_nationkey") + 1).alias("ord"), F.when(F.col("n_nationkey") == 7, "other").otherwise(F.col("n_name")).alias("name"), F.col("n_nationkey").alias("length"))
    return provenance.dictionary_differences(a, b).fillna("-", ["first_name", "second_name"]).fillna(-1, ["first_length", "second_length"])


SCOPES = """sc AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'genome' WHEN o_orderkey % 9 = 1 THEN 'whole' END AS requested, CASE o_custkey % 4 WHEN 0 THEN 'panel' WHEN 1 THEN 'auto' END AS configured,
  CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS assay, CASE WHEN o_custkey % 5 = 0 THEN 'Panel_V' || o_custkey END AS profile, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 't' || o_orderkey || '.bed' END AS target_bed FROM orders),
sk AS (SELECT *, coalesce(requested, configured, 'auto') AS scope, lower(coalesce(assay, '')) IN ('1-urgent', '2-high') OR starts_with(lower(coalesce(profile, '')), 'panel_') AS known FROM sc),
sm AS (SELECT *, CASE WHEN scope = 'auto' THEN CASE WHEN known THEN 'panel' ELSE 'genome' END WHEN scope IN ('panel', 'genome') THEN scope END AS mode FROM sk)"""


@query(f"WITH {SCOPES} SELECT o_orderkey, known AS targeted_assay, mode, CASE WHEN mode IS NULL THEN NULL WHEN scope <> 'auto' THEN 'explicit user override' WHEN known THEN 'default targeted assay' ELSE 'non-targeted assay or custom profile' END AS reason, CASE WHEN mode = 'panel' THEN nullif(target_bed, '') END AS targets, CASE WHEN mode IS NULL THEN 'unknown scope ' || scope WHEN mode = 'panel' AND target_bed = '' THEN 'a panel scope needs target regions' END AS error FROM sm")
def scope_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are runs with a configuration each."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    configs = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(k % 9 == 0, "genome").when(k % 9 == 1, "whole").alias("requested"), F.when(c % 4 == 0, "panel").when(c % 4 == 1, "auto").alias("configured"),
        F.when(c % 3 != 0, F.col("o_orderpriority")).alias("assay"), F.when(c % 5 == 0, F.concat(F.lit("Panel_V"), c)).alias("profile"), F.when(k % 2 == 0, "").otherwise(F.concat(F.lit("t"), k, F.lit(".bed"))).alias("target_bed"),
    )
    return provenance.resolve_scopes(configs, ["1-urgent", "2-high"], ["panel_"]).select("o_orderkey", "targeted_assay", "mode", "reason", "targets", "error")


@query("""WITH i AS (SELECT DISTINCT l_orderkey AS run, sha256(l_returnflag || chr(31) || 'p' || l_partkey || chr(31) || CASE WHEN l_linenumber = 7 THEN 'missing' ELSE l_linestatus END) AS h FROM lineitem)
SELECT run, substr(sha256(string_agg(h, ',' ORDER BY h)), 1, 16) AS scope_key FROM i GROUP BY run""")
def scope_input_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are runs, their lines the inputs."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run"), F.col("l_returnflag").alias("label"), F.concat(F.lit("p"), F.col("l_partkey")).alias("path"), F.when(F.col("l_linenumber") != 7, F.col("l_linestatus")).alias("signature"))
    return provenance.scope_keys(lines, ["run"])
