"""Run records as tables: artifacts of stages, command ledgers, readiness checks, task states and signatures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def artifact_rows(manifests: DataFrame) -> DataFrame:
    """One row for each expected artifact of a manifest (run_id, stages: array of id, status, expected: array of path, required)."""
    stages = manifests.select("run_id", F.explode_outer("stages").alias("s"))
    return stages.select("run_id", F.col("s.id").alias("stage"), F.col("s.status").alias("status"), F.explode_outer("s.expected").alias("e")).select("run_id", "stage", "status", "e.*")


def artifact_counts(artifacts: DataFrame, listing: DataFrame) -> DataFrame:
    """Per stage: expected, required, present and missing required artifacts; ``listing`` has path and bytes, empty files count as missing."""
    there = artifacts.join(listing.select("path", "bytes"), "path", "left").withColumn("present", F.coalesce(F.col("bytes") > 0, F.lit(False)))
    n = lambda c: F.count(F.when(c, 1))
    return there.groupBy("stage").agg(F.count("path").alias("n_expected"), n(F.col("required")).alias("n_required"), n(F.col("present")).alias("n_present"), n(F.col("required") & ~F.col("present")).alias("n_missing"))


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """Starts, finishes, failures and unfinished commands of a ledger (event, command_id, returncode)."""
    per = ledger.groupBy("command_id").agg(F.max(F.when(F.col("event") == "start", 1).otherwise(0)).alias("s"), F.max(F.when(F.col("event") == "finish", 1).otherwise(0)).alias("f"), F.max(F.when((F.col("event") == "finish") & (F.col("returncode") != 0), 1).otherwise(0)).alias("x"))
    return per.agg(F.sum("s").alias("n_started"), F.sum("f").alias("n_finished"), F.sum("x").alias("n_failed"), F.sum(F.when((F.col("s") == 1) & (F.col("f") == 0), 1).otherwise(0)).alias("n_unfinished"))


def unfinished(ledger: DataFrame) -> DataFrame:
    """Commands that started and never finished."""
    starts, ends = ledger.where("event = 'start'").select("command_id").distinct(), ledger.where("event = 'finish'").select("command_id")
    return starts.join(ends, "command_id", "left_anti")


def newest_trusted(records: DataFrame, keys: Sequence[str], time: str, trusted: Sequence[str], tie: str) -> DataFrame:
    """The newest record of each key whose status is trusted; ties by ``tie``, largest first."""
    order = Window.partitionBy(*keys).orderBy(F.desc(time), F.desc(tie))
    return records.where(F.col("status").isin(*trusted)).withColumn("__at", F.row_number().over(order)).where("__at = 1").drop("__at")


def first_root_wins(rows: DataFrame, key: str, priority: str) -> DataFrame:
    """The row of lowest priority number of each key."""
    return rows.withColumn("__at", F.row_number().over(Window.partitionBy(key).orderBy(priority))).where("__at = 1").drop("__at")


def aliases(samples: DataFrame, first_group: str = "control") -> DataFrame:
    """``alias`` of each sample: its group and number from 1 in row order, ``place``: the groups' order, the first group first."""
    number = F.row_number().over(Window.partitionBy("group").orderBy("ord"))
    return samples.withColumn("alias", F.concat_ws(" ", "group", number.cast("string"))).withColumn("place", F.when(F.col("group") == first_group, 0).otherwise(1))


def check_matrix(checks: DataFrame, samples: DataFrame, names: Sequence[str]) -> DataFrame:
    """Status of every named check for every sample, MISSING where there is none."""
    listed = F.explode(F.array(*(F.lit(n) for n in names))).alias("check")
    return samples.select("sample", listed).join(checks, ["sample", "check"], "left").withColumn("status", F.coalesce("status", F.lit("MISSING")))


def status_counts(checks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many checks of each key passed, warned, failed or are missing."""
    n = lambda s: F.count(F.when(F.col("status") == s, 1))
    return checks.groupBy(*keys).agg(*(n(s).alias(s.lower()) for s in ("PASS", "WARN", "FAIL", "MISSING")))


def task_states(tasks: DataFrame) -> DataFrame:
    """State of each stage from its tasks (stage, depends_on, done, marker): complete, stale, ready or pending.

    Complete: all done and marked; stale: marked but not all done; ready: not done while the stage it depends on is
    complete, or it depends on none; else pending.
    """
    per = tasks.groupBy("stage").agg(F.max("depends_on").alias("depends_on"), F.bool_and("done").alias("done"), F.bool_or("marker").alias("marker"))
    whole = per.select(F.col("stage").alias("depends_on"), (F.col("done") & F.col("marker")).alias("ok"))
    state = F.when(F.col("done") & F.col("marker"), "complete").when(F.col("marker"), "stale").when(F.col("depends_on").isNull() | F.coalesce("ok", F.lit(False)), "ready").otherwise("pending")
    return per.join(whole, "depends_on", "left").select("stage", state.alias("state"))


def resumable(current: DataFrame, previous: DataFrame, keys: Sequence[str], signature: str) -> DataFrame:
    """Stages whose inputs are the same set with the same signatures in both tables."""
    a, b = (df.groupBy(*keys).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(signature)), "\n"), 256).alias("sig")) for df in (current, previous))
    return a.join(b.withColumnRenamed("sig", "before"), list(keys), "left").select(*keys, F.coalesce(F.col("sig") == F.col("before"), F.lit(False)).alias("same"))


def contract_differences(a: DataFrame, b: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys that only one table has, or whose values differ (null equals null), with what is wrong."""
    x = a.select(*keys, F.lit(True).alias("__a"), F.struct(*values).alias("va"))
    y = b.select(*keys, F.lit(True).alias("__b"), F.struct(*values).alias("vb"))
    both = x.join(y, list(keys), "full")
    wrong = F.when(F.col("__b").isNull(), "only first").when(F.col("__a").isNull(), "only second").when(~F.col("va").eqNullSafe(F.col("vb")), "differs")
    return both.select(*keys, wrong.alias("difference")).where("difference is not null")


def missing_from(wanted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct wanted keys that are not known."""
    return wanted.select(key).distinct().join(known.select(key), key, "left_anti")


def ordered_distinct(rows: DataFrame, value: str, order: str) -> DataFrame:
    """Distinct values with ``at``, the order of their first occurrence."""
    return rows.groupBy(value).agg(F.min(order).alias("at"))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that exactly one of the tables has."""
    return a.distinct().exceptAll(b.distinct()).unionByName(b.distinct().exceptAll(a.distinct()))


def topological(depends_on: dict[str, Sequence[str]], wanted: Sequence[str]) -> list[str]:
    """Wanted stages with all that they need, each after what it needs; a cycle or an unknown stage is an error."""
    done: list[str] = []
    open_: list[str] = []

    def visit(stage: str) -> None:
        if stage in done:
            return
        if stage not in depends_on:
            raise ValueError(f"unknown stage {stage}")
        if stage in open_:
            raise ValueError(f"cycle: {' > '.join([*open_[open_.index(stage):], stage])}")
        open_.append(stage)
        for need in depends_on[stage]:
            visit(need)
        open_.pop()
        done.append(stage)

    for stage in wanted:
        visit(stage)
    return done


def overall(states: Column) -> Column:
    """Aggregate: complete if all are, else stale, ready or pending, the first that occurs."""
    has = lambda s: F.bool_or(states == s)
    return F.when(F.bool_and(states == "complete"), "complete").when(has("stale"), "stale").when(has("ready"), "ready").otherwise("pending")


def dictionary_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Places at which two sequence dictionaries (``ord``, ``name``, ``length``) differ, with both sides' entries; no rows if they are
    equal, order included."""
    left = a.select("ord", F.struct("name", "length").alias("first"))
    right = b.select("ord", F.struct("name", "length").alias("second"))
    both = left.join(right, "ord", "full").where(~F.col("first").eqNullSafe(F.col("second")))
    return both.select("ord", F.col("first.name").alias("first_name"), F.col("first.length").alias("first_length"), F.col("second.name").alias("second_name"), F.col("second.length").alias("second_length"))


def resolve_scopes(configs: DataFrame, targeted: Sequence[str], profiles: Sequence[str] = ()) -> DataFrame:
    """``configs`` with ``targeted_assay``, ``mode`` (panel or genome), ``reason``, ``targets`` and ``error`` (null if the scope is sound).

    ``configs`` has requested, configured, assay, profile and target_bed. What is requested overrules what is configured, and without
    either it is auto: panel for an assay in ``targeted`` or a profile that begins like one of ``profiles``, else genome. A
    config with neither assay nor profile is not targeted. A panel needs targets.
    """
    scope = F.coalesce("requested", "configured", F.lit("auto"))
    assay, profile = F.lower(F.coalesce("assay", F.lit(""))), F.lower(F.coalesce("profile", F.lit("")))
    known = assay.isin(*targeted) if targeted else F.lit(False)
    for begin in profiles:
        known = known | profile.startswith(begin)
    mode = F.when(scope == "auto", F.when(known, "panel").otherwise("genome")).when(scope.isin("panel", "genome"), scope)
    reason = F.when(scope != "auto", "explicit user override").when(known, "default targeted assay").otherwise("non-targeted assay or custom profile")
    bed = F.nullif("target_bed", F.lit(""))
    error = F.when(mode.isNull(), F.concat(F.lit("unknown scope "), scope)).when((mode == "panel") & bed.isNull(), "a panel scope needs target regions")
    return configs.select("*", known.alias("targeted_assay"), mode.alias("mode"), F.when(mode.isNotNull(), reason).alias("reason"), F.when(mode == "panel", bed).alias("targets"), error.alias("error"))


def scope_keys(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``scope_key`` of each of ``keys``: 16 hex digits that depend on its inputs (label, path, signature) and not on the rows' order.

    Each input is hashed alone and the hashes are put in order, so a group is as small as its number of inputs.
    """
    one = F.sha2(F.concat_ws("\x1f", F.col("label"), F.coalesce("path", F.lit("")), F.coalesce("signature", F.lit("missing"))), 256)
    return records.groupBy(*keys).agg(F.array_sort(F.collect_set(one)).alias("all")).select(*keys, F.substring(F.sha2(F.concat_ws(",", "all"), 256), 1, 16).alias("scope_key"))
