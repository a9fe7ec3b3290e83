import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortry.functions import special
from cohortry.operators import models, power, stats


def reference_sites(spark, n=120, depths=(10, 30)):
    rng = np.random.default_rng(1)
    mean = rng.uniform(0.2, 0.8, n)
    rows = [(f"chr1_{i}", d, float(mean[i]), float(0.05 + 0.2 / d)) for i in range(n) for d in depths]
    return spark.createDataFrame(rows, "site string, depth int, mean double, sd double")


def test_special_functions():
    assert math.isclose(float(special.beta_inc(2, 3, 0.4)), 0.5248, abs_tol=1e-9)
    assert np.allclose(special.beta_inc(5.5, 2.5, special.beta_inc_inv(5.5, 2.5, np.array([0.01, 0.5, 0.99]))), [0.01, 0.5, 0.99])
    assert math.isclose(float(special.t_cdf(2.0, 10)), 0.963305983, abs_tol=1e-8)
    p = 0.3
    assert math.isclose(float(special.nbinom_cdf(4, 3, p)), sum(math.comb(k + 2, k) * p**3 * (1 - p) ** k for k in range(5)), rel_tol=1e-9)
    assert math.isclose(float(special.normal_quantile(np.array([0.975]))[0]), 1.959963985, abs_tol=1e-8)
    assert special.exact_rank_p(3, 3, 9.0) == pytest.approx(0.1) and special.exact_rank_p(2, 4, 4.0) == 1.0


def test_grid_has_sane_powers(spark):
    templates = power.prepare_templates(reference_sites(spark), 2, 40, 6, 0.25, 0.02, 3).cache()
    assert templates.where("is_signal").select("template", "feature").distinct().count() == 12
    missing = {10: 0.1, 30: 0.02}
    run = lambda t, sims, null: power.run_replicates(power.replicate_plan(spark, 2, [24], sims), t, missing, 5, k=8, null=null).cache()
    signal, null = run(templates, 6, False), run(power.null_templates(templates), 19, True)
    assert null.where("recall is not null").count() == 0 and signal.where("auc between 0 and 1").count() == 24
    with pytest.raises(ValueError, match="at least 19"):
        power.calibrate(signal, null.where("sim < 18"))
    detected = power.calibrate(signal, null, metrics=("auc", "jaccard"))
    alone = power.calibrate(signal, null)
    curve = {r.depth: r for r in power.power_curve(power.template_summary(alone)).collect()}
    joint = {r.depth: r for r in power.power_curve(power.template_summary(detected)).collect()}
    assert set(curve) == {10, 30} and all(0 <= joint[d].power <= curve[d].power <= 1 and curve[d].n_templates == 2 for d in curve)
    assert curve[30].power > 0.5
    bounds = power.bootstrap_bounds(alone, reps=200).collect()
    assert all(0 <= r.low <= r.high <= 1 for r in bounds)


def test_curve_counts_each_template_once(spark):
    rows = [(0, 10, 20, i, True, 0.9) for i in range(10)] + [(1, 10, 20, i, False, 0.5) for i in range(2)]
    df = spark.createDataFrame(rows, "template int, n int, depth int, sim int, detected boolean, auc double")
    assert power.power_curve(power.template_summary(df)).first().power == 0.5


def test_paired_models_and_adaptive_stop(spark):
    rows = [(0, 10, 20, i, m, 0.5 + 0.01 * i * (m == "b")) for i in range(6) for m in "ab"]
    got = power.paired_models(spark.createDataFrame(rows, "template int, n int, depth int, sim int, model string, auc double"), ["a", "b"]).first()
    assert got.n_pairs == 6 and got.p_above_0 == pytest.approx(5 / 6) and got.p_above_5 == pytest.approx(1 / 6)
    batch = lambda first, count: spark.range(first, first + count).select(F.lit(1).alias("n"), (F.col("id") % 2 == 0).alias("detected"))
    assert power.adaptive(batch, ["n"], 0.3, 20, 200, 20).count() == 40


def test_site_power_and_inputs(spark):
    df = spark.createDataFrame([(0.2, 0.1, 50), (0.0, 0.1, 50), (0.2, 0.1, 3)], "d double, s double, n int")
    got = [r[0] for r in df.select(power.site_power(F.col("d"), F.col("s"), F.col("n"), tests=1)).collect()]
    assert got[0] > 0.999 and got[1] == pytest.approx(0.05) and 0.3 < got[2] < 0.7
    assert power.parse_sizes("20, 40-80:20") == [20, 40, 60, 80]
    with pytest.raises(ValueError):
        power.parse_sizes("3, x")
    with pytest.raises(ValueError):
        power.work_units(10, [2000], 100, 11)
    got = [df.select(power.missing_rate(F.lit(float(d)))).first()[0] for d in (1, 5, 14, 15, 30, 0)]
    assert got[-1] is None and got[0] > got[1] > got[2] > got[3] > got[4] > 0


def cohort(spark):
    rng = np.random.default_rng(4)
    labels = {f"s{i:02d}": i % 2 for i in range(16)}
    rows = [(m, f"f{j}", s, float(rng.normal() + (m == "good") * (j < 3) * 2.5 * y)) for m in ("good", "noise") for j in range(10) for s, y in labels.items()]
    return labels, spark.createDataFrame(rows, "modality string, feature string, sample string, value double")


def test_cross_validation_ranks_modalities_and_stack(spark):
    labels, long = cohort(spark)
    best = models.modality_performance(long, labels, folds=4, repeats=2, k=5).collect()
    assert best[0].modality == "good" and best[0].mean_auc > 0.8 and len(best) == 6
    out = models.leave_one_out(long, labels, {"good": 2, "noise": 2}, k=5)
    assert out.count() == 48
    auc = {r.modality: r.auc for r in stats.auc(out.withColumnRenamed("y_true", "label"), ["modality"]).collect()}
    assert auc["good"] > 0.75 and auc["Multimodal"] > 0.6


def test_components_equal_a_direct_decomposition(spark):
    _, long = cohort(spark)
    long = long.where("modality = 'good'").drop("modality")
    samples = [f"s{i:02d}" for i in range(16)]
    coords, explained = models.principal_components(long, samples, 3)
    x = long.toPandas().pivot(index="sample", columns="feature", values="value").to_numpy()
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    assert np.allclose([r.pct for r in explained.collect()], 100 * s[:3] ** 2 / (s**2).sum())
    got = np.array([r.value for r in coords.where("pc = 'PC1'").orderBy("sample").collect()])
    assert np.allclose(np.abs(got), np.abs(u[:, 0] * s[0]))


def test_rank_p_and_adjustment(spark):
    rows = [("x", g, v) for g, vs in (("control", [1.0, 2.0, 3.0]), ("case", [4.0, 5.0, 6.0])) for v in vs] + [("y", "control", 1.0), ("y", "case", None)]
    got = {r.feature: r for r in stats.rank_p(stats.rank_sum(spark.createDataFrame(rows, "feature string, group string, value double"))).collect()}
    assert got["x"].u == 9 and got["x"].p == pytest.approx(0.1) and got["y"].p is None
    tests = spark.createDataFrame([("a", 0.01), ("b", 0.04), ("c", 0.03), ("d", None)], "feature string, p double")
    q = {r.feature: r.q for r in stats.adjust_p(tests).collect()}
    assert q["a"] == pytest.approx(0.04) and q["b"] == pytest.approx(0.16 / 3) and q["c"] == pytest.approx(0.16 / 3) and q["d"] is None


def test_effects_go_in_the_wanted_direction(spark):
    effects = {}
    for direction in ("positive", "negative", "balanced"):
        rows = power.prepare_templates(reference_sites(spark), 1, 40, 6, 0.04, 0.0, 12, direction).select("feature", "effect", "is_signal").distinct().collect()
        assert len(rows) == 40 and sum(r.is_signal for r in rows) == 6 and all(r.effect == 0 for r in rows if not r.is_signal)
        effects[direction] = [r.effect for r in rows if r.is_signal]
    assert all(e > 0 for e in effects["positive"]) and all(e < 0 for e in effects["negative"])
    assert sum(e > 0 for e in effects["balanced"]) == 3
    with pytest.raises(ValueError, match="direction"):
        power.prepare_templates(reference_sites(spark), 1, 40, 6, 0.04, 0.0, 12, "up")


def test_power_is_worked_out_once_for_equal_sites(spark, monkeypatch):
    d, s, n, a = (np.repeat(np.array(v, float), 500) for v in ([0.2, 0.2, 0.1, 0.3, np.nan, 0.2], [0.1, 0.3, 0.1, 0.0, 0.2, np.nan], [3, 3, 50, 3, 3, 10], [0.05, 0.01, 0.05, 0.05, 0.05, 0.05]))
    want = power._powers(d, s, n, a)
    sizes = []
    monkeypatch.setattr(power, "t_cdf", lambda t, df, own=power.t_cdf: sizes.append(np.size(t)) or own(t, df))
    got = power._site_power.func(*(pd.Series(v) for v in (d, s, n, a)))
    # three sites of few samples, at two levels
    assert np.allclose(got, want, equal_nan=True) and list(got.isna()) == [False] * 1500 + [True] * 1500
    assert max(sizes) < 1100  # rows with nulls are not alike


def test_paired_lines_are_grouped_in_parts_of_bounded_size(spark, monkeypatch):
    from cohortry import session
    from cohortry.plans import model_queries

    monkeypatch.setattr(session, "GROUPED_ROWS", 500)
    out = model_queries.paired_model_difference(spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # one exchange of lines by their replicate, in 12 or more parts of 6,000 lines, and the one of the summary
    assert plan.count("Exchange hashpartitioning") == 2 and "pivotfirst" not in plan.lower()
    assert session.spread(spark.range(10), ["id"], 6000).rdd.getNumPartitions() == 12
