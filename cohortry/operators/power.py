"""Study power by simulation: depth models, templates, simulated cohorts, grids of sizes and depths, and their summaries.

A template is a set of features with beta-distributed values for controls and cases at every sequencing depth. A replicate
draws one cohort from a template; replicates are rows, so Spark deals them over tasks and each is simulated in numpy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cohortry.functions.special import beta_inc_inv, nbinom_cdf, normal_cdf, normal_quantile, normal_tail, t_cdf
from cohortry.operators.stats import wilson

# fixed values: calibration of read depth (slope, intercept, and the two numbers of its dispersion) and of the share of unusable
# observations (slope, intercept), the depth from which it holds, and the tests of a genome-wide scan
SLOPE, INTERCEPT = 1.3409309326892476, 3.526927718332715
DISPERSION_AT, DISPERSION_BY = 0.6291928395185754, 0.02390549241316919
MISSING_SLOPE, MISSING_INTERCEPT = -0.0007582750922856895, 4.56905302776041
CALIBRATED = 15.0
TESTS = 3_771_981


def depth_parameters(mean_depth: Column) -> tuple[Column, Column, Column]:
    """Size and success probability of the negative binomial of read depth, and the calibrated share of missing values."""
    size = (mean_depth / (SLOPE * mean_depth + INTERCEPT) - DISPERSION_AT) / DISPERSION_BY
    return size, size / (size + mean_depth), (mean_depth * size * MISSING_SLOPE + MISSING_INTERCEPT) / 100


@F.pandas_udf(DoubleType())
def _fewer(depth: pd.Series, size: pd.Series, p: pd.Series) -> pd.Series:
    short, n, q = np.maximum(CALIBRATED - depth.to_numpy(float), 0.0), size.to_numpy(float), p.to_numpy(float)
    return pd.Series(nbinom_cdf(short, n, q) - nbinom_cdf(np.zeros(len(n)), n, q))


def missing_rate(mean_depth: Column) -> Column:
    """Calibrated share of unusable observations at a mean depth, 0 to 1; below the calibrated depth, also of the sites whose reads
    there would not make up the difference. Null for a depth that is not positive."""
    deep = depth_parameters(mean_depth)[2]
    size, p, base = depth_parameters(F.lit(CALIBRATED))
    rate = F.when(mean_depth >= CALIBRATED, deep).otherwise(base + _fewer(mean_depth, size, p))
    return F.when(mean_depth > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), rate)))


def beta_shape(mean: Column, sd: Column) -> tuple[Column, Column]:
    """Shape parameters of the beta distribution of a mean and deviation; null where none exists."""
    total = mean * (1 - mean) / (sd * sd) - 1
    ok = (mean > 0) & (mean < 1) & (sd > 0) & (sd * sd < mean * (1 - mean))
    return F.when(ok, mean * total), F.when(ok, (1 - mean) * total)


def has_beta(mean: Column, sd: Column, epsilon: float) -> Column:
    """Whether a mean and deviation are those of a beta distribution; false for nulls."""
    ok = (mean > epsilon) & (mean < 1 - epsilon) & (sd > 0) & (sd * sd < mean * (1 - mean))
    return F.coalesce(ok, F.lit(False))


def feasible(sites: DataFrame, epsilon: float = 1e-6) -> DataFrame:
    """Sites (site, mean, sd, one row for each depth) that have a beta distribution at every depth."""
    return sites.groupBy("site").agg(F.bool_and(has_beta(F.col("mean"), F.col("sd"), epsilon)).alias("ok")).where("ok").select("site")


def once(df: DataFrame, key: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``value`` of each ``key`` (and ``by``); one that stands on several rows is an error."""
    said = F.concat(F.lit(f"{key} occurs more than once: "), F.col(key).cast("string"))
    return df.groupBy(key, *by).agg(F.count(F.lit(1)).alias("__n"), F.first(value).alias(value)).withColumn(value, F.when(F.col("__n") == 1, F.col(value)).otherwise(F.raise_error(said))).drop("__n")


def site_moments(means: DataFrame, deviations: DataFrame) -> DataFrame:
    """``site``, ``depth``, ``mean``, ``sd`` of the sites that both tables have: means (site, mean) and deviations (site, depth, sd).

    A site with two means, or with two deviations of one depth, is an error; the order of rows does not matter.
    """
    key = lambda df: df.withColumn("site", F.col("site").cast("string"))
    return once(key(deviations), "site", "sd", ["depth"]).join(once(key(means), "site", "mean"), "site").select("site", "depth", "mean", "sd")


def feasibility(moments: DataFrame, epsilon: float = 1e-6) -> DataFrame:
    """For each depth of :func:`site_moments`: ``n_aligned`` sites, ``n_feasible`` with a beta distribution, their ``fraction``, and
    ``n_common``, the sites that have one at every depth; a site without a row at some depth is not common."""
    ok = has_beta(F.col("mean"), F.col("sd"), epsilon)
    depths = moments.groupBy("depth").agg(F.count(F.lit(1)).alias("n_aligned"), F.count(F.when(ok, 1)).alias("n_feasible"))
    per_site = moments.where(ok).groupBy("site").agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("sites"))  # at most a row for each depth
    numbered = depths.withColumn("n_depths", F.count(F.lit(1)).over(Window.partitionBy()))
    joined = numbered.join(F.broadcast(per_site), F.col("n") == F.col("n_depths"), "left")
    return joined.select("depth", "n_aligned", "n_feasible", (F.col("n_feasible") / F.col("n_aligned")).alias("fraction"), F.coalesce("sites", F.lit(0)).cast("long").alias("n_common"))


def prepare_templates(sites: DataFrame, n_templates: int, n_features: int, n_signal: int, effect: float, effect_sd: float, seed: int, direction: str = "random") -> DataFrame:
    """Long templates: template, feature, site, depth, mean, sd, effect, is_signal.

    For each template ``n_features`` feasible sites with the smallest hashes are taken; the first ``n_signal`` carry signed
    effects drawn from a normal truncated to above 0, the largest effect to the site with most room. An effect that would
    leave a feature without a beta distribution is cut to nine tenths of the room. ``direction`` is that of the effects:
    positive, negative, balanced (as many of either, or one more that is positive) or random.
    """
    if direction not in ("positive", "negative", "balanced", "random"):
        raise ValueError(f"unknown direction {direction}")
    spark = sites.sparkSession
    ids = spark.range(n_templates).select(F.col("id").cast("int").alias("template"))
    kept = feasible(sites)
    hashed = kept.crossJoin(F.broadcast(ids)).withColumn("h", F.xxhash64(F.lit(seed), "template", "site"))
    # the limit on the bare row number is taken within tasks before anything is shuffled
    first = hashed.withColumn("nth", F.row_number().over(Window.partitionBy("template").orderBy("h", "site"))).where(F.col("nth") <= n_features)
    chosen = first.withColumn("feature", F.col("nth") - 1).drop("nth")
    room = sites.groupBy("site").agg(F.min(F.least(F.col("mean"), 1 - F.col("mean")) - F.col("sd") * F.col("sd") / F.greatest("mean", 1 - F.col("mean"))).alias("room"))
    picked = chosen.join(room, "site")

    def effects(part: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng([seed, int(part["template"].iloc[0])])
        part = part.sort_values("feature")
        size = np.sort(np.abs(effect) + effect_sd * normal_quantile(rng.uniform(normal_cdf(-abs(effect) / effect_sd), 1, n_signal)) if effect_sd > 0 else np.full(n_signal, abs(effect)))[::-1]
        out = np.zeros(len(part))
        k = min(n_signal, len(part))
        room = np.maximum(part["room"].to_numpy()[:k], 0)
        by = np.argsort(-room, kind="stable")
        signs = {"positive": np.ones(k), "negative": -np.ones(k), "balanced": rng.permutation(np.resize([1.0, -1.0], k)) if direction == "balanced" else None}.get(direction)
        out[by] = np.minimum(size[:k], 0.9 * room[by]) * (rng.choice([-1.0, 1.0], k) if signs is None else signs)
        return pd.DataFrame({"template": part["template"], "feature": part["feature"], "site": part["site"], "effect": out, "is_signal": np.arange(len(part)) < k})

    drawn = picked.groupBy("template").applyInPandas(effects, "template int, feature int, site string, effect double, is_signal boolean")
    return drawn.join(sites.select("site", "depth", "mean", "sd"), "site")


def null_templates(templates: DataFrame) -> DataFrame:
    """The same templates without any effect."""
    return templates.withColumn("effect", F.lit(0.0)).withColumn("is_signal", F.lit(False))


def simulate(template: pd.DataFrame, n_control: int, n_case: int, depth_missing: dict[int, float], rho: float, block: int, seed: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Values (samples by features) and labels of one cohort at every depth, from the same uniforms.

    Features are correlated in blocks by a Gaussian copula with correlation ``rho``; a value is missing at a depth where its
    own missing uniform is below that depth's rate.
    """
    rng = np.random.default_rng(seed)
    labels = np.repeat([0, 1], [n_control, n_case])
    n, features = len(labels), template["feature"].nunique()
    shared = rng.normal(size=(n, -(-features // block)))[:, np.arange(features) // block]
    uniform = np.clip(normal_cdf(math.sqrt(rho) * shared + math.sqrt(1 - rho) * rng.normal(size=(n, features))), 1e-12, 1 - 1e-12)
    gone = rng.uniform(size=(n, features))
    out = {}
    for depth, rows in template.groupby("depth"):
        rows = rows.sort_values("feature")
        mean = rows["mean"].to_numpy()[None, :] + labels[:, None] * rows["effect"].to_numpy()[None, :]
        total = mean * (1 - mean) / rows["sd"].to_numpy()[None, :] ** 2 - 1
        total = np.maximum(total, 1e-3)
        values = beta_inc_inv(mean * total, (1 - mean) * total, uniform)
        out[int(depth)] = (np.where(gone < depth_missing.get(int(depth), 0.0), np.nan, values), labels)
    return out


def _auc(scores: np.ndarray, labels: np.ndarray) -> float:
    order = pd.Series(scores).rank().to_numpy()
    pos, neg = labels.sum(), (1 - labels).sum()
    return float((order[labels == 1].sum() - pos * (pos + 1) / 2) / (pos * neg))


def _f_scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    a, b = x[y == 0], x[y == 1]
    grand = x.mean(axis=0)
    between = len(a) * (a.mean(axis=0) - grand) ** 2 + len(b) * (b.mean(axis=0) - grand) ** 2
    within = ((a - a.mean(axis=0)) ** 2).sum(axis=0) + ((b - b.mean(axis=0)) ** 2).sum(axis=0)
    return np.where(within > 1e-12, between / (np.maximum(within, 1e-12) / (len(x) - 2)), -np.inf)


def _logistic(x: np.ndarray, y: np.ndarray, c: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights, bias last, of a ridge logistic regression by Newton's steps."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x1.shape[1]), np.append(np.full(x.shape[1], 1 / c), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve(x1.T @ (x1 * (p * (1 - p))[:, None]) + np.diag(ridge), x1.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def cross_validated(x: np.ndarray, y: np.ndarray, folds: int, k: int, min_observed: float, rng: np.random.Generator) -> tuple[float, list[set[int]]]:
    """AUC of out-of-fold scores, and the features picked in each fold.

    Within a fold, features must be observed in the share ``min_observed`` of both classes and vary; missing values take the
    training median, the ``k`` best by F are scaled and a ridge logistic regression is fitted. Nothing of the held-out fold is used.
    """
    fold = np.empty(len(y), int)
    for c in (0, 1):
        at = rng.permutation(np.flatnonzero(y == c))
        fold[at] = np.arange(len(at)) % folds
    out, picked = np.full(len(y), 0.5), []
    for f in range(folds):
        train, test = fold != f, fold == f
        xt, yt = x[train], y[train]
        seen = np.minimum(np.mean(~np.isnan(xt[yt == 0]), axis=0), np.mean(~np.isnan(xt[yt == 1]), axis=0)) >= min_observed
        if not seen.any() or len(set(yt)) < 2:
            picked.append(set())
            continue
        cols = np.flatnonzero(seen)
        fill = np.nanmedian(xt[:, cols], axis=0)
        a, b = np.where(np.isnan(xt[:, cols]), fill, xt[:, cols]), np.where(np.isnan(x[test][:, cols]), fill, x[test][:, cols])
        vary = a.var(axis=0) > 0
        a, b, cols = a[:, vary], b[:, vary], cols[vary]
        best = np.argsort(-_f_scores(a, yt), kind="stable")[:k]
        mu, sd = a[:, best].mean(axis=0), a[:, best].std(axis=0)
        sd = np.where(sd > 0, sd, 1)
        w = _logistic((a[:, best] - mu) / sd, yt)
        out[test] = 1 / (1 + np.exp(-np.clip(((b[:, best] - mu) / sd) @ w[:-1] + w[-1], -30, 30)))
        picked.append({int(c) for c in cols[best]})
    return _auc(out, y), picked


def replicate_plan(spark: SparkSession, n_templates: int, sizes: Sequence[int], sims: int, first: int = 0) -> DataFrame:
    """One row for each template, cohort size and simulation."""
    t = spark.range(n_templates).select(F.col("id").cast("int").alias("template"))
    n = spark.createDataFrame([(int(s),) for s in sizes], "n int")
    s = spark.range(first, first + sims).select(F.col("id").cast("int").alias("sim"))
    return t.crossJoin(n).crossJoin(s)


REPLICATE = "template int, n int, sim int, depth int, auc double, recall double, jaccard double"


def run_replicates(plan: DataFrame, templates: DataFrame, missing: dict[int, float], seed: int, folds: int = 5, k: int = 20, min_observed: float = 0.5, rho: float = 0.2, block: int = 10, null: bool = False) -> DataFrame:
    """Simulate and evaluate every replicate: out-of-fold AUC, recall of signal features, and stability of the picks.

    Replicates of a template meet its rows (some thousand at most) in one task; All depths
    share a replicate's random numbers. Recall is null without signal features.
    """
    packed = templates.groupBy("template").agg(F.collect_list(F.struct("feature", "depth", "mean", "sd", "effect", "is_signal")).alias("rows"))
    work = plan.repartition(F.col("template"), F.col("n"), F.col("sim")).join(packed, "template")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t, n, sim, rows in zip(batch["template"], batch["n"], batch["sim"], batch["rows"], strict=True):
                rows = pd.DataFrame([dict(r) if isinstance(r, dict) else r.asDict() for r in rows])
                signal = set(rows.loc[rows["is_signal"], "feature"].unique())
                key = [seed, int(n), int(t), int(sim), int(null)]
                for depth, (x, y) in simulate(rows, n - n // 2, n // 2, missing, rho, block, key).items():
                    auc, picked = cross_validated(x, y, folds, k, min_observed, np.random.default_rng(key))
                    recall = float(np.mean([len(p & signal) / len(signal) for p in picked])) if signal else None
                    pairs = [len(a & b) / len(a | b) if a | b else 1.0 for i, a in enumerate(picked) for b in picked[i + 1 :]]
                    out.append((t, n, sim, depth, auc, recall, float(np.mean(pairs)) if pairs else None))
            yield pd.DataFrame(out, columns=["template", "n", "sim", "depth", "auc", "recall", "jaccard"])

    return work.mapInPandas(run, REPLICATE)


def calibrate(signal: DataFrame, null: DataFrame, alpha: float = 0.05, metrics: Sequence[str] = ("auc",)) -> DataFrame:
    """``detected`` for each signal replicate: every metric's add-one p among the null replicates of its key is at most alpha.

    Too few null replicates to reach alpha are an error.
    """
    from cohortry.operators.stats import empirical_p

    keys = ["template", "n", "depth"]
    fewest = null.groupBy(*keys).count().agg(F.min("count")).first()[0] or 0
    need = math.ceil(1 / alpha) - 1
    if fewest < need:
        raise ValueError(f"null simulations must be at least {need}")
    out = signal
    for m in metrics:
        out = empirical_p(out, null, keys, m).withColumnRenamed("p", f"p_{m}")
    joint = F.lit(True)
    for m in metrics:
        joint = joint & (F.col(f"p_{m}") <= alpha)
    return out.withColumn("detected", joint)


def template_summary(detected: DataFrame, keys: Sequence[str] = ("n", "depth")) -> DataFrame:
    """Per template: replicates, hits, power with Wilson's bounds, mean and deviation of the AUC."""
    per = detected.groupBy("template", *keys).agg(F.count(F.lit(1)).alias("n_sims"), F.count(F.when(F.col("detected"), 1)).alias("hits"), F.avg("auc").alias("mean_auc"), F.stddev_samp("auc").alias("sd_auc"), F.median("auc").alias("median_auc"))
    low, high = wilson(F.col("hits"), F.col("n_sims"))
    return per.withColumn("power", F.col("hits") / F.col("n_sims")).withColumn("power_low", low).withColumn("power_high", high)


def power_curve(per_template: DataFrame, keys: Sequence[str] = ("n", "depth")) -> DataFrame:
    """Power as the mean of the templates' powers, each counted once, and how far templates differ."""
    return per_template.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_templates"), F.avg("power").alias("power"), F.stddev_samp("power").alias("between_sd"), F.percentile("power", 0.025).alias("q025"), F.percentile("power", 0.975).alias("q975"))


def bootstrap_bounds(detected: DataFrame, keys: Sequence[str] = ("n", "depth"), reps: int = 1000, seed: int = 1) -> DataFrame:
    """Bounds of the power by resampling templates, then simulations within them; null for fewer than two templates."""
    if reps < 100:
        raise ValueError("at least 100 bootstrap repetitions are needed")
    hits = detected.groupBy(*keys, "template").agg(F.count(F.when(F.col("detected"), 1)).alias("hits"), F.count(F.lit(1)).alias("sims"))
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in hits.select(*keys).schema.fields)

    def resample(part: pd.DataFrame) -> pd.DataFrame:
        own = [part[k].iloc[0] for k in keys]
        if len(part) < 2:
            return pd.DataFrame([[*own, None, None]], columns=[*keys, "low", "high"])
        part = part.sort_values("template")
        rng = np.random.default_rng(seed)
        at = rng.integers(0, len(part), (reps, len(part)))
        p, n = (part["hits"] / part["sims"]).to_numpy(), part["sims"].to_numpy()
        drawn = rng.binomial(n[at], p[at]) / n[at]  # resampling a template's simulations is a binomial draw of its hits
        low, high = np.quantile(drawn.mean(axis=1), [0.025, 0.975])
        return pd.DataFrame([[*own, low, high]], columns=[*keys, "low", "high"])

    return hits.groupBy(*keys).applyInPandas(resample, f"{types}, low double, high double")


def paired_models(replicates: DataFrame, models: Sequence[str], keys: Sequence[str] = ("n", "depth"), value: str = "auc") -> DataFrame:
    """Difference of two models over the same replicates: mean, quantiles, and how often it is above 0, 0.03 and 0.05."""
    a, b = models
    of = lambda model: F.first(F.when(F.col("model") == model, F.col(value)), ignorenulls=True)
    wide = replicates.groupBy("template", "sim", *keys).agg((of(b) - of(a)).alias("d"))
    over = lambda t: F.avg(F.when(F.col("d").isNotNull(), (F.col("d") > t if t == 0 else F.col("d") >= t).cast("double")))
    return wide.groupBy(*keys).agg(F.count("d").alias("n_pairs"), F.avg("d").alias("mean_diff"), F.percentile("d", 0.025).alias("q025"), F.percentile("d", 0.975).alias("q975"), over(0).alias("p_above_0"), over(0.03).alias("p_above_3"), over(0.05).alias("p_above_5"))


def adaptive(run_batch, keys: Sequence[str], width: float, least: int, most: int, batch: int) -> DataFrame:
    """Batches of simulations until every key has ``least`` and its Wilson interval is no wider than ``width``, or ``most`` are done.

    ``run_batch(first, count)`` returns a frame with the keys and ``detected``; only one row for each key comes to the driver.
    """
    done, got = 0, None
    while done < most:
        more = run_batch(done, min(batch, most - done))
        got, done = (more if got is None else got.unionByName(more)), done + min(batch, most - done)
        got = got.persist()
        per = got.groupBy(*keys).agg(F.count(F.lit(1)).alias("sims"), F.count(F.when(F.col("detected"), 1)).alias("hits"))
        low, high = wilson(F.col("hits"), F.col("sims"))
        if per.agg(F.bool_and((F.col("sims") >= least) & (high - low <= width))).first()[0]:
            break
    return got


@F.pandas_udf(DoubleType())
def _site_power(diff: pd.Series, sd: pd.Series, n: pd.Series, alpha: pd.Series) -> pd.Series:
    # sites of the same numbers have the same power: each is worked out once in a batch
    asked, of = np.unique(np.column_stack([x.to_numpy(float) for x in (diff, sd, n, alpha)]), axis=0, return_inverse=True)
    return pd.Series(_powers(*asked.T)[of.reshape(-1)]).where(sd.notna() & diff.notna())


def _critical(size: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Critical values of Student's t for few samples in each group, by bisection."""
    df = np.maximum(2 * size - 2, 1)
    low, high = np.zeros(len(size)), np.full(len(size), 1e9)
    for _ in range(90):
        mid = (low + high) / 2
        above = 1 - t_cdf(mid, df) > a / 2
        low, high = np.where(above, mid, low), np.where(above, high, mid)
    return low


def _powers(d: np.ndarray, s: np.ndarray, m: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Power at sites of some differences, deviations, group sizes and levels; cuts are found once for each size and level."""
    with np.errstate(divide="ignore", invalid="ignore"):
        shift = np.abs(d) / (s * np.sqrt(2 / m))
    levels, of = np.unique(a, return_inverse=True)
    cut = -normal_quantile(levels / 2)[of]
    found = normal_tail(cut - shift) + normal_tail(cut + shift)
    small = np.flatnonzero(m <= 3)
    if len(small):
        cases, of = np.unique(np.column_stack([m[small], a[small]]), axis=0, return_inverse=True)
        low, df = _critical(*cases.T)[of.reshape(-1)], np.maximum(2 * m[small] - 2, 1)
        found[small] = 1 - t_cdf(low - shift[small], df) + t_cdf(-low - shift[small], df)
    return np.where((s > 0) & ~np.isnan(d), found, np.nan)


def site_power(diff: Column, sd: Column, n: Column, tests: int = TESTS, alpha: float = 0.05) -> Column:
    """Power to see a difference at one site with ``n`` samples in each group, at alpha over the number of tests."""
    return _site_power(diff.cast("double"), sd.cast("double"), n.cast("double"), F.lit(alpha / tests))


def powered_fraction(sites: DataFrame, threshold: float = 0.8, by: Sequence[str] = ("n",)) -> DataFrame:
    """Share of sites (column power) that reach the threshold; sites without a power do not count."""
    return sites.groupBy(*by).agg(F.avg(F.when(F.col("power").isNotNull(), (F.col("power") >= threshold).cast("double"))).alias("fraction"))


def parse_sizes(text: str, limit: int = 2000) -> list[int]:
    """Cohort sizes of a text such as ``20, 40-80:20``: distinct, ascending, even, from 4 to the limit; anything else is an error."""
    found: set[int] = set()
    for part in filter(None, (p.strip() for p in text.split(","))):
        span, _, step = part.partition(":")
        low, dash, high = span.partition("-")
        if not all(x.isdigit() for x in (low, *([high] if dash else []), *([step] if step else []))):
            raise ValueError(f"not a size or range: {part}")
        found |= set(range(int(low), int(high) + 1, int(step or 1))) if dash else {int(low)}
    wrong = [n for n in sorted(found) if n < 4 or n > limit or n % 2]
    if wrong or not found:
        raise ValueError(f"sizes must be even numbers from 4 to {limit}: {wrong}")
    return sorted(found)


def work_units(templates: int, sizes: Sequence[int], sims: int, depths: int, limit: int = 500_000) -> int:
    """Simulations times samples of a grid; above the limit it is an error."""
    units = templates * sims * depths * sum(sizes)
    if units > limit:
        raise ValueError(f"{units} work units; at most {limit} are allowed")
    return units
