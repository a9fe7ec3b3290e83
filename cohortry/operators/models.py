"""Principal components, classifiers, cross-validation and stacking on samples-by-features data.

Samples are few and features many, so components come from the samples' Gram matrix, which one aggregate over features
yields; only its n by n cells reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortry.operators.matrix import usable_features
from cohortry.operators.power import _auc, _f_scores, _logistic
from cohortry.operators.stats import pair_sums, with_names
from cohortry.session import materialise


def gram(long: DataFrame, samples: Sequence[str], scale: bool = True) -> DataFrame:
    """``a``, ``b``, ``g``: sums over features of products of centred (and scaled) values, missing ones filled with the mean."""
    of = Window.partitionBy("feature")
    mean, spread = F.avg("value").over(of), F.stddev_pop("filled").over(of)
    filled = long.withColumn("filled", F.coalesce("value", mean)).withColumn("c", F.col("filled") - F.avg("filled").over(of))
    if scale:
        filled = filled.withColumn("c", F.when(spread > 0, F.col("c") / spread).otherwise(0.0))
    wide = filled.groupBy("feature").pivot("sample", list(samples)).agg(F.first("c"))
    return with_names(pair_sums(wide, samples), samples).select("a", "b", F.col("sij").alias("g"))


def principal_components(long: DataFrame, samples: Sequence[str], k: int = 10, max_missing: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Coordinates (sample, pc, value) and explained variance in percent (pc, pct) of the usable features.

    As many components as samples and features allow, ``k`` at most; the largest coordinate of each is positive.
    """
    spark = long.sparkSession
    usable = usable_features(long, len(samples), max_missing).select("feature")
    cells = gram(long.join(usable, "feature"), samples).collect()
    at = {s: i for i, s in enumerate(samples)}
    g = np.zeros((len(samples), len(samples)))
    for a, b, v in cells:
        g[at[a], at[b]] = g[at[b], at[a]] = v or 0.0
    values, vectors = np.linalg.eigh(g)
    order = np.argsort(-values)[: min(k, len(samples))]
    values, vectors = np.maximum(values[order], 0), vectors[:, order]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    coords = [(s, f"PC{j + 1}", float(vectors[i, j] * np.sqrt(values[j]))) for i, s in enumerate(samples) for j in range(len(order))]
    whole = max(np.trace(g), 1e-300)
    return spark.createDataFrame(coords, "sample string, pc string, value double"), spark.createDataFrame([(f"PC{j + 1}", float(100 * v / whole)) for j, v in enumerate(values)], "pc string, pct double")


class Logistic:
    """Ridge logistic regression on scaled features."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        self.mu, sd = x.mean(axis=0), x.std(axis=0)
        self.sd = np.where(sd > 0, sd, 1)
        self.w = _logistic((x - self.mu) / self.sd, y)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(((x - self.mu) / self.sd) @ self.w[:-1] + self.w[-1], -30, 30)))


class Forest:
    """Bagged trees of Gini splits on random subsets of features."""

    def __init__(self, trees: int = 50, depth: int = 5, seed: int = 0):
        self.trees, self.depth, self.seed = trees, depth, seed

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.Generator):
        if depth == 0 or len(y) < 4 or y.min() == y.max():
            return float(y.mean())
        best = None
        for f in rng.choice(x.shape[1], max(1, int(np.sqrt(x.shape[1]))), replace=False):
            order = np.argsort(x[:, f], kind="stable")
            v, ones = x[order, f], np.cumsum(y[order])
            left = np.arange(1, len(y))
            p, q = ones[:-1] / left, (ones[-1] - ones[:-1]) / (len(y) - left)
            gini = left * p * (1 - p) + (len(y) - left) * q * (1 - q)
            gini[v[1:] == v[:-1]] = np.inf
            i = int(gini.argmin())
            if np.isfinite(gini[i]) and (best is None or gini[i] < best[0]):
                best = (gini[i], f, (v[i] + v[i + 1]) / 2)
        if best is None:
            return float(y.mean())
        side = x[:, best[1]] <= best[2]
        return best[1], best[2], self._grow(x[side], y[side], depth - 1, rng), self._grow(x[~side], y[~side], depth - 1, rng)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        rng = np.random.default_rng(self.seed)
        self.grown = []
        for _ in range(self.trees):
            at = rng.integers(0, len(y), len(y))
            self.grown.append(self._grow(x[at], y[at].astype(float), self.depth, rng))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        def walk(node, row):
            while isinstance(node, tuple):
                node = node[2] if row[node[0]] <= node[1] else node[3]
            return node

        return np.array([np.mean([walk(t, row) for t in self.grown]) for row in x])


class Margin:
    """Linear support vector machine by subgradient steps, with scores squeezed into 0..1."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Margin:
        self.mu, sd = x.mean(axis=0), x.std(axis=0)
        self.sd = np.where(sd > 0, sd, 1)
        z, s = np.column_stack([(x - self.mu) / self.sd, np.ones(len(x))]), 2.0 * y - 1
        w = np.zeros(z.shape[1])
        for t in range(1, 400):
            inside = s * (z @ w) < 1
            w -= (0.01 * w - (s[inside, None] * z[inside]).sum(axis=0) / len(z)) / (0.01 * (t + 10))
        self.w = w
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.column_stack([(x - self.mu) / self.sd, np.ones(len(x))])
        return 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))


#: Classifiers by number: forest, logistic, margin.
CLASSIFIERS: dict[int, Callable[[], object]] = {1: Forest, 2: Logistic, 3: Margin}


def _filled(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """``x`` with each column's missing values replaced by the median of the ``known`` rows, 0 where they have none."""
    fill = np.nan_to_num(np.nanmedian(np.where(np.isnan(known).all(axis=0), 0.0, known), axis=0))
    return np.where(np.isnan(x), fill, x)


def _held_out(x: np.ndarray, y: np.ndarray, train: np.ndarray, test: np.ndarray, classifier: int) -> np.ndarray:
    """Scores of the held-out rows: medians and the classifier come from the training rows."""
    return CLASSIFIERS[classifier]().fit(_filled(x[train], x[train]), y[train]).predict(_filled(x[test], x[train]))


def screened(long: DataFrame, samples: Sequence[str], y: np.ndarray, trains: np.ndarray, k: int) -> DataFrame:
    """For each modality and run (a row of ``trains``, which says who trains) the ``k`` features of highest F over the training samples.

    Columns: ``modality``, ``run``, ``nth`` (from 1, ties by name), ``feature``, ``values`` (of all samples in order, missing ones null). A
    feature's values are brought together once. A task keeps a running best of each run over all its features and sends names and
    F of those at its end, tasks x runs x ``k`` rows at most; values join the winners alone.
    """
    means = long.groupBy("modality", "feature", "sample").agg(F.avg("value").alias("value"))
    held = means.groupBy("modality", "feature").agg(F.map_from_entries(F.collect_list(F.struct("sample", "value"))).alias("by"))
    wide = materialise(held.select("modality", "feature", F.transform(F.array(*(F.lit(s) for s in samples)), lambda s: F.try_element_at(F.col("by"), s)).alias("values")), "feature-values")
    shared = long.sparkSession.sparkContext.broadcast((y, trains))
    kinds = {f.name: f.dataType.simpleString() for f in wide.schema.fields}

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        y, trains = shared.value
        best: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
        for rows in batches:
            for modality, part in rows.groupby("modality", sort=False):
                names, x = part["feature"].to_numpy(), np.stack(part["values"].to_numpy()).astype(float).T
                for run, train in enumerate(trains):
                    f, found = _f_scores(_filled(x[train], x[train]), y[train]), names
                    if (modality, run) in best:
                        f, found = np.concatenate([best[modality, run][0], f]), np.concatenate([best[modality, run][1], found])
                    top = np.lexsort((found, -f))[:k]
                    best[modality, run] = f[top], found[top]
        for (modality, run), (f, found) in best.items():
            yield pd.DataFrame({"modality": modality, "run": np.int32(run), "f": f, "feature": found})

    found = wide.mapInPandas(pick, f"modality {kinds['modality']}, run int, f double, feature {kinds['feature']}")
    order = Window.partitionBy("modality", "run").orderBy(F.desc("f"), "feature")
    winners = found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)
    return winners.join(wide, ["modality", "feature"]).select("modality", "run", "nth", "feature", "values")


def _matrix(rows: pd.DataFrame) -> np.ndarray:
    """Samples by features of the picked features, best first."""
    return np.stack(rows.sort_values("nth")["values"].to_numpy()).astype(float).T


def modality_performance(long: DataFrame, labels: dict[str, int], classifiers: Sequence[int] = (1, 2, 3), folds: int = 5, repeats: int = 5, k: int = 100, seed: int = 0) -> DataFrame:
    """Mean and deviation of the AUC of each modality and classifier over repeated stratified folds, best first.

    ``long`` has modality, feature, sample, value. Features are picked for each fold by :func:`screened`; a task gets the
    picks of one modality's folds in one repeat, for one classifier.
    """
    spark = long.sparkSession
    kinds = F.broadcast(spark.createDataFrame([(c,) for c in classifiers], "classifier int"))
    samples = sorted(labels)
    y = np.array([labels[s] for s in samples])
    fold = np.empty((repeats, len(y)), int)
    for r in range(repeats):
        rng = np.random.default_rng([seed, r])
        for label in (0, 1):
            at = rng.permutation(np.flatnonzero(y == label))
            fold[r, at] = np.arange(len(at)) % folds
    trains = np.array([fold[r] != f for r in range(repeats) for f in range(folds)])

    def evaluate(rows: pd.DataFrame) -> pd.DataFrame:
        m, c, r = rows["modality"].iloc[0], int(rows["classifier"].iloc[0]), int(rows["repeat"].iloc[0])
        out = np.zeros(len(y))
        for f in range(folds):
            out[fold[r] == f] = _held_out(_matrix(rows[rows["run"] == r * folds + f]), y, fold[r] != f, fold[r] == f, c)
        return pd.DataFrame({"modality": [m], "classifier": [c], "repeat": [r], "auc": [_auc(out, y)]})

    picked = screened(long, samples, y, trains, k).withColumn("repeat", F.floor(F.col("run") / folds).cast("int"))
    scored = picked.crossJoin(kinds).groupBy("modality", "classifier", "repeat").applyInPandas(evaluate, "modality string, classifier int, repeat int, auc double")
    return scored.groupBy("modality", "classifier").agg(F.avg("auc").alias("mean_auc"), F.stddev_pop("auc").alias("sd_auc")).orderBy(F.desc("mean_auc"), "modality", "classifier")


def leave_one_out(long: DataFrame, labels: dict[str, int], classifier: dict[str, int], k: int = 100) -> DataFrame:
    """``sample``, ``y_true``, ``modality``, ``score`` of every sample held out once, and of the stack of all modalities.

    The modalities' scores of the other samples come from an inner leave-one-out, a logistic regression over them is the
    stack, named Multimodal. Features are picked by :func:`screened` for every one and every two samples left out; a task gets
    one modality's picks for one of these, and another the scores of one held-out sample.
    """
    spark = long.sparkSession
    samples = sorted(labels)
    n = len(samples)
    y = np.array([labels[s] for s in samples])
    out = [(i, i) for i in range(n)] + [(i, j) for i in range(n) for j in range(i + 1, n)]
    trains = np.ones((len(out), n), bool)
    for run, (i, j) in enumerate(out):
        trains[run, [i, j]] = False
    roles = [(run, i, j) for run, (i, j) in enumerate(out)] + [(run, j, i) for run, (i, j) in enumerate(out) if i != j]
    runs = F.broadcast(spark.createDataFrame(roles, "run int, held int, tested int"))  # as many rows as pairs of samples

    def score_one(rows: pd.DataFrame) -> pd.DataFrame:
        m, held, tested = rows["modality"].iloc[0], int(rows["held"].iloc[0]), int(rows["tested"].iloc[0])
        at = np.arange(n)
        score = _held_out(_matrix(rows), y, (at != held) & (at != tested), at == tested, classifier[m])[0]
        return pd.DataFrame({"modality": [m], "held": [held], "tested": [tested], "score": [float(score)]})

    def stack(rows: pd.DataFrame) -> pd.DataFrame:
        held = int(rows["held"].iloc[0])
        table = rows.pivot(index="tested", columns="modality", values="score").sort_index()
        names, rest = sorted(table.columns), table.index != held
        outer = table.loc[held, names].to_numpy(float)
        both = Logistic().fit(table.loc[rest, names].to_numpy(float), y[table.index[rest]]).predict(outer[None, :])[0]
        return pd.DataFrame({"sample": samples[held], "y_true": labels[samples[held]], "modality": [*names, "Multimodal"], "score": [*outer, float(both)]})

    picked = screened(long, samples, y, trains, k).join(runs, "run")
    scored = picked.groupBy("modality", "held", "tested").applyInPandas(score_one, "modality string, held int, tested int, score double")
    return scored.groupBy("held").applyInPandas(stack, "sample string, y_true int, modality string, score double")


def resolve_classifiers(modalities: DataFrame, classifiers: Sequence[int], performance: DataFrame | None = None) -> DataFrame:
    """``modality``, ``ord``, ``classifier``: which of ``classifiers`` judges each of ``modalities`` (modality, ord from 0).

    With a table of performance (modality, best: text whose last number is a place in ``classifiers``) the best one, the first of
    ``classifiers`` for a modality it does not have, a text without number, a place beyond the end or an unknown classifier.
    Without, each modality's own if there are as many as modalities, else the first for all.
    """
    if not classifiers or classifiers[0] not in CLASSIFIERS:
        raise ValueError(f"the first classifier must be one of {', '.join(map(str, CLASSIFIERS))}")
    choices, default = F.array(*(F.lit(c if c in CLASSIFIERS else classifiers[0]) for c in classifiers)), F.lit(classifiers[0])
    at = lambda place: F.coalesce(F.get(choices, place), default)
    if performance is None:
        as_many = F.count(F.lit(1)).over(Window.partitionBy()) == len(classifiers)
        return modalities.select("modality", "ord", F.when(as_many, at(F.col("ord"))).otherwise(default).alias("classifier"))
    number = F.regexp_extract("best", r"([0-9]+)[^0-9]*$", 1).try_cast("int")
    best = performance.where(F.col("modality").isNotNull()).groupBy("modality").agg(F.min("best").alias("best"))
    kept = modalities.join(best, "modality", "left")
    place = F.when(F.col("best").isNull(), None).otherwise(F.coalesce(number, F.when(F.col("best").rlike("[0-9]"), F.lit(len(classifiers))).otherwise(0)))
    return kept.select("modality", "ord", at(place).alias("classifier"))


def train_logistic(features: DataFrame, columns: Sequence[str], label: str, path: str | None = None):
    """A fitted pipeline (assembly, scaling, logistic regression) over a wide table of any length, saved if a path is given."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler

    filled = [f"{c}__filled" for c in columns]
    steps = [Imputer(inputCols=list(columns), outputCols=filled, strategy="median"), VectorAssembler(inputCols=filled, outputCol="raw"), StandardScaler(inputCol="raw", outputCol="features", withMean=True), LogisticRegression(labelCol=label, maxIter=50, regParam=0.01)]
    model = Pipeline(stages=steps).fit(features)
    if path:
        model.write().overwrite().save(path)
    return model
