"""Centroid clustering: plain Lloyd rounds over whole-number vectors.

Vectors are scaled and floored once and written down as small integers. In each round tasks get the centroids, take the
squared differences to each in numpy, and send one row of sums for each centroid; those merge in a ``groupBy``. Sums,
distances and floors are exact, so results do not depend on how rows are dealt out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import materialise

#: Largest magnitude of a scaled component: squared distances of 64 such components still fit a long.
LARGEST = 2**27


def quantise(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``vec_id`` and ``q`` (array of ``dims`` integers, floor of scale times the component taken as a double).

    Vectors of another length, null, or with a null, NaN or infinite component are left out. A finite component beyond
    2^27 after scaling is an error, as its squared distance might not fit a long. Further columns are left behind.
    """
    usable = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    whole = lambda x: F.when(F.abs(x * scale) > LARGEST, F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling")).cast("int")).otherwise(F.floor(x * scale).cast("int"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("q"))
    kept = rows.where(F.coalesce((F.size("q") == dims) & F.forall("q", usable), F.lit(False)))
    return kept.withColumn("q", F.transform("q", whole))


def first_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``1:<vec_id>``, in that order, equal ones by their components."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = vectors.orderBy(digest, "q").limit(k).collect()  # k rows
    return np.array([r["q"] for r in chosen], np.int64)


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row (the smaller number of equally near ones) and its squared distance."""
    far = np.empty((len(rows), len(centroids)), np.int64)
    for c, centre in enumerate(centroids):
        difference = rows - centre
        far[:, c] = np.einsum("ij,ij->i", difference, difference)
    best = far.argmin(axis=1)
    return best, far[np.arange(len(rows)), best]


def _matrix(column: pd.Series, dims: int) -> np.ndarray:
    return np.concatenate(column.to_numpy()).astype(np.int64).reshape(-1, dims)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: each centroid as the exact floor of its vectors' mean, or as it was if it has none."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if len(batch):
                rows = _matrix(batch["q"], dims)
                best, _ = nearest(rows, centroids)
                for c in np.unique(best):
                    total[c] += rows[best == c].sum(axis=0)
                count += np.bincount(best, minlength=k)
        used = np.flatnonzero(count)
        if len(used):
            yield pd.DataFrame({"cluster": used.astype(np.int32), "n": count[used], "total": list(total[used])})

    partial = vectors.select("q").mapInPandas(sums, "cluster int, n long, total array<long>")
    wide = lambda c: F.sum(c.cast("decimal(20,0)"))
    merged = partial.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*(wide(F.col("total")[i]) for i in range(dims))).alias("total")).collect()  # k rows at most
    after = centroids.copy()
    for row in merged:
        after[row["cluster"]] = [int(t) // row["n"] for t in row["total"]]
    return after


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and ``distance`` (squared) of every vector."""
    dims = centroids.shape[1]

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                best, far = nearest(_matrix(batch["q"], dims), centroids)
                yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "cluster": best.astype(np.int32), "distance": far})

    return vectors.mapInPandas(label, "vec_id long, cluster int, distance long")


def digest(centre: np.ndarray) -> str:
    """Lowercase hex SHA-256 of the components as decimal integers joined by commas."""
    return hashlib.sha256(",".join(map(str, centre.tolist())).encode()).hexdigest()


def lloyd(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256`` for every usable vector.

    Centroids start as :func:`first_centroids`; ``rounds`` times all vectors go to the nearest and the centroids move;
    then vectors are assigned once more. Fewer vectors than ``k`` make as many centroids. Null ids stay null, repeated
    rows are rows of their own, an empty table or one without usable vectors gives no rows; see :func:`quantise` for
    what is left out. An inertia beyond a long is an error. Besides its vectors a task holds k x dims integers.
    """
    rows = materialise(quantise(vectors, id_col, vector_col, dims, scale), "whole-vectors")
    centroids = first_centroids(rows, k).reshape(-1, dims)
    if not len(centroids):
        return rows.select("vec_id", *(F.lit(None).cast(kind).alias(name) for name, kind in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))))
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    done = materialise(assigned(rows, centroids), "assigned-vectors")
    inertia = {r["cluster"]: r["inertia"] for r in done.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # k rows at most
    by_cluster = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    return done.withColumns({
        "cluster_inertia": by_cluster([inertia.get(c, 0) for c in range(len(centroids))]).cast("long"),
        "inertia": F.lit(sum(inertia.values())).cast("long"),
        "centroid_sha256": by_cluster([digest(c) for c in centroids]),
    })
