import hashlib
import math
import random

import duckdb
import pytest

from cohortry.llm import centroids
from cohortry.llm.queries import ORACLE_SQL, op12_centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, q int"


def plain(rows, k, rounds, dims):
    """Lloyd in whole numbers, vector by vector."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v, *_ in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (sha(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min(range(len(centres)), key=lambda c: (far(v, centres[c]), c))
    for _ in range(rounds):
        groups = [[v for _, v in kept if near(v) == c] for c in range(len(centres))]
        centres = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else centres[c] for c, g in enumerate(groups)]
    out = [(i, near(v), far(v, centres[near(v)])) for i, v in kept]
    inertia = lambda c: sum(d for _, at, d in out if at == c)
    text = lambda c: hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()
    return sorted((str(i), c, d, inertia(c), sum(x[2] for x in out), text(c)) for i, c, d in out)


def listed(df):
    return sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in df.collect())


def awkward(dims):
    rng = random.Random(3)
    nan, inf = float("nan"), float("inf")
    vector = lambda: [rng.choice([-0.5, 0.25, 0.75, 1.0, -2.0]) for _ in range(dims)]
    rows = [(i, vector(), "x", 1) for i in range(60)]
    rows += [(60 + i, rows[0][1], None, None) for i in range(40)] + [(3, rows[0][1], "x", 1), (None, vector(), "x", 1)]
    rows += [(200, None, "x", 1), (201, [], "x", 1), (202, vector()[1:], "x", 1), (203, [nan, *vector()[1:]], "x", 1), (204, [*vector()[1:], inf], "x", 1), (205, [*vector()[1:], -inf], "x", 1), (206, [*vector()[1:], None], "x", 1)]
    return rows + [(300, [1000.0] * dims, "x", 1)]


def test_matches_plain_lloyd_on_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(4), SCHEMA)
    for k in (1, 5, 200):  # more than there are vectors, too
        assert listed(centroids.lloyd(docs.repartition(7), k=k, dims=4)) == plain(awkward(4), k, 3, 4)


def test_query_matches_sql_on_awkward_rows(spark, tmp_path):
    spark.createDataFrame(awkward(64), SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = [("None" if i != i or i is None else str(int(i)), *rest) for i, *rest in con.execute(f"SELECT vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 FROM ({ORACLE_SQL['op12_centroids']})").fetchall()]
    assert listed(op12_centroids(spark, str(tmp_path))) == sorted(map(tuple, want)) == plain(awkward(64), 16, 3, 64)


def test_empty_and_unusable_tables(spark):
    for rows in ([], [(1, None, "x", 1), (2, [1.0], "x", 1)]):
        out = centroids.lloyd(spark.createDataFrame(rows, SCHEMA))
        assert out.collect() == [] and dict(out.dtypes) == {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"}


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    same = [(i, [1.0, 2.0], "x", 1) for i in range(9)]
    out = centroids.lloyd(spark.createDataFrame(same, SCHEMA), k=4, dims=2)
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in out.collect()} == {(0, 0, 0)}


def test_components_too_large_for_a_long_are_an_error(spark):
    rows = [(1, [0.0, 0.0], "x", 1), (2, [3e30, 0.0], "x", 1)]
    with pytest.raises(Exception, match="beyond 134217728"):
        centroids.lloyd(spark.createDataFrame(rows, SCHEMA), dims=2).collect()
