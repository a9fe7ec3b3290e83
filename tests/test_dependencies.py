"""Closure and order of stages as tables, against the walk over a dictionary; results of stages kept between runs."""

import random

import pytest

from cohortry.operators import dependencies as dp
from cohortry.operators.provenance import topological


def tables(spark, depends, wanted):
    stages = spark.createDataFrame([(s,) for s in depends], "stage string")
    needs = spark.createDataFrame([(s, n, i) for s, own in depends.items() for i, n in enumerate(own)], "stage string, need string, ord int")
    return stages, needs, spark.createDataFrame([(w, i) for i, w in enumerate(wanted)], "stage string, ord int")


def ordered(spark, depends, wanted):
    return [r.stage for r in dp.run_order(*tables(spark, depends, wanted)).orderBy("at").collect()]


def test_the_order_is_that_of_the_walk(spark):
    fixed = {"report": ["diff", "model"], "diff": ["matrix"], "model": ["matrix", "diff"], "matrix": ["qc"], "qc": [], "alone": []}
    assert ordered(spark, fixed, ["report", "alone"]) == topological(fixed, ["report", "alone"]) == ["qc", "matrix", "diff", "model", "report", "alone"]
    rng = random.Random(4)
    for n in (6, 14):
        depends = {f"s{i}": rng.sample([f"s{j}" for j in range(i)], min(i, rng.randrange(4))) for i in range(n)}
        wanted = rng.sample(sorted(depends), n // 2)
        assert ordered(spark, depends, wanted) == topological(depends, wanted)


def test_repeated_and_empty_wishes(spark):
    depends = {"a": ["b", "b"], "b": []}
    assert ordered(spark, depends, ["a", "a", None, "b"]) == ["b", "a"]
    assert ordered(spark, depends, []) == []


def test_cycles_and_unknown_stages_are_errors(spark):
    depends = {"a": ["b"], "b": ["c", "e"], "c": ["d"], "d": ["b"], "e": [], "f": ["f"], "g": ["a"]}
    with pytest.raises(ValueError, match="cycle among b, c, d$"):
        ordered(spark, depends, ["g"])
    with pytest.raises(ValueError, match="cycle among f$"):
        ordered(spark, depends, ["e", "f"])
    assert ordered(spark, depends, ["e"]) == ["e"]  # cycles elsewhere do not matter
    with pytest.raises(ValueError, match="unknown stage zz"):
        ordered(spark, {"a": ["zz"]}, ["a"])
    stages, needs, wanted = tables(spark, depends, ["g"])
    assert sorted(r.stage for r in dp.closure(needs, wanted).collect()) == ["a", "b", "c", "d", "e", "g"]


def test_no_join_of_the_rounds_broadcasts(spark, monkeypatch):
    plans = []

    def kept(df, name, own=dp.materialise):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return own(df, name)

    monkeypatch.setattr(dp, "materialise", kept)
    assert ordered(spark, {"a": ["b", "c"], "b": ["c"], "c": []}, ["a"]) == ["c", "b", "a"]
    assert sum("Join" in p for p in plans) > 5 and not any("BroadcastExchange" in p for p in plans)
