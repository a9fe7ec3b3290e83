"""Stages whose results are kept by what made them, so that a run picks up where an earlier one ended.

A stage's result has a name made of its code, its options, the names of the results it reads and the state of the files
it reads. A small manifest, written when the result is whole, says that it may be used. A changed input, option or
function gives other names from there on, and only those are made; what no run asked for last can be removed.
"""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators.provenance import topological
from cohortry.sources import remote


@dataclass
class Stage:
    """A function of (spark, inputs by name, options) that returns a table; ``needs`` are other stages or input files."""

    run: Callable[[SparkSession, Mapping[str, DataFrame], Mapping], DataFrame]
    needs: Sequence[str] = ()
    options: Mapping = field(default_factory=dict)


def code_of(function: Callable) -> str:
    """Hash of a function's text, so that a changed function makes its results anew."""
    return hashlib.sha256(inspect.getsource(function).encode()).hexdigest()


def state_of(spark: SparkSession, path: str) -> str:
    """Hash of the names, sizes and times of the files of an input, added up by tasks; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", F.unix_micros("modificationTime").alias("at"))
    mark = F.xxhash64("path", "length", "at")
    seen = files.agg(F.count(F.lit(1)), F.sum(mark.cast("decimal(38,0)")), F.bit_xor(mark)).first()
    return hashlib.sha256(repr(tuple(seen)).encode()).hexdigest()


class Results:
    """The folder of kept results."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _manifest(self, name: str) -> str:
        return f"{self.folder}/manifests/{name}.json"

    def has(self, name: str) -> bool:
        return remote.exists(self._manifest(name))

    def read(self, name: str) -> DataFrame:
        from pyspark.sql.types import StructType

        body = json.loads(remote.whole(self._manifest(name)))
        return self.spark.read.schema(StructType.fromJson(body["schema"])).parquet(f"{self.folder}/results/{name}")

    def keep(self, name: str, made: DataFrame, about: Mapping) -> None:
        """Writes a result, over what an earlier run may have left unfinished, and last its manifest."""
        made.write.mode("overwrite").parquet(f"{self.folder}/results/{name}")
        unnamed = f"{self.folder}/manifests/_{name}.json"
        remote.put(unnamed, json.dumps({**about, "schema": json.loads(made.schema.json())}, sort_keys=True).encode())
        remote.move(unnamed, self._manifest(name))

    def names(self) -> set[str]:
        root = f"{self.folder}/manifests"
        return {p.rsplit("/", 1)[1].removesuffix(".json") for p in remote.files(root, ".json")} if remote.exists(root, folder=True) else set()

    def drop_others(self, kept: Sequence[str]) -> list[str]:
        """Removes the results that are not among ``kept``, finished or not: the manifest first, so that none is read half."""
        gone = sorted(self.names() - set(kept))
        for name in gone:
            remote.remove(self._manifest(name))
        root = f"{self.folder}/results"
        for name in remote.folders(root) if remote.exists(root, folder=True) else []:
            if name not in kept:
                remote.remove(f"{root}/{name}")
        return gone


@dataclass
class Run:
    """Tables of the wanted stages, the names of all results used, and the stages that had to be made."""

    tables: dict[str, DataFrame]
    names: dict[str, str]
    made: list[str]


def run(spark: SparkSession, folder: str, stages: Mapping[str, Stage], inputs: Mapping[str, str], wanted: Sequence[str], tidy: bool = False) -> Run:
    """Makes the wanted stages and what they need, as far as the folder does not have them; ``inputs`` are Parquet paths by name.

    With ``tidy`` results that this run did not use are removed. A stage that fails leaves no manifest: the stages before
    it are kept, and the next run begins with it.
    """
    results = Results(spark, folder)
    depends = {name: [n for n in s.needs if n not in inputs] for name, s in stages.items()}
    names, tables, made, states = {}, {}, [], {}
    for name in topological(depends, wanted):
        stage = stages[name]
        for need in stage.needs:
            if need in inputs and need not in states:
                states[need] = state_of(spark, inputs[need])
        about = {"stage": name, "code": code_of(stage.run), "options": dict(stage.options), "needs": {n: states[n] if n in inputs else names[n] for n in stage.needs}}
        names[name] = f"{name}-{hashlib.sha256(json.dumps(about, sort_keys=True).encode()).hexdigest()[:32]}"
        if not results.has(names[name]):
            given = {n: spark.read.parquet(inputs[n]) if n in inputs else tables[n] for n in stage.needs}
            results.keep(names[name], stage.run(spark, given, stage.options), about)
            made.append(name)
        tables[name] = results.read(names[name])
    if tidy:
        results.drop_others(list(names.values()))
    return Run({n: tables[n] for n in wanted}, names, made)
