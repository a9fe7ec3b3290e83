"""Filter interaction audit: what each filter of a chain removes in every order of the chain.

Each document becomes a mask of the filters it fails; a part of the corpus becomes the counts of its masks, at most 2^n
cells. All orders are then visited by swaps of neighbours (plain changes). A swap changes what the two swapped steps see
and nothing else, so only those two are counted anew, from the cells. What a filter removes is added up along the walk.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import materialise

BLANK = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NAMES = "ABCDE"
MEASURES = ("docs", "good", "toxic")
#: Parts of the corpus whose walks run side by side; a task holds rows of all orders for so many at a time.
PARTS_AT_ONCE = 64


def text_failures(text: Column) -> list[Column]:
    """Conditions A to D on a text: few words, repeated words, many capitals, an odd character."""
    words = F.filter(F.split(text, BLANK), lambda w: w != "")
    capitals = F.char_length(text) - F.char_length(F.translate(text, UPPER, ""))
    n = F.size(words)
    return [n < 100, F.size(F.array_distinct(words)) * 100 < n * 80, capitals * 100 > F.char_length(text) * 10, text.rlike("[#$%&*|]")]


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``doc_id``, ``part``, ``mask`` and ``n``: documents by the filters they fail (bit 0 for A to bit 4 for E).

    E is failed by a text that a smaller id holds anywhere in the table. Texts meet as 128-bit hashes. The smallest id
    of each text comes from an aggregate and meets its rows by hash and id together, so a text with very many copies
    stays spread. A null text is empty, a null part the empty string. A null id is larger than any other; null ids
    alone do not fail E, nor do repeated rows of the smallest id. Rows alike in all this are counted in ``n``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bits = sum((F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(text_failures(text))), F.lit(0))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), bits.alias("mask"))
    rows = materialise(rows.groupBy("h1", "h2", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n")), "failed-filters")  # texts are read once
    firsts = rows.groupBy(F.col("h1").alias("f1"), F.col("h2").alias("f2")).agg(F.min("doc_id").alias("first"))
    found = rows.join(firsts, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")) & F.col("doc_id").eqNullSafe(F.col("first")), "left")
    mask = F.col("mask") + F.when(F.col("f1").isNull(), 1 << 4).otherwise(0)
    return found.select("doc_id", "part", mask.alias("mask"), "n")


def cells(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``part``, ``mask`` and the documents, those labelled good and those labelled toxic with that mask.

    ``failed`` has the columns of :func:`masks`. Documents are summed by id before labels meet them. Repeated labels of
    an id count once, a label of 1 over any other; a null id has none.
    """
    marked = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    by_id = failed.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    unlabelled = by_id.where("doc_id is null").select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("bad"))
    labelled = by_id.where("doc_id is not null").join(marked, "doc_id", "left").select("part", "mask", "n", "good", "bad")
    times = lambda c: F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0))).cast("long")
    return labelled.union(unlabelled).groupBy("part", "mask").agg(F.sum("n").cast("long").alias("docs"), times("good").alias("good"), times("bad").alias("toxic"))


def plain_changes(n: int) -> Iterator[int]:
    """Places p to swap with p + 1, one after the other, so that all orders of n things are met once (Steinhaus, Johnson, Trotter)."""
    order, heading = list(range(n)), [-1] * n
    while True:
        at = {thing: place for place, thing in enumerate(order)}
        able = [x for x in order if 0 <= at[x] + heading[x] < n and order[at[x] + heading[x]] < x]
        if not able:
            return
        mover = max(able)
        here = at[mover]
        there = here + heading[mover]
        order[here], order[there] = order[there], order[here]
        for larger in range(mover + 1, n):
            heading[larger] = -heading[larger]
        yield min(here, there)


class Walk:
    """Counts of the steps of one order for some parts side by side, kept up to date from swap to swap."""

    def __init__(self, counts: np.ndarray, n: int):
        """``counts``: part, measure, mask."""
        self.counts, self.order, self.index = counts, list(range(n)), np.arange(2**n)
        self.total = counts[:, 0].sum(axis=1)
        self.steps = np.zeros((len(counts), n, 5), np.int64)  # kept, removed, redundant, good lost, toxic lost
        self.shapley, self.since, self.visited = np.zeros((len(counts), n), np.int64), [0] * n, 0
        for place in range(n):
            self._count(place)

    def _count(self, place: int) -> None:
        earlier, own = sum(1 << f for f in self.order[:place]), 1 << self.order[place]
        fails, gone = self.index & own > 0, self.index & earlier > 0
        self.steps[:, place, 0] = self.counts[:, 0][:, ~(fails | gone)].sum(axis=1)
        self.steps[:, place, 2] = self.counts[:, 0][:, fails & gone].sum(axis=1)
        removed = self.counts[:, :, fails & ~gone].sum(axis=2)
        self.steps[:, place, 1], self.steps[:, place, 3], self.steps[:, place, 4] = removed[:, 0], removed[:, 1], removed[:, 2]

    def _settle(self, place: int) -> None:
        """Adds what the filter at this place has removed in the orders visited since it last changed."""
        thing = self.order[place]
        self.shapley[:, thing] += self.steps[:, place, 1] * (self.visited - self.since[thing])
        self.since[thing] = self.visited

    def swap(self, place: int) -> None:
        """On to the next order, which has the filters at ``place`` and after it exchanged."""
        self.visited += 1
        self._settle(place)
        self._settle(place + 1)
        self.order[place], self.order[place + 1] = self.order[place + 1], self.order[place]
        self._count(place)
        self._count(place + 1)

    def end(self) -> None:
        self.visited += 1
        for place in range(len(self.order)):
            self._settle(place)


AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def walked(parts: Sequence[str], counts: np.ndarray, names: str) -> pd.DataFrame:
    """All orders and steps of some parts, by part."""
    n = len(names)
    walk, orders, steps = Walk(counts, n), [], []
    for swap in [None, *plain_changes(n)]:
        if swap is not None:
            walk.swap(swap)
        orders.append(list(walk.order))
        steps.append(walk.steps.copy())
    walk.end()
    met = np.array(orders)  # order, step
    table = np.stack(steps, axis=1)  # part, order, step, count
    unique = counts[:, 0][:, 1 << np.arange(n)]
    text = np.array(["".join(names[f] for f in o) for o in orders], object)
    flat = lambda k: table[..., k].ravel()
    return pd.DataFrame({
        "part": np.repeat(np.array(parts, object), met.size), "filter_order": np.tile(np.repeat(text, n), len(parts)), "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(parts) * len(met)),
        "kept": flat(0), "removed": flat(1), "redundant": flat(2), "unique_fails": unique[:, met].ravel(), "good_lost": flat(3), "toxic_lost": flat(4), "shapley": walk.shapley[:, met].ravel(),
    })


def audit_cells(found: DataFrame, names: str = NAMES) -> DataFrame:
    """One row for each part, order of the filters and step, from the columns of :func:`cells`.

    A part's cells, at most 2^n, become one row, and the walk runs over some parts at a time.
    """
    n = len(names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), PARTS_AT_ONCE):
                piece = batch.iloc[start : start + PARTS_AT_ONCE]
                counts = np.zeros((len(piece), len(MEASURES), 2**n), np.int64)
                for i, own in enumerate(piece["cells"]):
                    for cell in own:
                        counts[i, :, cell["mask"]] = [cell[m] for m in MEASURES]
                yield walked(piece["part"].tolist(), counts, names)

    return found.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells")).mapInPandas(run, AUDIT)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part``, ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``,
    ``toxic_lost`` and ``shapley`` for every part and every order of the five filters.

    See :func:`masks` and :func:`cells` for nulls and repeated rows; an empty table gives no rows; further columns of
    either table are ignored.
    """
    return audit_cells(cells(masks(docs, id_col, text_col, part_col), labels, id_col))
