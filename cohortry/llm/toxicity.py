"""Toxicity scores from a factorization machine over hashed terms.

A text's terms are its words and their first four and five bytes (inflected forms share a stem), hashed. The machine adds
a bias, a weight for each term present and, through low-rank factors, a weight for each pair of terms, so that an insult
together with a group mention can count for more than both alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import out_batch, slices, texts
from cohortry.llm.wordhash import word_hashes

BUCKETS_LOG2 = 18
PREFIXES = (4, 5)
#: Bytes of text a task works on at a time; words and two prefixes take several numbers for each byte.
SLICE = 400_000


@dataclass(frozen=True)
class Machine:
    """Slot of each bucket (-1: not used), bias, weights and factors of the slots."""

    slots: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, terms: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of label 1 for texts whose distinct buckets are ``terms[first[i]:first[i + 1]]``."""
        slots = self.slots[terms]
        used = slots >= 0
        of = np.repeat(np.arange(len(first) - 1), np.diff(first))[used]
        slots, n = slots[used], len(first) - 1
        linear = self.bias + np.bincount(of, self.weights[slots], n)
        for f in self.factors.T:
            linear += 0.5 * (np.bincount(of, f[slots], n) ** 2 - np.bincount(of, f[slots] ** 2, n))
        return 1.0 / (1.0 + np.exp(-np.clip(linear, -30, 30)))


def distinct_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text, ascending, and where each text's begin."""
    hashes, first, _, _, *stems = word_hashes(column, prefixes=PREFIXES)
    of = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    shift = np.uint64(64 - BUCKETS_LOG2)
    keys = np.concatenate([(of << np.uint64(BUCKETS_LOG2) | h >> shift)[h != 0] for h in (hashes, *stems)])
    keys = np.unique(keys)
    starts = np.searchsorted(keys, np.arange(len(first), dtype=np.uint64) << np.uint64(BUCKETS_LOG2))
    return (keys & np.uint64(2**BUCKETS_LOG2 - 1)).astype(np.int64), starts


@dataclass(frozen=True)
class Sample:
    """Labelled rows: row i has the distinct buckets ``terms[first[i]:first[i + 1]]`` and ``labels[i]``."""

    terms: np.ndarray
    first: np.ndarray
    labels: np.ndarray

    def parts(self, rows: int = 1000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Some rows at a time: from, to, their terms and which of the rows each belongs to."""
        for a in range(0, len(self.labels), rows):
            b = min(a + rows, len(self.labels))
            yield a, b, self.terms[self.first[a] : self.first[b]], np.repeat(np.arange(b - a), np.diff(self.first[a : b + 1]))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each bucket the sum of ``values`` over the rows that have it."""
        out = np.zeros(2**BUCKETS_LOG2)
        for a, b, terms, of in self.parts():
            out += np.bincount(terms, values[a:b][of], 2**BUCKETS_LOG2)
        return out


#: Rows that a term is in at least. Chi-squared of a term alone, and normal deviates of a pair, from which they count.
LEAST_ROWS, ALONE, TOGETHER = 3, 6.6, 6.5
#: Terms in at least one row of so many meet one another in matrices, so many at a time; a rarer term visits its rows.
HEAVY, BLOCK = 16, 512


def telling_alone(sample: Sample, counts: np.ndarray) -> np.ndarray:
    """The buckets whose chi-squared against the label is beyond chance, best first."""
    n, positive = len(sample.labels), sample.labels.sum()
    expected = counts * positive / n
    chi = (sample.sums(sample.labels) - expected) ** 2 / np.maximum(expected * (1 - positive / n) * (1 - counts / n), 1e-9)
    chi[(counts < LEAST_ROWS) | (counts >= n)] = 0
    best = np.argsort(-chi, kind="stable")
    return best[chi[best] > ALONE]


def telling_together(sample: Sample, counts: np.ndarray, chosen: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Buckets outside ``chosen`` that belong to a pair which explains what ``scores`` leave of the labels, beyond chance.

    What is left of a row is taken to vary as its score says, or as it does, whichever is more. All pairs are judged: of two
    terms that many rows have, by the product of their deviations from their shares; of others, by the rows with both. For
    these, the sum of left^2 / variance over a term's rows of one sign bounds the square of any of its pairs' deviates
    (Cauchy and Schwarz), so terms whose bound is too low are passed over and no pair is lost.
    """
    left = sample.labels - scores
    varies = np.maximum(scores * (1 - scores), left**2)
    known = (counts >= LEAST_ROWS) & (counts < len(left))
    heavy = known & (counts * HEAVY >= len(left))
    bound = np.maximum(*(sample.sums(np.where(left * sign > 0, left**2 / varies, 0.0)) for sign in (1, -1)))
    reach = known & (bound > TOGETHER**2)
    found = [*heavy_pairs(sample, counts, np.flatnonzero(heavy), left, varies), *light_pairs(sample, heavy, np.flatnonzero(reach), left, varies)]
    return np.setdiff1d(np.concatenate(found), chosen) if found else chosen[:0]


def heavy_pairs(sample: Sample, counts: np.ndarray, heavy: np.ndarray, left: np.ndarray, varies: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of ``heavy`` that tell in a pair with another of them, by sums over all rows of products of deviations."""
    slots = np.full(2**BUCKETS_LOG2, -1, np.int32)
    slots[heavy] = np.arange(len(heavy))
    share = (counts[heavy] / len(left)).astype(np.float32)
    for begin in range(0, len(heavy), BLOCK):
        some = min(BLOCK, len(heavy) - begin)
        told, noise = np.zeros((some, len(heavy) - begin)), np.zeros((some, len(heavy) - begin))
        for a, b, terms, of in sample.parts():
            z = np.tile(-share[begin:], (b - a, 1))
            slot = slots[terms] - begin
            z[of[slot >= 0], slot[slot >= 0]] += 1
            told += z[:, :some].T @ (z * left[a:b, None].astype(np.float32))
            z *= z
            noise += z[:, :some].T @ (z * varies[a:b, None].astype(np.float32))
        tells = np.abs(told) > TOGETHER * np.sqrt(np.maximum(noise, 1e-9))
        np.fill_diagonal(tells, False)
        yield heavy[begin : begin + some][tells.any(axis=1)]
        yield heavy[begin:][tells.any(axis=0)]


def light_pairs(sample: Sample, heavy: np.ndarray, reach: np.ndarray, left: np.ndarray, varies: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of ``reach`` that tell in a pair of which at least one is not ``heavy``, by sums over the rows with both."""
    slots = np.full(2**BUCKETS_LOG2, -1, np.int32)
    slots[reach] = np.arange(len(reach))
    cols, rows = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for a, _, terms, of in sample.parts():
        slot = slots[terms]
        cols.append(slot[slot >= 0])
        rows.append((of[slot >= 0] + a).astype(np.int32))
    cols, rows = np.concatenate(cols), np.concatenate(rows)
    first = np.searchsorted(rows, np.arange(len(left) + 1))
    light = np.flatnonzero(~heavy[reach])
    by_term = np.argsort(cols, kind="stable")
    edges = np.searchsorted(cols[by_term], np.stack([light, light + 1]))
    for term, begin, end in zip(light, *edges, strict=True):
        mine = rows[by_term[begin:end]]
        sums = np.zeros((3, len(reach)))
        for some in np.array_split(mine, len(mine) // 1000 + 1):
            sizes = first[some + 1] - first[some]
            theirs = cols[np.repeat(first[some] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
            for k, weights in enumerate((np.ones(len(some)), left[some], varies[some])):
                sums[k] += np.bincount(theirs, np.repeat(weights, sizes), len(reach))
        seen, told, noise = sums
        tells = (seen >= LEAST_ROWS) & (np.abs(told) > TOGETHER * np.sqrt(noise))
        tells[term] = False
        if tells.any():
            yield reach[np.append(np.flatnonzero(tells), term)]


def descend(sample: Sample, used: np.ndarray, rank: int, epochs: int, seed: int, boost: float) -> Machine:
    """A machine over the buckets in ``used``, fitted with AdaGrad."""
    n, labels, positive = len(sample.labels), sample.labels, sample.labels.sum()
    slots = np.full(2**BUCKETS_LOG2, -1, np.int32)
    slots[used] = np.arange(len(used), dtype=np.int32)
    rng = np.random.default_rng(seed)
    width = max(len(used), 1)
    w, v, b = np.zeros(width), rng.normal(0, 0.01, (width, rank)), np.log(positive / (n - positive))
    gw, gv, gb = np.full(width, 1e-6), np.full((width, rank), 1e-6), 1e-6
    held, sizes = [np.zeros(0, np.int32)], np.zeros(n, np.int64)
    for a, c, terms, of in sample.parts():
        slot = slots[terms]
        held.append(slot[slot >= 0])
        sizes[a:c] = np.bincount(of[slot >= 0], minlength=c - a)
    x, at = np.concatenate(held), np.concatenate([[0], np.cumsum(sizes)])
    for _ in range(epochs):
        order = rng.permutation(n)
        for some in np.array_split(order, max(1, n // 128)):
            sizes = at[some + 1] - at[some]
            row = np.repeat(np.arange(len(some)), sizes)
            cols = x[np.repeat(at[some] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())]
            vx = v[cols]
            total = np.stack([np.bincount(row, c, len(some)) for c in vx.T], axis=1)
            out = b + np.bincount(row, w[cols], len(some)) + 0.5 * ((total**2).sum(axis=1) - np.bincount(row, (vx**2).sum(axis=1), len(some)))
            err = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - labels[some]) * np.where(labels[some] > 0, boost, 1.0) / len(some)
            dw = np.bincount(cols, err[row], width) + 1e-5 * w
            dv = np.stack([np.bincount(cols, c, width) for c in (err[row][:, None] * (total[row] - vx)).T], axis=1) + 1e-4 * v
            db = err.sum()
            gw, gv, gb = gw + dw**2, gv + dv**2, gb + db**2
            w, v, b = w - 0.2 * dw / np.sqrt(gw), v - 0.02 * dv / np.sqrt(gv), b - 0.1 * db / np.sqrt(gb)
    return Machine(slots, float(b), w, v)


def fit(terms: np.ndarray, first: np.ndarray, labels: np.ndarray, rank: int = 8, epochs: int = 60, seed: int = 7, boost: float = 2.0) -> Machine:
    """A machine fitted on the terms that tell of the label alone, and on those that do so only in company; with one label
    only, its rate.

    A machine over all terms would learn its few rows by heart. So the terms that chance does not explain come first,
    however many; what their machine leaves unexplained then names the terms that matter in pairs, whatever they tell alone,
    and if there are any, the machine is fitted anew on all of them.
    """
    n, positive = len(labels), labels.sum()
    if n == 0 or positive in (0, n):
        rate = (positive + 0.5) / (n + 1)
        return Machine(np.full(2**BUCKETS_LOG2, -1, np.int32), float(np.log(rate / (1 - rate))), np.zeros(1), np.zeros((1, rank)))
    sample = Sample(terms, first, labels)
    counts = sample.sums(np.ones(n))
    chosen = telling_alone(sample, counts)
    machine = descend(sample, chosen, rank, epochs, seed, boost)
    scores = np.concatenate([machine.scores(some, np.append(first[a:b], first[b]) - first[a]) for a, b, some, _ in sample.parts()])
    more = telling_together(sample, counts, chosen, scores)
    return descend(sample, np.concatenate([chosen, more]), rank, epochs, seed, boost) if len(more) else machine


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels are never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(doc_id.cast("string")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 20_000) -> Machine:
    """A machine from at most ``sample`` labelled rows outside the held-out third.

    The bound is what the driver can hold; the rows taken are those with the smallest hashes of their ids. Rows with a null
    id, label or text, and labelled ids without a document, are not learnt from.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    marks = marks.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    marks = F.broadcast(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))  # at most ``sample`` pairs of numbers
    rows = docs.where(F.col(text_col).isNotNull())
    known = texts(rows, id_col, text_col).join(marks, "doc_id").select("doc_id", "text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, limit=SLICE):
                terms, first = distinct_terms(piece.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(terms.astype(np.int32)))
                yield out_batch(doc_id=piece.column("doc_id"), terms=lists, label=piece.column("label"))

    got = known.mapInArrow(run, "doc_id long, terms array<int>, label int").toArrow()
    order = pc.sort_indices(pa.table({k: got.column(k) for k in ("doc_id", "label")}), [("doc_id", "ascending"), ("label", "ascending")])
    labels = got.column("label").take(order).to_numpy().astype(float)
    lists = [got.column("terms").take(order.slice(a, 500)).combine_chunks() for a in range(0, len(order), 500)]  # never two copies of all terms
    del got
    first = np.concatenate([[0], *(np.array(part.value_lengths(), np.int64) for part in lists)]).cumsum()
    terms = np.empty(first[-1], np.int32)
    at = 0
    while lists:
        part = lists.pop(0).flatten().to_numpy()
        terms[at : at + len(part)] = part
        at += len(part)
    return fit(terms, first, labels)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` (probability of label 1) of every row; null and empty texts score by the bias alone.

    Repeated rows stay repeated, null ids stay null, further columns are left behind, and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, limit=SLICE):
                terms, first = distinct_terms(piece.column("text"))
                yield out_batch(doc_id=piece.column("doc_id"), score=shared.value.scores(terms, first))

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def keep_below(docs: DataFrame, machine: Machine, limit: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, with all their columns; a null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text_col, SLICE):
                found = shared.value.scores(*distinct_terms(piece.column(text_col).fill_null("")))
                yield piece.filter(pa.array(found < limit))

    return docs.mapInArrow(run, docs.schema)
