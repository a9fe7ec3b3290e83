"""Near-duplicate documents by SimHash fingerprints, found with the generalised pigeonhole principle.

A fingerprint's 64 bits are grouped into ``m`` parts, bits that vary together in the same part. For a radius ``r`` a
fingerprint gives its parts thresholds whose sum is ``r - m + 1`` (-1 skips a part); whatever lies within ``r`` then
agrees with it up to the threshold in one part at least. Dynamic programming picks, for each fingerprint, the
thresholds with the fewest expected probes and candidates, so it avoids parts whose value is crowded.

On this rests ``near_duplicates``, which links fingerprints within a small radius, and is complete. ``similar_documents``
looks for texts that share most of their word shingles. The same search finds the closest of them, and every link is
counted exactly; but texts at the bound of similarity have fingerprints that differ in too many bits for it to be
complete. So sets of shingles that have one of their rarest shingles in common are compared as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import free_name, materialise, out_batch, passing, slices, texts
from cohortry.llm.components import components
from cohortry.llm.wordhash import ngram_hashes, word_hashes

BITS = 64
#: Rows of a crowded value or shingle that one chunk holds on average when they are compared.
BUCKET_ROWS = 2048
#: Leading bits of a part whose value counts estimate how many candidates a probe meets; 2^16 counts a part at most.
SKETCH = 16
#: What a candidate (a row of a join) is taken to cost beside a probe (a number made in a task, about 0.15 microseconds); an estimate.
CANDIDATE = 32
#: Bits of the tables that spare most lookups and texts the way to a join, the same size whatever they hold.
TABLE_LOG2 = 23


def fingerprint(words: list[bytes], shingle: int = 3, seed: int = 42) -> int:
    """Bit i is set if it is set in over half of the XXH64 of all shingles; no words give 0."""
    if not words:
        return 0
    span = min(shingle, len(words))
    shingles = map(b" ".join, zip(*(words[i : len(words) - span + 1 + i] for i in range(span)), strict=True))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), np.uint64, len(words) - span + 1)
    ones = np.zeros(BITS, np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's 64 bits as a long) of every row.

    Text is lower-cased in A-Z only and cut at ASCII blanks. A null or blank text has fingerprint 0; repeated rows stay
    repeated; an empty table gives no rows; further columns are left behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_buffer().to_pybytes().lower().split(), shingle) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield out_batch(doc_id=batch.column("doc_id"), fp=found.view(np.int64))

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def joint_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in what share of them each two bits are set (4,096 sums, whatever the input)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joint, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            for part in np.array_split(batch.column("fp").to_numpy(zero_copy_only=False), batch.num_rows // 65536 + 1):
                b = np.unpackbits(part.astype(np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                joint += b.T @ b
                n += len(part)
        yield out_batch(cell=np.arange(BITS * BITS + 1, dtype=np.int32), n=np.append(joint.ravel(), n).astype(np.int64))

    joint = np.zeros(BITS * BITS + 1)
    for cell, n in fps.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n")).collect():
        joint[cell] = n
    return int(joint[-1]), joint[:-1].reshape(BITS, BITS) / max(joint[-1], 1)


def bit_parts(joint: np.ndarray, m: int) -> list[list[int]]:
    """The 64 bits in ``m`` parts of nearly equal size, correlated bits together.

    Each part starts with a free bit and takes up the free bit that correlates most with it, again and again.
    """
    p = np.diag(joint)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tied = np.abs((joint - np.outer(p, p)) / np.outer(spread, spread))
    free, parts = list(range(BITS)), []
    for i in range(m):
        part = [free.pop(0)]
        while len(part) < (BITS - sum(map(len, parts)) + m - i - 1) // (m - i):
            part.append(free.pop(int(np.argmax(tied[np.ix_(free, part)].sum(axis=1)))))
        parts.append(sorted(part))
    return parts


def take_bits(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The named bits of each fingerprint, packed from bit 0 on."""
    out = np.zeros(len(fps), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def even_shares(width: int, radius: int) -> np.ndarray:
    """Which share of all values of ``width`` bits lies within 0, 1, ... ``radius`` of one."""
    return ball_sizes(width, radius) / 2.0**width


def ball_counts(counts: np.ndarray, width: int, radius: int) -> np.ndarray:
    """For each value of the leading bits and each t in 0..radius, the expected count within distance t of it in all bits."""
    known = int(np.log2(len(counts)))
    within = even_shares(width - known, radius)
    shells = [counts.astype(float)] + [np.zeros(len(counts)) for _ in range(radius)]
    for b in range(known):
        turned = np.arange(len(counts)) ^ (1 << b)
        for r in range(radius, 0, -1):
            shells[r] = shells[r] + shells[r - 1][turned]
    return np.stack([sum(shells[r] * within[t - r] for r in range(t + 1)) for t in range(radius + 1)])


def ball_sizes(width: int, radius: int) -> np.ndarray:
    """How many values of ``width`` bits lie within 0, 1, ... ``radius`` of one."""
    return np.cumsum([float(comb(width, t)) for t in range(radius + 1)])


def allocate(costs: list[np.ndarray], budget: int) -> np.ndarray:
    """For each row the shares a_i (threshold + 1; 0 skips) with sum ``budget`` and least total of ``costs[i][a_i]``."""
    rows = costs[0].shape[1]
    best, picks = np.full((budget + 1, rows), np.inf), []
    best[0] = 0
    for cost in costs:
        options = np.full((budget + 1, budget + 1, rows), np.inf)
        for s in range(budget + 1):
            for a in range(s + 1):
                options[s, a] = best[s - a] + cost[a]
        picks.append(options.argmin(axis=1))
        best = options.min(axis=1)
    left, shares = np.full(rows, budget), np.zeros((len(costs), rows), np.int64)
    for i in range(len(costs) - 1, -1, -1):
        shares[i] = picks[i][left, np.arange(rows)]
        left = left - shares[i]
    return shares


class Plan:
    """Parts of the bits of a table's distinct fingerprints (column fp), and the numbers that share out thresholds.

    Of 2 to ``radius + 1`` parts the number is taken whose thresholds promise the table the least cost: the best
    thresholds of every fingerprint are worked out for each number, and their probes and candidates, as the counts of
    values let expect them, added up (``costs``). Candidates grow with the square of the table while parts are narrow,
    so larger tables take fewer and wider ones.
    """

    def __init__(self, fps: DataFrame, radius: int, m: int | None = None):
        self.radius = radius
        self.total, joint = joint_counts(fps)
        choices = [m] if m else range(2, max(3, radius + 2))
        split = {k: bit_parts(joint, k) for k in choices}
        flat = [(k, i, bits, min(SKETCH, len(bits))) for k in choices for i, bits in enumerate(split[k])]

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = [np.zeros(2**known, np.int64) for *_, known in flat]
            for batch in batches:
                x = _longs(batch, "fp").view(np.uint64)
                for s, (_, _, bits, known) in zip(seen, flat, strict=True):
                    s += np.bincount(take_bits(x, bits[:known]).astype(np.int64), minlength=2**known)
            for i, s in enumerate(seen):
                at = np.flatnonzero(s)
                yield out_batch(part=np.full(len(at), i, np.int32), value=at.astype(np.int32), n=s[at])

        seen = [np.zeros(2**known) for *_, known in flat]
        got = fps.mapInArrow(count, "part int, value int, n long").groupBy("part", "value").agg(F.sum("n").alias("n")).toArrow()
        part, value, n = (got.column(c).to_numpy() for c in ("part", "value", "n"))  # 2^16 for each part at most
        for i, s in enumerate(seen):
            s[value[part == i]] = n[part == i]
        self.costs = {}
        for k in choices:
            self.take(split[k], [s for s, (own, *_) in zip(seen, flat, strict=True) if own == k])
            self.costs[k] = self.cost_of(fps) if len(choices) > 1 else 0.0
        best = min(self.costs, key=self.costs.get)
        self.take(split[best], [s for s, (own, *_) in zip(seen, flat, strict=True) if own == best])

    def take(self, parts: list[list[int]], seen: list[np.ndarray]) -> None:
        self.parts = parts
        self.known = [int(np.log2(len(s))) for s in seen]
        self.expected = [ball_counts(s, len(p), self.radius) for s, p in zip(seen, parts, strict=True)]
        # a fingerprint is no candidate of its own
        self.own = [even_shares(len(p) - k, self.radius) for p, k in zip(parts, self.known, strict=True)]
        self.probes = [ball_sizes(len(p), self.radius) for p in parts]

    def shares(self, x: np.ndarray) -> tuple[np.ndarray, float]:
        """Thresholds (plus 1) of each part for fingerprints ``x``, those that cost each of them least, and that cost."""
        costs = []
        for i, bits in enumerate(self.parts):
            lead = take_bits(x, bits[: self.known[i]]).astype(np.int64)
            others = np.maximum(self.expected[i][:, lead] - self.own[i][:, None], 0)
            costs.append(np.vstack([np.zeros((1, len(x))), CANDIDATE * others + self.probes[i][:, None]]))
        shares = allocate(costs, self.radius + 1)
        return shares, float(sum(c[s, np.arange(len(x))].sum() for c, s in zip(costs, shares, strict=True)))

    def cost_of(self, fps: DataFrame) -> float:
        """Probes and candidates of all fingerprints with the present parts; a number for each task comes back."""
        shared = fps.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _longs(batch, "fp").view(np.uint64)
                yield out_batch(cost=np.array([sum(shared.value.shares(x[a : a + 16384])[1] for a in range(0, len(x), 16384))]))

        return fps.mapInArrow(run, "cost double").agg(F.sum("cost")).first()[0] or 0.0

    def turned(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Part, rows and values to look up for fingerprints ``x``, by the thresholds that cost each of them least."""
        shares, _ = self.shares(x)
        for i, bits in enumerate(self.parts):
            value = take_bits(x, bits)
            for t in range(self.radius + 1):
                at = np.flatnonzero(shares[i] > t)
                for flips in combinations(range(len(bits)), t) if len(at) else ():
                    yield i, at, value[at] ^ np.uint64(sum(1 << f for f in flips))


def value_bit(part: np.ndarray | int, value: np.ndarray) -> np.ndarray:
    """Where the table of bits of :func:`links` holds values of a part."""
    turn = np.uint64(0x9E3779B97F4A7C15)
    return (((value + turn) * (turn + np.uint64(2) * np.asarray(part).astype(np.uint64))) >> np.uint64(64 - TABLE_LOG2)).astype(np.int64)


def _longs(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64)


def links(fps: DataFrame, radius: int = 3, m: int | None = None) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints of ``fps`` (column ``fp``, no repeats) with at most ``radius`` differing bits.

    Not all such pairs, but enough to connect all that they connect. First each fingerprint meets one that stands for all
    with its value of a part, and one for each value that it looks up; what that brings together is one family. Then a
    lookup meets the fingerprints of other families only, so a dense family gives no pairs of its own. Rows with a null
    fingerprint are ignored.
    """
    fps = fps.where("fp is not null").select("fp")
    plan = Plan(fps, radius, m)
    context = fps.sparkSession.sparkContext
    shared = context.broadcast(plan)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _longs(batch, "fp").view(np.uint64)
            for i, bits in enumerate(shared.value.parts):
                yield out_batch(part=np.full(len(x), i, np.int32), value=take_bits(x, bits).view(np.int64), b=x.view(np.int64))

    close = lambda a, b: (F.col(a) != F.col(b)) & (F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius)
    indexed = fps.mapInArrow(index, "part int, value long, b long")
    sums = [F.count(F.lit(1)).alias("many"), F.min_by("b", F.xxhash64("b")).alias("hub")]
    hubs = materialise(indexed.groupBy("part", "value").agg(*sums), "value-hubs", plan.total * len(plan.parts))

    def bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield out_batch(bit=value_bit(_longs(batch, "part"), _longs(batch, "value").view(np.uint64)).astype(np.int32))

    bits = np.zeros(2**TABLE_LOG2, bool)
    bits[hubs.select("part", "value").mapInArrow(bits_of, "bit int").distinct().toArrow().column("bit").to_numpy()] = True  # 2^23 numbers at most
    held = context.broadcast(np.packbits(bits))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(held.value).astype(bool)
        for batch in batches:
            for some in range(0, batch.num_rows, 16384):
                x = _longs(batch.slice(some, 16384), "fp").view(np.uint64)
                found = [(i, value[seen], x[at[seen]]) for i, at, value in shared.value.turned(x) if (seen := table[value_bit(i, value)]).any()]
                if found:
                    part = np.repeat(np.array([i for i, *_ in found], np.int32), [len(v) for _, v, _ in found])
                    yield out_batch(part=part, value=np.concatenate([v for _, v, _ in found]).view(np.int64), a=np.concatenate([f for *_, f in found]).view(np.int64))

    # a lookup of a value that no fingerprint has goes no further than the table of bits or the join
    probing = materialise(fps.mapInArrow(probe, "part int, value long, a long").join(hubs, ["part", "value"]).where("many > 1 or a <> hub"), "lookups", plan.total * 4)
    own = indexed.join(hubs.where("many > 1"), ["part", "value"]).where(close("b", "hub")).select(F.col("b").alias("a"), F.col("hub").alias("b"))
    first = materialise(probing.where(close("a", "hub")).select("a", F.col("hub").alias("b")).union(own).distinct(), "first-links", plan.total * len(plan.parts))

    family = components(first)
    named = lambda df, c, out: df.join(family.select(F.col("node").alias(c), F.col("root").alias(out)), c, "left").withColumn(out, F.coalesce(out, c))
    salt = F.pmod(F.xxhash64("b"), F.ceil(F.col("many") / F.lit(BUCKET_ROWS)))
    chunks = named(indexed.join(hubs.where("many > 1").select("part", "value", "many"), ["part", "value"]), "b", "theirs").groupBy("part", "value", "theirs", salt.alias("salt")).agg(F.collect_list("b").alias("bs"))
    asking = named(probing.where("many > 1").select("part", "value", "a"), "a", "ours")
    near = lambda b: F.bit_count(F.col("a").bitwiseXOR(b)) <= radius
    met = asking.join(chunks, ["part", "value"]).where((F.col("ours") != F.col("theirs")) & F.exists("bs", near))
    return first.union(met.select("a", F.explode(F.filter("bs", near)).alias("b")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` (smallest id reachable over links, its own included) for every row.

    Rows of one fingerprint are linked without being paired; only distinct fingerprints are searched. The components are
    those of all pairs within ``radius``. Null and blank
    texts share fingerprint 0. Rows whose id is null keep a row; their component is the smallest id that is not null,
    or null if there is none. An empty table gives no rows.
    """
    marked = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    groups = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-groups", marked.count())
    found = components(links(groups.select("fp"), radius))
    roots = groups.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


#: Bytes of text a task works on at a time; a text's shingles take several numbers for each word.
SLICE = 500_000
#: Texts in which shingles are counted, and how many of the frequent ones are ordered by their count.
COUNTED_TEXTS, ORDERED = 2**15, 2**19
#: Rows of numbers that a text's shingles stand for, roughly, when files are counted out.
TEXT_ROWS = 50
#: How many sets stand for all that have a rare shingle in the first round.
HUBS = 4
#: Sets are dealt by size, each class so many times larger than the one before.
SIZE_STEP = 1.1


def shingle_sets(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text's shingles, ascending, and where each text's begin; a shorter text is one shingle."""
    words, first, *_ = word_hashes(column, keep_punctuation=True)
    sizes = np.diff(first)
    grams = ngram_hashes(words, shingle)
    of = np.repeat(np.arange(len(sizes)), sizes)[: len(grams)]
    whole = np.arange(len(grams)) + shingle <= first[of + 1]
    short = np.flatnonzero((sizes > 0) & (sizes < shingle))
    hashes = np.concatenate([grams[whole], *(ngram_hashes(words[first[i] : first[i + 1]], int(sizes[i])) for i in short)])
    of = np.concatenate([of[whole], short])
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], np.searchsorted(of[new], np.arange(len(sizes) + 1))


def set_names(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, the same for equal sets."""
    return np.fromiter((xxhash.xxh64_intdigest(hashes[a:b].tobytes()) for a, b in zip(first, first[1:], strict=False)), np.uint64, len(first) - 1).view(np.int64)


def set_fingerprints(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SimHash of each set: a bit is set if it is set in over half of the set's hashes; an empty set gives 0."""
    sizes = np.diff(first)
    out = np.zeros(len(sizes), np.uint64)
    for a in range(0, len(sizes), 256):
        held = np.flatnonzero(sizes[a : a + 256]) + a
        if len(held):
            some = hashes[first[held[0]] : first[held[-1] + 1]]
            bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, first[held] - first[held[0]], axis=0, dtype=np.int32)
            out[held] = np.packbits(2 * ones > sizes[held][:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out.view(np.int64)


@passing()
def frequent_shingles(rows: DataFrame, shingle: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and counts of shingles that repeat in a sample of the ``total`` texts.

    They only order the shingles of a text, frequent ones last; any order gives the same links, some at greater cost.
    """
    share = max(1, -(-total // COUNTED_TEXTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, limit=SLICE):
                yield out_batch(h=shingle_sets(piece.column("text"), shingle)[0].view(np.int64))

    sample = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == 0)
    counted = materialise(sample.mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shingle-counts", total * 8)
    least, held = 2, 0
    for r in counted.groupBy("n").agg(F.count(F.lit(1)).alias("many")).orderBy(F.desc("n")).collect():  # at most a row for each count
        held += r.many
        if held > ORDERED:
            least = r.n + 1
            break
    got = counted.where(F.col("n") >= least).toArrow()
    hashes = got.column("h").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], got.column("n").to_numpy().astype(np.int64)[order]


def rare_shingles(hashes: np.ndarray, first: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], share: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """The prefix of each set in one order of all shingles, rare ones first, and where each begins: two sets of a Jaccard
    similarity of ``share`` or more have a shingle of their prefixes in common."""
    sizes = np.diff(first)
    of = np.repeat(np.arange(len(sizes)), sizes)
    known, counts = frequent
    n = np.zeros(len(hashes), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        n = np.where(known[at] == hashes, counts[at], 0)
    order = np.lexsort((hashes, n, of))
    length = np.where(sizes > 0, sizes + (-share.numerator * sizes) // share.denominator + 1, 0)
    return hashes[order[np.arange(len(hashes)) - first[of] < length[of]]], np.concatenate([[0], np.cumsum(length)])


def alike(a: Column, b: Column, share: Fraction) -> Column:
    """Whether sets can reach the similarity that have ``a``.n and ``b``.n shingles, the first in common at ``a``.at and ``b``.at."""
    n, m, i, j = a["n"], b["n"], a["at"], b["at"]
    top, bottom = F.lit(share.numerator), F.lit(share.denominator)
    return (bottom * F.least(n, m) >= top * F.greatest(n, m)) & ((top + bottom) * F.least(n - i, m - j) >= top * (n + m))


@passing()
def verified(rows: DataFrame, pairs: DataFrame, shingle: int, share: Fraction, total: int) -> DataFrame:
    """The ``pairs`` (columns ``a``, ``b``: names of sets of the ``total`` texts) whose Jaccard similarity, counted exactly, is at
    least ``share``."""
    pairs = materialise(pairs.distinct(), "set-pairs", total * 8)
    names = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    bits = np.zeros(2**TABLE_LOG2, bool)
    bits[names.select(F.expr(f"shiftrightunsigned(node, {64 - TABLE_LOG2})").cast("int").alias("bit")).distinct().toArrow().column("bit").to_numpy()] = True
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            for piece in slices(batch, limit=SLICE):
                hashes, first = shingle_sets(piece.column("text"), shingle)
                node = set_names(hashes, first)
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield out_batch(node=node, own=lists).filter(pa.array(table[(node.view(np.uint64) >> np.uint64(64 - TABLE_LOG2)).astype(np.int64)]))

    sets = rows.select("text").mapInArrow(run, "node long, own array<long>").join(names, "node", "left_semi")
    sets = materialise(sets.groupBy("node").agg(F.first("own").alias("own")), "shingle-sets", total * TEXT_ROWS)
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("own").alias("one")), "a").join(sets.select(F.col("node").alias("b"), F.col("own").alias("two")), "b")
    both = both.select("a", "b", F.size(F.array_intersect("one", "two")).cast("long").alias("common"), (F.size("one") + F.size("two")).cast("long").alias("total"))
    return materialise(both.where(F.col("common") * share.denominator >= (F.col("total") - F.col("common")) * share.numerator).select("a", "b"), "set-links", total * 8, stays=True)


def largest_partner(share: Fraction) -> Column:
    """The largest size of a set that can be similar to one of ``n`` shingles if its place ``at`` holds the first in common."""
    top, bottom = share.numerator, share.denominator
    return F.expr(f"((n - at) * {top + bottom} - n * {top}) div {top}")


@passing()
def open_pairs(met: DataFrame, linked: DataFrame, share: Fraction, total: int) -> DataFrame:
    """Pairs ``a``, ``b`` of sets with a rare shingle in common (``met``: token, node, n, at) that may reach ``share`` and that
    the links ``linked`` do not bring together."""
    labels = components(linked).select(F.col("node").alias("known"), F.col("root").alias("label"))
    open_ = met.join(labels, F.col("node") == F.col("known"), "left").select("token", "node", "n", "at", F.coalesce("label", "node").alias("label"), largest_partner(share).alias("most"))
    open_ = materialise(open_, "labelled-shingles", total * TEXT_ROWS)
    apart = open_.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("token")
    open_ = open_.join(apart, "token")
    size_class = lambda n: F.floor(F.log(n.cast("double")) / float(np.log(SIZE_STEP))).cast("int")
    least = F.ceil(F.col("n") * share.numerator / share.denominator - 1e-9)
    # of two sets the smaller goes by its own size, the larger to all sizes that a smaller partner can have
    smaller = open_.where("most >= n").withColumn("size", size_class(F.col("n"))).withColumn("large", F.lit(False))
    larger = open_.where(F.col("most") >= least).withColumn("size", F.explode(F.sequence(size_class(least), size_class(F.least("n", "most"))))).withColumn("large", F.lit(True))
    roles = materialise(smaller.unionByName(larger).select("token", "size", "large", "label", F.struct("node", "n", "at").alias("x")), "shingle-roles", total * TEXT_ROWS)
    several = roles.groupBy("token", "size").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count_if(~F.col("large")).alias("few"), F.count(F.lit(1)).alias("many")).where("low <> high and few > 0")
    deals = several.select("token", "size", F.ceil(F.col("many") / F.lit(BUCKET_ROWS)).cast("int").alias("deals"))
    chunk = F.pmod(F.xxhash64("x.node"), F.col("deals")).alias("chunk")
    chunks = roles.join(deals, ["token", "size"]).groupBy("token", "size", "large", "deals", "label", chunk).agg(F.collect_list("x").alias("xs"))
    chunks = materialise(chunks, "shingle-chunks", total * TEXT_ROWS)
    left = chunks.where("not large").select("token", "size", F.pmod(F.xxhash64("label", "chunk"), F.col("deals")).cast("int").alias("deal"), F.col("label").alias("one"), "xs")
    right = chunks.where("large").select("token", "size", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"), F.col("label").alias("two"), F.col("xs").alias("ys"))
    fits = lambda x, y: ((x["n"] < y["n"]) | (x["n"] == y["n"]) & (x["node"] < y["node"])) & alike(x, y, share)
    met_again = left.join(right, ["token", "size", "deal"]).where((F.col("one") != F.col("two")) & F.exists("xs", lambda x: F.exists("ys", lambda y: fits(x, y))))
    pairs = met_again.select(F.explode("xs").alias("x"), "ys").select("x", F.explode("ys").alias("y")).where(fits(F.col("x"), F.col("y")))
    return materialise(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "open-pairs", total * 8, stays=True)


@passing()
def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, radius: int = 3) -> DataFrame:
    """``doc_id``, ``component_id`` of every row: groups of texts whose sets of ``shingle``-word shingles are linked.

    Two texts are linked if the Jaccard similarity of their sets (hashes of 64 bits, each shingle once) is at least
    ``similarity``; the search is complete and every link is counted exactly. It has two rounds, so that a large group does
    not give all its pairs. The first links sets whose fingerprints differ in at most ``radius`` bits, and each set with
    one other that has the same rare shingle. Sets that are similar have a shingle in common among the rarest of each (a
    fifth of the set and one more, for 0.8), and what stands before it bounds the size of the other. The second round
    compares the sets that meet so and that the first has not brought together.

    Words are lower-cased in A-Z and end at ASCII blanks. Texts of equal sets are one group without being paired; null and
    blank texts are one group. Rows with a null id get the smallest id of their group that is not null, if any. An empty
    table gives no rows.
    """
    share = Fraction(str(similarity))
    rows = texts(docs, id_col, text_col)
    total = rows.count()
    frequent = rows.sparkSession.sparkContext.broadcast(frequent_shingles(rows, shingle, total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, limit=SLICE):
                hashes, first = shingle_sets(piece.column("text"), shingle)
                rare, starts = rare_shingles(hashes, first, frequent.value, share)
                lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(rare.view(np.int64)))
                yield out_batch(doc_id=piece.column("doc_id"), node=set_names(hashes, first), n=np.diff(first).astype(np.int64), rare=lists, fp=set_fingerprints(hashes, first))

    marked = materialise(rows.mapInArrow(run, "doc_id long, node long, n long, rare array<long>, fp long"), "rare-shingles", total * TEXT_ROWS)
    nodes = marked.groupBy("node").agg(F.first("n").alias("n"), F.first("rare").alias("rare"))
    places = nodes.select("node", "n", F.posexplode("rare").alias("at", "token"))
    # a set holds a shingle once; written down, so that the shuffles that count are gone when the places meet
    tokens = materialise(places.groupBy("token").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("token"), "repeated-shingles", total * TEXT_ROWS)
    met = materialise(places.join(tokens, "token").select("token", "node", "n", "at"), "common-shingles", total * TEXT_ROWS)
    # a few sets, not the same ones for each shingle, are what the others of a large group are compared with first
    entries = (F.struct(F.xxhash64("node", F.lit(k), F.pmod("token", F.lit(4))).alias("h"), "node", "n", "at") for k in range(HUBS))
    hubs = met.groupBy("token").agg(F.array_distinct(F.array(*(F.min(e) for e in entries))).alias("hubs"))
    beside = met.join(hubs, "token").select(F.struct("node", "n", "at").alias("x"), F.explode("hubs").alias("hub"))
    beside = beside.where(F.col("x.node") != F.col("hub.node")).where(alike(F.col("x"), F.col("hub"), share)).select(F.col("x.node").alias("a"), F.col("hub.node").alias("b"))

    of_print = marked.select("fp", "node").where("n > 0").distinct()
    prints = materialise(of_print.groupBy("fp").agg(F.min("node").alias("least")), "set-fingerprints", total)
    same = of_print.join(prints, "fp").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    near = links(prints, radius).join(prints.select(F.col("fp").alias("a"), F.col("least").alias("one")), "a").join(prints.select(F.col("fp").alias("b"), F.col("least").alias("two")), "b")
    first = verified(rows, beside.union(same).union(near.select("one", "two")), shingle, share, total)

    again = open_pairs(met, first, share, total)
    second = verified(rows, again, shingle, share, total)

    roots = components(first.unionByName(second)).withColumnRenamed("root", "label")
    own = marked.select("doc_id", "node").join(roots, "node", "left").select("doc_id", "node", F.coalesce("label", "node").alias("label"))
    least_id = own.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return materialise(own.join(least_id, "label").select("doc_id", "component_id"), "similar-documents", total, stays=True)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group of similar documents; rows with a null id stay."""
    gone = free_name(docs, "gone")
    out = similar_documents(docs, id_col, text_col, **options).where("doc_id <> component_id").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(out, F.col(id_col).cast("long") == F.col(gone), "left_anti")
