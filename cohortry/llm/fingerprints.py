"""Document fingerprints: SimHash of weighted terms, and search within a Hamming radius by permuted block tables.

A text's terms are its single words and pairs of neighbouring words; a term weighs the logarithm of one plus its number of
occurrences. Each term's hash votes with its weight for or against every bit, and the sign of the sum is the bit.
For a search, the fingerprint's bits are cut into more blocks than the radius; each table permutes some of the blocks
to the front, and whatever lies within the radius agrees on the front of one table at least.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import materialise, out_batch, slices, texts
from cohortry.llm.wordhash import mix, ngram_hashes, word_hashes

BITS = 128
LANES = tuple(np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def simhash(column: pa.Array) -> np.ndarray:
    """Fingerprints of a string column without nulls as rows of two unsigned 64-bit halves; no words give zeros."""
    hashes, first, *_ = word_hashes(column)
    pairs = ngram_hashes(hashes, 2)
    out = np.zeros((len(column), 2), np.uint64)
    for i, (a, b) in enumerate(zip(first, first[1:], strict=False)):
        if a == b:
            continue
        terms, times = np.unique(np.concatenate([hashes[a:b], pairs[a : b - 1]]), return_counts=True)
        weights, votes = np.log1p(times).astype(np.float32), np.zeros(BITS, np.float64)
        for start in range(0, len(terms), 32768):
            some = terms[start : start + 32768]
            lanes = np.stack([mix(some ^ lane) for lane in LANES], axis=1)
            bits = np.unpackbits(lanes.view(np.uint8).reshape(len(some), -1), axis=1, bitorder="little")
            votes += weights[start : start + 32768] @ bits
        out[i] = np.packbits(2 * votes > weights.sum(dtype=np.float64), bitorder="little").view(np.uint64)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated cosine of the weighted terms, 0 to 1, from the share of differing bits."""
    apart = np.bitwise_count(a ^ b).sum(axis=1)
    return np.clip(np.cos(np.pi * apart / BITS), 0.0, 1.0)


def as_hex(fps: np.ndarray) -> list[str]:
    return [f"{int(high):016x}{int(low):016x}" for low, high in fps]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the fingerprint's halves ``low`` and ``high`` of every row.

    Null, empty and wordless texts have fingerprint zero; repeated rows stay repeated, null ids stay null, an empty table gives no
    rows, and further columns are left behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                found = simhash(piece.column("text")).view(np.int64)
                yield out_batch(doc_id=piece.column("doc_id"), low=np.ascontiguousarray(found[:, 0]), high=np.ascontiguousarray(found[:, 1]))

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, low long, high long")


def with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Each row's fingerprint beside that of its edited text and that of the next document.

    The next document has the next smaller id; after the smallest comes the largest. The edited text has its last
    ``n_chars // 3`` code points replaced by as many first ones of the next document's text (or all, if it is shorter).
    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``low``, ``high``, ``edited_low``, ``edited_high``, ``near_edited``,
    ``near_next``.

    The ids alone are ranked first: some of them become bounds, and texts are then dealt once, by range, the text at the
    top of a range also to the range above it. Rows of the same id follow one another by text; rows with a null id come
    last. A single row is its own next. An empty table gives no rows.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts(docs, id_col, text_col).withColumn("sort_id", F.coalesce(F.col("doc_id"), F.lit(-(2**63))))
    ends = rows.agg(F.min("sort_id"), F.max("sort_id"), F.percentile_approx("sort_id", [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()
    if ends[0] is None:
        schema = "doc_id long, n_chars long, edited_sha256 string, low long, high long, edited_low long, edited_high long, near_edited double, near_next double"
        return spark.createDataFrame([], schema)
    smallest, largest = ends[0], ends[1]
    bounds = sorted({b for b in ends[2] if smallest <= b < largest})  # a range ends with its bound
    at = F.lit(len(bounds))
    for i in range(0, len(bounds), 500):  # nested in steps, so that the expression stays shallow
        some = F.array(*(F.lit(b).cast("long") for b in bounds[i : i + 500]))
        at = at - F.size(F.filter(some, lambda b: b >= F.col("sort_id")))
    dealt = rows.withColumn("range", at)
    tops = F.array(*(F.lit(b).cast("long") for b in [*bounds, largest]))
    above = F.when(F.col("sort_id") == F.element_at(tops, F.col("range") + 1), F.pmod(F.col("range") + 1, F.lit(len(bounds) + 1)))
    copies = F.array_compact(F.array(F.struct(F.col("range"), F.lit(False).alias("ahead")), F.when(above.isNotNull(), F.struct(above.alias("range"), F.lit(True).alias("ahead")))))
    sent = dealt.select("doc_id", "sort_id", "text", F.explode(copies).alias("to")).select("doc_id", "sort_id", "text", "to.range", "to.ahead")
    order = ["range", "ahead", F.desc("sort_id"), "text"]
    sorted_ = sent.repartitionById(len(bounds) + 1, F.col("range")).sortWithinPartitions(*order).select("doc_id", "text", "range", "ahead")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # one row of the range, waiting for the next

        def pairs() -> Iterator[tuple]:
            for batch in batches:
                for piece in slices(batch):
                    for row in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "text", "range", "ahead")), strict=True):
                        if held and held[0][2] == row[2]:
                            yield held.pop(), row
                        held[:] = [] if row[3] else [row]
                        # the first row ahead closes its range; further ones of the same id are not needed

        def flush(some: list[tuple]) -> pa.RecordBatch:
            own, after = [a[1] for a, _ in some], [b[1] for _, b in some]
            edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(own, after, strict=True)]
            a, e, n = (simhash(pa.array(x, pa.large_string())) for x in (own, edited, after))
            halves = {}
            for name, fps in (("", a), ("edited_", e)):
                halves[f"{name}low"], halves[f"{name}high"] = (np.ascontiguousarray(fps[:, k]).view(np.int64) for k in (0, 1))
            return out_batch(doc_id=pa.array([x[0] for x, _ in some], pa.int64()), n_chars=np.array([len(t) for t in own], np.int64), edited_sha256=pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), **halves, near_edited=likeness(a, e), near_next=likeness(a, n))

        waiting, size = [], 0
        for pair in pairs():
            waiting.append(pair)
            size += len(pair[0][1])
            if size > 500_000:
                yield flush(waiting)
                waiting, size = [], 0
        if waiting:
            yield flush(waiting)

    return sorted_.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, low long, high long, edited_low long, edited_high long, near_edited double, near_next double")


def close_fingerprints(queries: DataFrame, fps: DataFrame, radius: int = 3, blocks: int = 6, kept: int | None = None) -> DataFrame:
    """Distinct fingerprints ``low_b``, ``high_b`` of ``fps`` at most ``radius`` bits from each distinct ``low``, ``high`` of
    ``queries``, with their ``distance``; an equal one is at distance 0.

    There are as many tables as ways to pick ``kept`` of the ``blocks`` blocks (default: all but ``radius``); a table's key
    is the picked blocks' bits. A pair that agrees in several tables is kept in the first of them.
    """
    kept = blocks - radius if kept is None else kept
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = []
    for picked in combinations(range(blocks), kept):
        mask = sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in picked)
        masks.append((mask & (2**64 - 1), mask >> 64))
    signed = lambda x: x - 2**64 if x >= 2**63 else x

    def keyed(df: DataFrame) -> DataFrame:
        tables = F.array(*(F.struct(F.lit(t).alias("table"), F.col("low").bitwiseAND(F.lit(signed(lo))).alias("k1"), F.col("high").bitwiseAND(F.lit(signed(hi))).alias("k2")) for t, (lo, hi) in enumerate(masks)))
        return df.select("low", "high").distinct().select("low", "high", F.inline(tables))

    a, b = keyed(queries), keyed(fps).withColumnsRenamed({"low": "low_b", "high": "high_b"})
    x, y = F.col("low").bitwiseXOR(F.col("low_b")), F.col("high").bitwiseXOR(F.col("high_b"))
    first = F.coalesce(*(F.when((x.bitwiseAND(F.lit(signed(lo))) == 0) & (y.bitwiseAND(F.lit(signed(hi))) == 0), t) for t, (lo, hi) in enumerate(masks)))
    apart = F.bit_count(x) + F.bit_count(y)
    return a.join(b, ["table", "k1", "k2"]).where((apart <= radius) & (F.col("table") == first)).select("low", "high", "low_b", "high_b", apart.alias("distance"))


def within(queries: DataFrame, fps: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """All pairs ``query_id``, ``doc_id``, ``distance`` with fingerprints at most ``radius`` bits apart, a row with itself left out.

    Both tables have columns doc_id, low and high. Rows with a null id are left out; copies of one fingerprint are looked
    up once.
    """
    near = close_fingerprints(queries.where("doc_id is not null"), fps.where("doc_id is not null"), radius, blocks)
    asked = queries.where("doc_id is not null").select(F.col("doc_id").alias("query_id"), "low", "high")
    other = fps.where("doc_id is not null").select("doc_id", F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    return asked.join(near, ["low", "high"]).join(other, ["low_b", "high_b"]).where("query_id <> doc_id").select("query_id", "doc_id", "distance")


def count_within(queries: DataFrame, fps: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """``low``, ``high`` and ``n_near`` for each distinct fingerprint of ``queries``: how many rows of ``fps`` lie within
    ``radius`` of it, but for one that has it itself. Copies are counted, not listed; rows with a null id do not count."""
    groups = materialise(fps.where("doc_id is not null").groupBy("low", "high").agg(F.count(F.lit(1)).alias("n")), "fingerprint-counts", fps.count())
    near = close_fingerprints(queries.where("doc_id is not null"), groups, radius, blocks).join(groups.select(F.col("low").alias("low_b"), F.col("high").alias("high_b"), "n"), ["low_b", "high_b"])
    return near.groupBy("low", "high").agg((F.sum("n") - 1).alias("n_near"))
