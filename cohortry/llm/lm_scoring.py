"""Language-model scores of documents by prediction by partial matching over bytes.

The trie of contexts is counted once over all training texts: every run of ``order + 1`` bytes, text ends included, is counted
in the tasks and summed by Spark, and the shorter contexts follow by summing. It stays a table: blocks of documents send
the runs they hold to the parts of the trie that score them, and get the scores back. A byte's probability starts at the longest
known context; a byte not seen there costs an escape (method C: as likely as the number of different bytes seen) and is
looked for one byte shorter, without the bytes that the longer context has already ruled out (symbol exclusion). Below
the empty context all 256 byte values that are left are equally likely. The byte 0xFF, which UTF-8 never uses, ends a text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import materialise, offsets, out_batch, raw_bytes, slices, texts
from cohortry.llm.wordhash import word_hashes

END = 0xFF
#: Of a place in a table that holds no key.
EMPTY = np.uint64(2**64 - 1)


class Table:
    """Values of 64-bit keys in open addressing, looked up for whole arrays at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys, self.rows = np.full(1 << self.bits, EMPTY), np.zeros(1 << self.bits, np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        at = self._home(keys)
        while len(left):
            free = self.keys[at] == EMPTY
            _, first = np.unique(at[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.keys[at[won]], self.rows[at[won]] = keys[left[won]], left[won]
            stay = np.ones(len(left), bool)
            stay[won] = False
            left, at = left[stay], (at[stay] + 1) & ((1 << self.bits) - 1)
        self.values = values

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 for none."""
        out, left, at = np.full(len(keys), -1, np.int64), np.arange(len(keys)), self._home(keys)
        while len(left):
            held = self.keys[at]
            hit = held == keys[left]
            out[left[hit]] = self.rows[at[hit]]
            on = ~hit & (held != EMPTY)
            left, at = left[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out


@dataclass(frozen=True)
class Model:
    """The trie as tables, longest contexts first.

    Rows of ``nodes``: log10 of the count, and log10 probability with nothing ruled out. Rows of ``contexts``: log10 of an
    escape, with nothing ruled out; then what holds one byte shorter once this context's bytes are ruled out: log10 of
    the denominator and of an escape; and how many different bytes were seen.
    """

    order: int
    nodes: list[Table]
    contexts: list[Table]

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each run of ``order + 1`` bytes after the others."""
        out, cost = np.zeros(len(grams)), np.zeros(len(grams))
        live, ruled = np.arange(len(grams)), np.full(len(grams), -1, np.int64)
        above = None  # values of the next longer contexts
        for level, (nodes, contexts) in enumerate(zip(self.nodes, self.contexts, strict=True)):
            keys = grams[live] & np.uint64(2 ** (8 * (self.order - level + 1)) - 1)
            row = nodes.find(keys)
            found, by = row >= 0, ruled[live]
            got, got_by = row[found], by[found]
            value = nodes.values[1][got]
            if above is not None:
                value = np.where(got_by >= 0, nodes.values[0][got] - above[1][np.maximum(got_by, 0)], value)
            out[live[found]] = cost[live[found]] + value
            live, keys, by = live[~found], keys[~found], by[~found]
            if not len(live):
                return out
            context = contexts.find(keys >> np.uint64(8))
            known = context >= 0
            step = contexts.values[0][context[known]]
            if above is not None:
                step = np.where(by[known] >= 0, above[2][np.maximum(by[known], 0)], step)
            cost[live[known]] += step
            ruled[live[known]] = context[known]
            above = contexts.values if contexts.values.shape[1] else None
        seen = np.where(ruled[live] >= 0, above[3][np.maximum(ruled[live], 0)], 0) if above is not None else np.zeros(len(live))
        out[live] = cost[live] - np.log10(256 - seen)
        return out


def _log(x: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(x, 1e-300))


def build(levels: dict[int, tuple[np.ndarray, np.ndarray]], order: int) -> Model:
    """The model of counted runs: ``levels[size]`` holds, sorted, the runs of ``size`` context bytes and one more, and counts.

    A context comes with all its bytes, and with all its shorter contexts.
    """
    sums = {}
    for size, (keys, n) in levels.items():
        names, at = np.unique(keys >> np.uint64(8), return_inverse=True)
        sums[size] = (names, np.bincount(at, n, len(names)), np.bincount(at, minlength=len(names)).astype(float), at)
    nodes, contexts = [], []
    for size in range(order, -1, -1):
        keys, n = levels[size]
        names, total, kinds, at = sums[size]
        rest = rest_kinds = np.zeros(len(names))
        if size and len(names):
            short_keys, short_n = levels[size - 1]
            short_names, short_total, short_kinds, _ = sums[size - 1]
            mass = np.bincount(at, short_n[np.searchsorted(short_keys, keys & np.uint64(2 ** (8 * size) - 1))], len(names))
            parent = np.searchsorted(short_names, names & np.uint64(2 ** (8 * (size - 1)) - 1))
            rest, rest_kinds = short_total[parent] - mass, short_kinds[parent] - kinds
        whole = _log(total + kinds)
        escape = np.where(rest_kinds > 0, _log(rest_kinds) - _log(rest + rest_kinds), 0.0)
        nodes.append(Table(keys, np.stack([_log(n), _log(n) - whole[at]])))
        contexts.append(Table(names, np.stack([_log(kinds) - whole, _log(rest + rest_kinds), escape, kinds])))
    return Model(order, nodes, contexts)


def runs(column: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Every run of ``order + 1`` bytes of each text with its end, ends standing before the beginning, and where texts begin."""
    ends, data = offsets(column), raw_bytes(column)
    n = len(ends) - 1
    first = ends + np.arange(n + 1)  # with an end after each text
    padded = np.full(int(first[-1]), END, np.uint8)
    keep = np.ones(len(padded), bool)
    keep[first[1:] - 1] = False
    padded[keep] = data
    grams = padded.astype(np.uint64)
    place = np.arange(len(padded)) - np.repeat(first[:-1], np.diff(first))
    for back in range(1, order + 1):
        earlier = np.full(len(padded), END, np.uint64)
        inside = place >= back
        earlier[inside] = padded[np.flatnonzero(inside) - back]
        grams |= earlier << np.uint64(8 * back)
    return grams, first


def count_runs(docs: DataFrame, order: int) -> DataFrame:
    """``gram`` and ``n``: how often each run of ``order + 1`` bytes occurs in ``docs`` (columns doc_id and text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums, fresh = np.zeros(0, np.uint64), np.zeros(0, np.int64), []

        def merge() -> None:
            nonlocal held, sums, fresh
            keys, at = np.unique(np.concatenate([held, *(f[0] for f in fresh)]), return_inverse=True)
            sums = np.bincount(at, np.concatenate([sums, *(f[1] for f in fresh)]), len(keys)).astype(np.int64)
            held, fresh = keys, []

        for batch in batches:
            for piece in slices(batch, limit=500_000):
                fresh.append(np.unique(runs(piece.column("text"), order)[0], return_counts=True))
                if sum(len(f[0]) for f in fresh) > 1_000_000:
                    merge()
        if fresh:
            merge()
        for start in range(0, len(held), 100_000):
            yield out_batch(gram=held[start : start + 100_000].view(np.int64), n=sums[start : start + 100_000])

    return docs.select("doc_id", "text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def shorten(keys: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs ``keys`` cut to ``size`` context bytes and one more, sorted, and the sums of their counts."""
    names, at = np.unique(keys & np.uint64(2 ** (8 * (size + 1)) - 1), return_inverse=True)
    return names, np.bincount(at, n, len(names)).astype(np.int64)


def model_of(keys: np.ndarray, n: np.ndarray, order: int, base: dict[int, tuple[np.ndarray, np.ndarray]] | None = None) -> Model:
    """The model of runs of ``order + 1`` bytes and their counts; levels in ``base`` are taken from there instead."""
    return build({size: shorten(keys, n, size) for size in range(order + 1)} | (base or {}), order)


def family_model(keys: np.ndarray, n: np.ndarray, sizes: np.ndarray, order: int, base: dict[int, tuple[np.ndarray, np.ndarray]], large: np.ndarray) -> Model:
    """The model of a bucket: runs of ``order`` context bytes and one more, and, where ``sizes`` says so, of ``FAMILY_BYTES`` for
    the large families that other buckets have a share in."""
    whole = sizes == order
    runs, counts = keys[whole], n[whole]
    alone = ~large[(runs >> np.uint64(8) & np.uint64(0xFFFF)).astype(np.int64)]
    names, sums = shorten(runs[alone], counts[alone], FAMILY_BYTES)
    names, sums = np.append(names, keys[~whole]), np.append(sums, n[~whole])
    by = np.argsort(names)
    return model_of(runs, counts, order, base | {FAMILY_BYTES: (names[by], sums[by])})


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 4) -> DataFrame:
    """The trie of all texts of ``docs`` as a table in the shared folder: ``gram``, ``n`` for each run of ``order + 1`` bytes.

    Shorter contexts are sums over longer ones and are not stored. The table grows with the corpus and is never cut.
    Null texts count as empty; an empty table gives no rows, which is the uniform model.
    """
    return materialise(count_runs(texts(docs, id_col, text_col), order), "runs")


#: Context bytes that a family of runs shares. Contexts shorter than that fit 256 + 65,536 nodes, whatever the corpus.
FAMILY_BYTES = 2
#: Runs in one row of a request, and rows that are scored at a time.
ROW_RUNS, ROWS_AT_ONCE = 1024, 256


def bucket_of(context: np.ndarray, large: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each context's family, which takes in one more byte where ``large`` has it (the same sums as ``BUCKET_SQL``)."""
    short = context & np.uint64(0xFFFF)
    family = np.where(large[short.astype(np.int64)], context & np.uint64(0xFFFFFF) | np.uint64(1 << 24), short).astype(np.int64)
    return ((family * 2654435761 & 0xFFFFFFFF) * buckets >> 32).astype(np.int32)


BUCKET_SQL = "cast(shiftright((if(large, context & 16777215 | 16777216, context & 65535) * 2654435761 & 4294967295) * {buckets}, 32) as int)"


def score(docs: DataFrame, trie: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 4, block_bytes: int = 16_000_000, bucket_runs: int = 200_000, blocks_a_copy: int = 16_384) -> DataFrame:
    """``doc_id`` and ``score``: log10 probability of each text's bytes and its end, by the table that ``train`` gives.

    No task holds the whole trie. Documents are dealt into blocks of about ``block_bytes``, and each block asks once for
    every different run it has. Runs whose contexts end in the same two bytes are a family: all their contexts of two
    bytes and more are theirs alone, so a bucket of families (about ``bucket_runs`` runs of the trie) scores what is asked
    of it with its own part of the trie and the few shortest contexts, which every task has. A family of more than
    ``bucket_runs`` runs is split by one more byte, and each of its parts is handed the sums for the context of two bytes that
    they share; of order 4 such a part has at most 65,536 runs, whatever the corpus. Within a partition a bucket's runs
    come first, then its requests, in a stream. With many blocks a bucket is dealt out in copies, one for every
    ``blocks_a_copy`` blocks. The scores then meet their block's documents. Null texts count as empty, repeated rows stay repeated,
    null ids stay null; an empty table gives no rows.
    """
    if order <= FAMILY_BYTES:
        raise ValueError(f"order must be more than {FAMILY_BYTES}")
    rows = texts(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = 1 + total // block_bytes, min(2**24, 1 + trie.count() // bucket_runs)
    copies = -(-blocks // blocks_a_copy)
    short = trie.groupBy(F.expr("gram & 65535").alias("gram")).agg(F.sum("n").alias("n")).toArrow()  # 65,536 rows at most
    keys, n = (short.column(c).to_numpy().astype(np.int64) for c in ("gram", "n"))
    base = {size: shorten(keys.view(np.uint64), n, size) for size in range(FAMILY_BYTES)}
    family = F.expr("shiftright(gram, 8) & 65535").cast("int")
    crowded = trie.groupBy(family.alias("family")).agg(F.count(F.lit(1)).alias("runs")).where(F.col("runs") > bucket_runs).select("family", F.lit(True).alias("large"))
    crowded = materialise(crowded, "large-families", 2**16)  # 65,536 rows at most
    large = np.zeros(2**16, bool)
    large[crowded.toArrow().column("family").to_numpy()] = True
    shared = docs.sparkSession.sparkContext.broadcast((base, large))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")).repartition("block")

    def ask(block: pa.Table) -> pa.Table:
        own = np.zeros(0, np.uint64)
        for batch in block.select(["text"]).to_batches():
            for piece in slices(batch, limit=500_000):
                own = np.union1d(own, runs(piece.column("text"), order)[0])
        bucket = bucket_of(own >> np.uint64(8), shared.value[1], buckets)
        by = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[by], prepend=-1, append=-1))
        cuts = [(a, min(a + ROW_RUNS, e)) for s, e in zip(edges, edges[1:], strict=False) for a in range(s, e, ROW_RUNS)]
        number = block.column("block")[0].as_py()
        held = pa.array([own[by[a:e]].tobytes() for a, e in cuts], pa.binary())
        asked = out_batch(
            bucket=bucket[by[[a for a, _ in cuts]]], copy=np.full(len(cuts), number % copies, np.int32), block=np.full(len(cuts), number, np.int32),
            bytes=pa.nulls(len(cuts), pa.int32()), gram=pa.nulls(len(cuts), pa.int64()), n=pa.nulls(len(cuts), pa.int64()), grams=held,
        )
        return pa.Table.from_batches([asked])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, counts, sizes, model = None, [], [], [], None
        for batch in batches:
            cell = batch.column("bucket").to_numpy().astype(np.int64) << 32 | batch.column("copy").to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, cell[1:] != cell[:-1])), len(cell)) if len(cell) else []
            for start, stop in zip(edges, edges[1:], strict=False):
                if cell[start] != at:
                    at, keys, counts, sizes, model = cell[start], [], [], [], None
                span = batch.slice(start, stop - start)
                known = span.num_rows - span.column("gram").null_count  # the trie's rows come before the requests
                keys.append(span.column("gram").slice(0, known).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
                counts.append(span.column("n").slice(0, known).to_numpy(zero_copy_only=False).astype(np.int64))
                sizes.append(span.column("bytes").slice(0, known).to_numpy(zero_copy_only=False).astype(np.int64))
                for first in range(known, span.num_rows, ROWS_AT_ONCE):
                    model = model or family_model(*map(np.concatenate, (keys, counts, sizes)), order, *shared.value)
                    some = span.slice(first, ROWS_AT_ONCE)
                    grams = [np.frombuffer(x, np.uint64) for x in some.column("grams").to_pylist()]
                    found = np.split(model.log10(np.concatenate(grams)), np.cumsum([len(g) for g in grams])[:-1])
                    yield out_batch(block=some.column("block"), grams=some.column("grams"), logs=pa.array([x.tobytes() for x in found], pa.binary()))

    def add_up(block: pa.Table, answers: pa.Table) -> pa.Table:
        grams, logs = (np.frombuffer(b"".join(answers.column(c).to_pylist()), kind) for c, kind in (("grams", np.uint64), ("logs", np.float64)))
        table, out = Table(grams, logs), []
        for batch in block.select(["doc_id", "text"]).to_batches():
            for piece in slices(batch, limit=500_000):
                asked, first = runs(piece.column("text"), order)
                row = table.find(asked)
                if len(row) and row.min() < 0:
                    raise RuntimeError("a run of this block has no answer")
                out.append(out_batch(doc_id=piece.column("doc_id"), score=np.add.reduceat(logs[row], first[:-1])))
        return pa.Table.from_batches(out, pa.schema([("doc_id", pa.int64()), ("score", pa.float64())]))

    asked = dealt.groupBy("block").applyInArrow(ask, "bucket int, copy int, block int, bytes int, gram long, n long, grams binary")
    placed = trie.withColumn("family", family).join(F.broadcast(crowded), "family", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    bucket = F.expr(BUCKET_SQL.format(buckets=buckets)).alias("bucket")
    placed = placed.withColumn("context", F.expr("shiftright(gram, 8)")).select("family", "large", bucket, "gram", "n")
    # the sums for a large family's own context go to every bucket that can be asked for some of it: 256 rows at most for each of 256 parts
    sums = placed.where("large").groupBy(F.expr("gram & 16777215").alias("gram"), "family").agg(F.sum("n").alias("n"))
    parts = crowded.select("family", "large", F.explode(F.sequence(F.lit(0), F.lit(255))).alias("byte")).withColumn("context", F.expr("cast(byte * 65536 + family as bigint)"))
    spread = parts.select("family", bucket).distinct().join(sums, "family").select("bucket", F.lit(FAMILY_BYTES).alias("bytes"), "gram", "n")
    known = placed.select("bucket", F.lit(order).alias("bytes"), "gram", "n").unionByName(spread).select(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"),
        F.lit(None).cast("int").alias("block"), "bytes", "gram", "n", F.lit(None).cast("binary").alias("grams"),
    )
    stream = known.unionByName(asked).repartition("bucket", "copy").sortWithinPartitions("bucket", "copy", F.col("gram").isNull())
    answers = stream.mapInArrow(weigh, "block int, grams binary, logs binary")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add_up, "doc_id long, score double")


def adaptive(text: str, order: int = 4) -> float:
    """log10 probability of a text by a model that learns from the text itself as it goes, byte by byte."""
    seen: dict[bytes, dict[int, int]] = {}
    data, out = bytes([END] * order) + text.encode() + bytes([END]), 0.0
    for i in range(order, len(data)):
        ruled: set[int] = set()
        for size in range(order, -1, -1):
            here = {b: n for b, n in seen.get(data[i - size : i], {}).items() if b not in ruled}
            total = sum(here.values()) + len(here)
            if data[i] in here:
                out += math.log10(here[data[i]] / total)
                break
            if here:
                out += math.log10(len(here) / total)
                ruled |= here.keys()
        else:
            out -= math.log10(256 - len(ruled))
        for size in range(order + 1):
            own = seen.setdefault(data[i - size : i], {})
            own[data[i]] = own.get(data[i], 0) + 1
    return out


def word_base(docs: DataFrame, training: DataFrame, table_words: int = 2**20) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``: add-one unigram scores over words and ends.

    Both tables have columns doc_id and text. Words are cut at ASCII blanks, A-Z lower-cased, and known by a 64-bit hash;
    every text ends with one end. The counts of at most ``table_words`` frequent words go to every task; the other words
    of each document, each with its number, meet their counts in a join. Rows that share an id are added up.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                keys, n = np.unique(word_hashes(piece.column("text"), keep_punctuation=True)[0], return_counts=True)
                yield out_batch(word=np.append(keys, np.uint64(0)).view(np.int64), n=np.append(n, piece.num_rows).astype(np.int64))

    counts = materialise(training.select("doc_id", "text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n_all, least = totals[0], -math.log10(totals[0] + totals[1] + 1)
    sizes = {r.log: r.k for r in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("log")).agg(F.count(F.lit(1)).alias("k")).collect()}
    low, room = 0, table_words - sum(sizes.values())
    while room < 0:
        room += sizes.get(low, 0)
        low += 1
    got = counts.where(f"n >= {2**low} or word = 0").toArrow()
    frequent = Table(got.column("word").to_numpy().astype(np.int64).view(np.uint64), got.column("n").to_numpy().astype(np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    schema = "doc_id long, word long, n_tokens long, n_known long, base_score double"

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for piece in slices(batch):
                hashes, first, *_ = word_hashes(piece.column("text"), keep_punctuation=True)
                rows, of = piece.num_rows, np.repeat(np.arange(piece.num_rows), np.diff(first))
                row = table.find(hashes)
                n = np.append(table.values, 0)[row]  # row -1 is the last
                end = table.find(np.zeros(1, np.uint64))
                end_n = int(table.values[end[0]]) if end[0] >= 0 else 0
                known = row >= 0
                gain = np.bincount(of, np.where(known, np.log10(n + 1) + least, 0.0), rows) + math.log10(end_n + 1) + least
                sure = np.bincount(of, known, rows).astype(np.int64)
                ids = piece.column("doc_id")
                yield out_batch(doc_id=ids, word=pa.nulls(rows, pa.int64()), n_tokens=np.diff(first) + 1, n_known=sure + (end_n > 0), base_score=gain)
                order = np.lexsort((hashes[~known], of[~known]))
                words, owner = hashes[~known][order], of[~known][order]
                new = np.flatnonzero(np.append(True, (words[1:] != words[:-1]) | (owner[1:] != owner[:-1]))) if len(words) else np.zeros(0, np.int64)
                times = np.diff(np.append(new, len(words)))
                yield out_batch(doc_id=ids.take(pa.array(owner[new])), word=words[new].view(np.int64), n_tokens=times.astype(np.int64), n_known=np.zeros(len(new), np.int64), base_score=np.zeros(len(new)))

    found = materialise(docs.select("doc_id", "text").mapInArrow(tally, schema), "word-tallies")
    rare = found.where("word is not null").join(counts.where(f"n < {2**low}").withColumnRenamed("n", "c"), "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    own = rare.select("doc_id", F.lit(0).cast("long").alias("n_tokens"), F.when(F.col("c") > 0, F.col("n_tokens")).otherwise(0).alias("n_known"), (F.col("n_tokens") * (F.log10(F.col("c") + 1) + least)).alias("base_score"))
    both = found.where("word is null").drop("word").unionByName(own)
    summed = both.groupBy("doc_id").agg(*(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score")))
    return summed.withColumn("train_tokens", F.lit(int(n_all)).cast("long"))


def score_all(docs: DataFrame, in_training, id_col: str = "doc_id", text_col: str = "text", order: int = 4) -> DataFrame:
    """Base and model scores of every document, learnt from the rows for which ``in_training`` (a condition on doc_id) holds.

    Columns: ``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``. A null or empty text is
    its end alone. Rows that share an id, null among them, are one document whose numbers add up. An empty table gives
    no rows; with no training rows every byte is as likely as any other. Further columns are left behind.
    """
    rows = texts(docs, id_col, text_col)
    training = rows.where(in_training)
    base = word_base(rows, training)
    scored = score(rows, train(training, order=order), order=order).groupBy("doc_id").agg(F.sum("score").alias("score"))
    return base.join(scored, base.doc_id.eqNullSafe(scored.doc_id)).drop(scored.doc_id)
