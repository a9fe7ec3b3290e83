"""Token ids of documents in sharded raw payloads with a minimal perfect hash index over the document keys.

Documents are range-partitioned and sorted by key, so shards hold ascending key ranges, and a part is what one task
wrote. A shard is a row of a Parquet table: the raw little-endian ids of its documents one after the other, and an index
over its keys. The index is a minimal perfect hash: keys fall into small buckets, each bucket has the first pilot that
sends its keys to free slots, and each slot stores a fingerprint of its key beside which documents of the shard have it.
A key is found with one bucket, one slot and one comparison; a key that was never stored is refused by its fingerprint
but for one in 2^32.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.common import materialise, out_batch, slices, texts
from cohortry.llm.wordhash import mix

#: Ids a shard takes before the next begins; a longer document fills a shard of its own.
SHARD_IDS = 2_000_000
#: Keys a bucket holds on average. Smaller buckets need more pilots, larger ones longer searches.
BUCKET_KEYS = 4
#: Distinct chunks a task remembers before it starts afresh; it bounds the memory of a Python worker.
MEMORY_CHUNKS = 1_200_000

#: Key under which rows without a key are stored; reading gives null for it.
NO_KEY = -(2**63)

#: ``keys`` has the distinct keys in order, ``ends`` where each document's ids end; a slot has a key's first document and the one after its last.
SHARD_SCHEMA = "part int, shard int, before long, n_ids long, n_keys int, first_key long, last_key long, id_bytes int, payload binary, pilots binary, slot_prints binary, slot_firsts binary, slot_lasts binary, keys binary, ends binary"
#: Keys that are looked up at a time: so many go to every task that reads a part of the store.
LOOKUP_KEYS = 1_000_000


def _key_hashes(keys: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _slots(hashes: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    return (mix(hashes ^ (pilots.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)) % np.uint64(max(n, 1))).astype(np.int64)


def _buckets(hashes: np.ndarray, n: int) -> np.ndarray:
    return (hashes % np.uint64(n // BUCKET_KEYS + 1)).astype(np.int64)


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pilots of the buckets and each key's slot in 0..n-1; ``keys`` must be distinct. Large buckets are placed first."""
    n, hashes = len(keys), _key_hashes(keys)
    buckets = _buckets(hashes, n)
    order = np.argsort(buckets, kind="stable")
    edges = np.searchsorted(buckets[order], np.arange(n // BUCKET_KEYS + 2))
    pilots, slots, taken = np.zeros(n // BUCKET_KEYS + 1, np.uint32), np.zeros(n, np.int64), np.zeros(n, bool)
    for b in np.argsort(-np.diff(edges), kind="stable"):
        mine = order[edges[b] : edges[b + 1]]
        if not len(mine):
            break
        tried = 0
        while True:
            some = np.arange(tried, tried + 64 if tried < 64 else tried * 2)
            at = _slots(hashes[mine][:, None], some[None, :], n)
            good = ~taken[at].any(axis=0)
            if len(mine) > 1:
                ranked = np.sort(at, axis=0)
                good &= (ranked[1:] != ranked[:-1]).all(axis=0)
            if good.any():
                k = int(np.flatnonzero(good)[0])
                pilots[b], slots[mine] = some[k], at[:, k]
                taken[at[:, k]] = True
                break
            tried = int(some[-1]) + 1
    return pilots, slots


def find(shard: dict, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each key is stored in the shard, its first document there and the one after its last."""
    n, hashes = shard["n_keys"], _key_hashes(keys)
    pilots = np.frombuffer(shard["pilots"], np.uint32)
    slots = _slots(hashes, pilots[_buckets(hashes, n)], n)
    known = np.frombuffer(shard["slot_prints"], np.uint32)[slots] == (hashes >> np.uint64(32)).astype(np.uint32)
    return known, np.frombuffer(shard["slot_firsts"], np.int32)[slots], np.frombuffer(shard["slot_lasts"], np.int32)[slots]


def documents_of(shard: dict, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all documents in the shard that have one of ``keys``: key, and where the ids begin and end."""
    known, firsts, lasts = find(shard, keys)
    counts = (lasts - firsts)[known]
    at = np.repeat(firsts[known] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    ends = np.frombuffer(shard["ends"], np.int64)
    return np.repeat(keys[known], counts), np.concatenate([[0], ends])[at], ends[at]


#: Marks that end a word of letters; not the apostrophe, which can begin a pre-token with letters.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: What a text has that is encoded whole: spaces or line feeds in a row or at an end, or other blanks.
WHOLE = "\\A[ \\n]|[ \\n][ \\n]|[ \\n]\\z|[\\t\\x0b-\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
#: Bytes of text whose chunks are told apart at a time; the more, the fewer are looked up twice.
CHUNKS_SLICE = 8_000_000


class ChunkEncoder(dict):
    """Ids of whole texts, with each distinct chunk encoded by the tokenizers library once and remembered.

    A byte-level BPE never merges over a blank that stands alone between two other characters: the blank opens the next
    token. Cutting a text before each such space or line feed therefore leaves its ids as they are, and so does cutting
    marks off the end of a word of letters. A word of letters is one pre-token, so the library's model takes it as it
    is. Texts with two blanks in a row, with other blanks than spaces and line feeds, or with the name of a token that
    the file adds to its vocabulary, are encoded whole.

    As a dictionary it maps a chunk, as it follows a space or with the line feed that it follows, to its ids' bytes.
    """

    def __init__(self, definition: str, dtype: type):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer = Tokenizer.from_str(definition)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.dtype, self.code = self.tokenizer.model, np.dtype(dtype), "H" if np.dtype(dtype).itemsize == 2 else "I"
        named = ByteLevel(add_prefix_space=False, use_regex=False)
        letters: dict[int, str] = {}
        for point in [*range(0x800), *range(0x800, 0xD800, 0x40), *range(0xE000, 0x10000, 0x40), *range(0x10000, 0x110000, 0x1000)]:
            letters |= zip(chr(point).encode(), named.pre_tokenize_str(chr(point))[0][0], strict=True)
        self.letters, self.space = "".join(letters.get(b, "\0") for b in range(256)), letters[32]

    def ids(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters_ids(self, word: str, lead: str) -> bytes:
        name = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(lead + name)]).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isalpha():
            found = self.letters_ids(chunk, self.space)
        else:
            fed = chunk[:1] == "\n"
            body = chunk.rstrip(MARKS)
            word = body[1:] if fed else body
            if word.isalpha():
                found = self.bare("\n") + self.bare(word) if fed else self[word]
                if len(body) < len(chunk):
                    found += self.bare(chunk[len(body) :])
            else:
                found = self.ids(chunk if fed else " " + chunk)
        self[chunk] = found
        return found

    def bare(self, start: str) -> bytes:
        """Ids of marks or of a text's or line's first chunk, which follow no space; kept under a name that no chunk has."""
        name = " " + start
        if name not in self:
            self[name] = self.letters_ids(start, "") if start.isalpha() else self.ids(start)
        return self[name]

    def encode(self, some: list[str]) -> list[bytes]:
        return self.encode_column(pa.array(some, pa.string()))

    def encode_column(self, column: pa.Array) -> list[bytes]:
        """Ids of every text. Each different chunk of the column is looked up once, and its ids are copied to where it stands."""
        whole = pc.match_substring_regex(column, WHOLE)
        for name in self.added:
            whole = pc.or_(whole, pc.match_substring(column, name))
        whole = whole.to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.replace_substring(column.filter(pa.array(~whole)), "\n", " \n"), " ")
        edges, heads = lists.offsets.to_numpy().astype(np.int64), iter(())
        if len(lists):
            heads = iter(lists.values.take(pa.array(edges[:-1])).to_pylist())
            follows = np.ones(len(lists.values), bool)
            follows[edges[:-1]] = False
            coded = lists.values.filter(pa.array(follows)).dictionary_encode()
            found, codes = list(map(self.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False))), coded.indices.to_numpy()
            sizes = np.array(list(map(len, found)), np.int64) // self.dtype.itemsize
            begins, many = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
            ends = np.concatenate([[0], np.cumsum(many)])
            ids = np.frombuffer(b"".join(found), self.dtype)[np.repeat(begins - ends[:-1], many) + np.arange(ends[-1])]
            edges = ends[edges - np.arange(len(edges))].tolist()
        out, k = [], 0
        for i, is_whole in enumerate(whole.tolist()):
            if is_whole:
                out.append(self.ids(column[i].as_py()))
            else:
                head = next(heads)
                out.append((self.bare(head) if head else b"") + ids[edges[k] : edges[k + 1]].tobytes())
                k += 1
        if len(self) > MEMORY_CHUNKS:
            self.clear()
        return out


#: Encoders of this Python worker, kept from task to task.
_ENCODERS: dict[tuple[str, type], ChunkEncoder] = {}


def byte_bpe(path: str, dtype: type = np.uint16) -> Callable[[], Callable[[pa.Array], list[bytes]]]:
    """A factory, called in each task, of the encoder for a byte-level BPE file. Only the driver reads the file."""
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    name = hashlib.sha256(definition.encode()).hexdigest()

    def make() -> Callable[[pa.Array], list[bytes]]:
        if (name, dtype) not in _ENCODERS:
            _ENCODERS[name, dtype] = ChunkEncoder(definition, dtype)
        return _ENCODERS[name, dtype].encode_column

    return make


def _shard(part: int, shard: int, before: int, keys: list[int], sizes: list[int], payload: list[bytes], dtype: type) -> pa.RecordBatch:
    ends = np.cumsum(np.array(sizes, np.int64))
    keys, firsts = np.unique(np.array(keys, np.int64), return_index=True)
    lasts = np.append(firsts[1:], len(ends))
    pilots, slots = build_index(keys)
    prints, slot_firsts, slot_lasts = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.int32), np.zeros(len(keys), np.int32)
    prints[slots] = (_key_hashes(keys) >> np.uint64(32)).astype(np.uint32)
    slot_firsts[slots], slot_lasts[slots] = firsts, lasts
    i32, i64, raw = pa.int32(), pa.int64(), pa.binary()
    values = [(part, i32), (shard, i32), (before, i64), (int(ends[-1]), i64), (len(keys), i32), (int(keys[0]), i64), (int(keys[-1]), i64), (np.dtype(dtype).itemsize, i32), (b"".join(payload), raw)]
    values += [(a.tobytes(), raw) for a in (pilots, prints, slot_firsts, slot_lasts, keys, ends)]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values], names=[f.split()[0] for f in SHARD_SCHEMA.split(", ")])


def write(docs: DataFrame, folder: str, encoder: Callable[[], Callable[[pa.Array], list[bytes]]], vocabulary: int, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, parts: int | None = None) -> None:
    """Encode every text, append ``end_id`` and write the shards to ``folder`` in ascending order of keys, a folder for each part.

    Ids take two bytes if the vocabulary allows, else four. A null or empty text has the end id alone. Every row is a
    document of its own. Rows of one key follow one another, in an order that depends on their texts alone, and can fill
    several shards and parts, so a crowded key burdens no task. Rows without a key come first; they can be read but not
    looked up. An empty table writes no shard. Further columns are left behind.
    """
    dtype = np.uint16 if vocabulary <= 2**16 else np.uint32
    end = np.array([end_id], dtype).tobytes()
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(), TaskContext.get().partitionId()
        shard = before = held = 0
        keys, sizes, payload = [], [], []
        for batch in batches:
            for piece in slices(batch, limit=CHUNKS_SLICE):
                for key, ids in zip(piece.column("doc_id").to_pylist(), encode(piece.column("text")), strict=True):
                    n = len(ids) // np.dtype(dtype).itemsize + 1
                    if keys and held + n > SHARD_IDS:
                        yield _shard(part, shard, before, keys, sizes, payload, dtype)
                        shard, before, held = shard + 1, before + held, 0
                        keys, sizes, payload = [], [], []
                    keys.append(key)
                    sizes.append(n)
                    payload.append(ids + end)
                    held += n
        if keys:
            yield _shard(part, shard, before, keys, sizes, payload, dtype)

    rows = texts(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_KEY))).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    ordered.mapInArrow(run, SHARD_SCHEMA).write.partitionBy("part").parquet(folder)


@dataclass(frozen=True)
class Store:
    """A folder's shards, and of each part in order: number, first and last key, and the number of ids in all earlier parts."""

    shards: DataFrame
    parts: tuple[tuple[int, int, int, int], ...]


def open_store(spark: SparkSession, folder: str) -> Store:
    """The store in ``folder``. Only one row for each part, that is for each task that wrote, comes to the driver."""
    names = [f.split() for f in SHARD_SCHEMA.split(", ")]
    shards = spark.read.schema(", ".join(f"{n} {t}" for n, t in [*names[1:], names[0]])).parquet(folder)
    total, parts = 0, []
    for row in shards.groupBy("part").agg(F.sum("n_ids").alias("n"), F.min("first_key").alias("low"), F.max("last_key").alias("high")).orderBy("part").collect():
        parts.append((row.part, row.low, row.high, total))
        total += row.n
    return Store(shards, tuple(parts))


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_all(store: Store) -> DataFrame:
    """Every document of the store, each found by its shard's index: key, first id's place among all ids, number of ids and
    their unsigned CRC-32 as little-endian 32-bit integers. Payloads are read where they lie; nothing is shuffled."""
    bases = {part: base for part, _, _, base in store.parts}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = batch.slice(i, 1).to_pylist()[0]
                keys, starts, ends = documents_of(shard, np.frombuffer(shard["keys"], np.int64))
                ids = np.frombuffer(shard["payload"], np.uint16 if shard["id_bytes"] == 2 else np.uint32)
                crcs = np.array([zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(starts, ends, strict=True)], np.int64)
                yield out_batch(doc_id=pa.array(keys, mask=keys == NO_KEY), start=starts + shard["before"] + bases[shard["part"]], n_tokens=ends - starts, ids_crc32=crcs)

    return store.shards.mapInArrow(run, READ)


def lookup(store: Store, keys: DataFrame, key_col: str = "doc_id", at_once: int = LOOKUP_KEYS) -> DataFrame:
    """The documents of the wanted keys: ``doc_id``, ``start`` (place of the first id among all) and ``ids`` (array of long).

    Unknown and null keys give no row, repeated ones no more than one would; a key that several rows were stored under
    gives a row for each. The parts' key ranges, a few numbers each, route a key to its part, and the index of a shard
    finds it at once. Keys are taken in ranges of about ``at_once``; each range goes to the tasks that read the parts it needs,
    and no others are read. Payloads stay where they are.
    """
    wanted = keys.select(F.col(key_col).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    wanted = materialise(wanted, "wanted-keys")
    lows, highs = (np.array([p[k] for p in store.parts], np.int64) for k in (1, 2))
    numbers, bases = np.array([p[0] for p in store.parts], np.int32), {p[0]: p[3] for p in store.parts}
    found = "doc_id long, start long, ids array<long>"
    out = keys.sparkSession.createDataFrame([], found)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("doc_id").to_numpy()
            first, last = np.searchsorted(highs, key), np.searchsorted(lows, key, side="right")  # a crowded key can lie in several
            many = np.maximum(last - first, 0)
            at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
            yield out_batch(part=numbers[at], doc_id=np.repeat(key, many))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = batch.slice(i, 1).to_pylist()[0]
                asked = np.array(shard["asked"], np.int64)
                asked = asked[np.searchsorted(asked, shard["first_key"]) : np.searchsorted(asked, shard["last_key"], side="right")]
                got, starts, ends = documents_of(shard, asked)
                ids = np.frombuffer(shard["payload"], np.uint16 if shard["id_bytes"] == 2 else np.uint32)
                lists = pa.array([ids[a:b].astype(np.int64) for a, b in zip(starts, ends, strict=True)], pa.list_(pa.int64()))
                yield out_batch(doc_id=got, start=starts + shard["before"] + bases[shard["part"]], ids=lists)

    count = wanted.count()
    cuts = wanted.agg(F.percentile_approx("doc_id", [i / -(-count // at_once) for i in range(1, -(-count // at_once))], 10_000)).first()[0] if count > at_once else []
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        some = wanted.where(((F.col("doc_id") > low) if low is not None else F.lit(True)) & ((F.col("doc_id") <= high) if high is not None else F.lit(True)))
        asked = materialise(some.mapInArrow(route, "part int, doc_id long").groupBy("part").agg(F.sort_array(F.collect_list("doc_id")).alias("asked")), "asked-keys")
        needed = [r.part for r in asked.select("part").collect()]  # a row for each part at most
        if needed:
            shards = store.shards.where(F.col("part").isin(needed))
            out = out.unionByName(shards.join(F.broadcast(asked), "part").mapInArrow(run, found))
    return out
