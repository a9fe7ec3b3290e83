"""Signal files (bigWig) as a Spark data source, pruned by the tree of places inside each file.

``spark.read.format("signals")`` gives one row for each interval. The tree is walked only where it can meet the region
asked for, and the nodes it comes to are dealt out to tasks, so neither the driver nor a task lists all blocks.
:func:`window_profile` reads windows the same way and sends sums for each offset, not bases.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from cohortry.operators import intervals
from cohortry.sources import remote
from cohortry.sources.by_region import FileWriter, RegionReader, load, register, tasks
from cohortry.sources.remote import Seekable

SCHEMA = "path string, chrom string, start long, end long, value double"
# fixed values of the format: marks at the start of the file, of its table of chromosomes and of its tree
FILE, TABLE, TREE = 0x888FFC26, 0x78CA8C91, 0x2468ACE0
#: Items of a block and children of a node that the writer makes.
ITEMS, CHILDREN = 512, 256
#: Positions of a tile whose windows are counted together, and window starts of a tile that are added up one by one.
TILE, FEW = 1 << 18, 32


@dataclass
class Layout:
    names: dict[int, str]
    lengths: dict[str, int]
    ids: dict[str, int]
    root: int
    packed: bool


def layout(file: Seekable) -> Layout:
    """Chromosomes and the place of the tree, from the head of the file."""
    mark, _, _, table, _, index, _, _, _, _, buffer, _ = struct.unpack("<IHHQQQHHQQIQ", file.read(0, 64))
    if mark != FILE:
        raise ValueError("not a signal file")
    mark, _, key, _, _, _ = struct.unpack("<IIIIQQ", file.read(table, 32))
    if mark != TABLE or struct.unpack("<I", file.read(index, 4))[0] != TREE:
        raise ValueError("the signal file's table or tree is damaged")
    names, lengths, nodes = {}, {}, [table + 32]
    while nodes:
        at = nodes.pop()
        leaf, _, n = struct.unpack("<BBH", file.read(at, 4))
        data = file.read(at + 4, n * (key + 8))
        for i in range(n):
            item = data[i * (key + 8) : (i + 1) * (key + 8)]
            if leaf:
                number, length = struct.unpack_from("<II", item, key)
                names[number] = item[:key].rstrip(b"\0").decode()
                lengths[names[number]] = length
            else:
                nodes.append(struct.unpack_from("<Q", item, key)[0])
    return Layout(names, lengths, {v: k for k, v in names.items()}, index + 48, buffer > 0)


Region = tuple[int, int, int]
NODE = np.dtype([("c0", "<u4"), ("b0", "<u4"), ("c1", "<u4"), ("b1", "<u4"), ("at", "<u8")])
LEAF = np.dtype([*NODE.descr, ("size", "<u8")])


def node(file: Seekable, at: int) -> tuple[bool, np.ndarray]:
    """Whether a node is a leaf, and its items."""
    leaf, _, n = struct.unpack("<BBH", file.read(at, 4))
    kind = LEAF if leaf else NODE
    return bool(leaf), np.frombuffer(file.read(at + 4, n * kind.itemsize), kind)


def meeting(items: np.ndarray, region: Region) -> np.ndarray:
    """The items of a node that can meet the region."""
    chrom, low, high = region
    after = (items["c1"] < chrom) | ((items["c1"] == chrom) & (items["b1"] <= low))
    before = (items["c0"] > chrom) | ((items["c0"] == chrom) & (items["b0"] >= high))
    return items[~(after | before)]


def children(file: Seekable, at: int, region: Region | None) -> tuple[bool, np.ndarray]:
    """Whether a node is a leaf, and its items that can meet the region."""
    leaf, items = node(file, at)
    return leaf, items if region is None else meeting(items, region)


def blocks(file: Seekable, nodes: Sequence[int], region: Region | None) -> Iterator[tuple[int, int]]:
    """Place and size of the blocks below some nodes that can meet the region, in order."""
    waiting = list(reversed(nodes))
    while waiting:
        leaf, items = children(file, waiting.pop(), region)
        if leaf:
            yield from zip(items["at"].tolist(), items["size"].tolist(), strict=True)
        else:
            waiting += reversed(items["at"].tolist())


def frontier(file: Seekable, root: int, region: Region | None, wanted: int) -> list[int]:
    """Nodes that together hold all that can meet the region: as many as are wanted, where the tree goes deep enough."""
    nodes, deeper = [root], True
    while deeper and len(nodes) < wanted:
        deeper, below = False, []
        for at in nodes:
            leaf, items = children(file, at, region)
            below += [at] if leaf and len(items) else items["at"].tolist() if not leaf else []
            deeper |= not leaf
        nodes = below
    return nodes


def section(data: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Chromosome, starts, ends and values of one block: intervals, places with a span, or a step."""
    chrom, start, _, step, span, kind, _, n = struct.unpack_from("<IIIIIBBH", data, 0)
    if kind == 1:
        items = np.frombuffer(data, np.dtype([("start", "<u4"), ("end", "<u4"), ("value", "<f4")]), n, 24)
        return chrom, items["start"].astype(np.int64), items["end"].astype(np.int64), items["value"].astype(float)
    if kind == 2:
        items = np.frombuffer(data, np.dtype([("start", "<u4"), ("value", "<f4")]), n, 24)
        starts = items["start"].astype(np.int64)
        return chrom, starts, starts + span, items["value"].astype(float)
    if kind == 3:
        starts = start + step * np.arange(n, dtype=np.int64)
        return chrom, starts, starts + span, np.frombuffer(data, "<f4", n, 24).astype(float)
    raise ValueError(f"unknown kind of block: {kind}")


def decoded(file: Seekable, place: tuple[int, int], packed: bool) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    data = file.read(*place)
    return section(zlib.decompress(data) if packed else data)


@dataclass
class Nodes(InputPartition):
    path: str
    nodes: list[int]

    def __post_init__(self):
        super().__init__((self.path, tuple(self.nodes)))


class SignalReader(RegionReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        super().__init__(SCHEMA, schema, options)

    def _region(self, form: Layout) -> Region | None:
        return None if self.chrom is None else (form.ids.get(self.chrom, (1 << 32) - 1), self.low, self.high)

    def partitions(self) -> list[InputPartition]:
        found: list[InputPartition] = []
        for path in remote.files(self.path, ".bw"):
            with remote.opened(path) as file:
                form = layout(file)
                wanted = -(-file.size // self.split)
                nodes = frontier(file, form.root, self._region(form), wanted)
                each = -(-len(nodes) // wanted) if nodes else 1
                found += [Nodes(path, nodes[i : i + each]) for i in range(0, len(nodes), each)]
        return found or [Nodes("", [])]

    def read(self, partition: Nodes) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        with remote.opened(partition.path) as file:
            form = layout(file)
            region = self._region(form)
            for place in blocks(file, partition.nodes, region):
                chrom, starts, ends, values = decoded(file, place, form.packed)
                if region is not None:
                    keep = (chrom == region[0]) & (starts < region[2]) & (ends > region[1])
                    starts, ends, values = starts[keep], ends[keep], values[keep]
                if len(starts):
                    make = {"path": lambda: pa.array([partition.path] * len(starts)), "chrom": lambda: pa.array([form.names[chrom]] * len(starts)), "start": lambda: pa.array(starts), "end": lambda: pa.array(ends), "value": lambda: pa.array(values)}  # noqa: B023
                    yield pa.RecordBatch.from_arrays([make[c]() for c in self.columns], names=self.columns)


def tree(places: list[tuple[int, int, int, int, int]], at: int, children: int = CHILDREN) -> bytes:
    """The tree over blocks (chromosome, start, end, place, size), which are in order, as it stands from byte ``at`` on."""
    head = struct.pack("<IIQIIIIQII", TREE, children, len(places), *((places[0][0], places[0][1], places[-1][0], max(p[2] for p in places if p[0] == places[-1][0])) if places else (0, 0, 0, 0)), at, 1, 0)
    rows = [[(c, s, c, e, place, size) for c, s, e, place, size in places[i : i + children]] for i in range(0, len(places), children)] or [[]]
    levels = [rows]
    bounds = lambda node: (*node[0][:2], *max((r[2], r[3]) for r in node))
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([[(*bounds(node), i + j) for j, node in enumerate(below[i : i + children])] for i in range(0, len(below), children)])
    levels.reverse()
    where, starts = at + len(head), []
    for depth, level in enumerate(levels):
        starts.append([])
        for node in level:
            starts[-1].append(where)
            where += 4 + len(node) * (32 if depth == len(levels) - 1 else 24)
    out = [head]
    for depth, level in enumerate(levels):
        leaf = depth == len(levels) - 1
        for node in level:
            out.append(struct.pack("<BBH", leaf, 0, len(node)))
            out += [struct.pack("<IIIIQQ", *r) if leaf else struct.pack("<IIIIQ", *r[:4], starts[depth + 1][r[4]]) for r in node]
    return b"".join(out)


class SignalWriter(FileWriter):
    """One file for each task, of intervals in order that do not overlap."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        super().__init__(options, overwrite)
        self.references = sorted(json.loads(options["references"]))
        self.items, self.children = int(options.get("itemsperblock", ITEMS)), int(options.get("children", CHILDREN))

    def write(self, rows: Iterator) -> WriterCommitMessage:
        ids = {name: i for i, (name, _) in enumerate(self.references)}
        key = max([1, *(len(n.encode()) for n in ids)])
        table = struct.pack("<IIIIQQ", TABLE, max(1, len(ids)), key, 8, len(ids), 0) + struct.pack("<BBH", 1, 0, len(ids))
        table += b"".join(n.encode().ljust(key, b"\0") + struct.pack("<II", ids[n], length) for n, length in self.references)
        data, places, base = [], [], 64 + 40 + len(table) + 8
        items: list[tuple[int, int, float]] = []
        last = (-1, 0)
        written, covered, low, high, total, squares, largest = base, 0, float("inf"), float("-inf"), 0.0, 0.0, 1

        def close() -> None:
            nonlocal written, largest
            if items:
                raw = struct.pack("<IIIIIBBH", last[0], items[0][0], items[-1][1], 0, 0, 1, 0, len(items)) + b"".join(struct.pack("<IIf", *i) for i in items)
                data.append(zlib.compress(raw))
                places.append((last[0], items[0][0], items[-1][1], written, len(data[-1])))
                written, largest = written + len(data[-1]), max(largest, len(raw))
                items.clear()

        for row in rows:
            place = (ids[row.chrom], row.start)
            if place < last:
                raise ValueError("intervals must be ordered by chromosome and start, and must not overlap")
            if place[0] != last[0] or len(items) >= self.items:
                close()
            items.append((row.start, row.end, row.value))
            last, width = (place[0], row.end), row.end - row.start
            covered, low, high, total, squares = covered + width, min(low, row.value), max(high, row.value), total + width * row.value, squares + width * row.value**2
        close()
        summary = struct.pack("<Qdddd", covered, low if covered else 0, high if covered else 0, total, squares)
        head = struct.pack("<IHHQQQHHQQIQ", FILE, 4, 0, 104, 104 + len(table), written, 0, 0, 0, 64, largest, 0)
        return self.put({".bw": b"".join([head, summary, table, struct.pack("<Q", len(places)), *data, tree(places, written, self.children)])})


class SignalSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "signals"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return SignalReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return SignalWriter(self.options, overwrite)


def read_signal(spark: SparkSession, path: str, columns: Sequence[str] = (), region: tuple[str, int, int] | None = None, split_bytes: int = 64 << 20) -> DataFrame:
    """Intervals of a file, or of all ``.bw`` files under a folder, whole where a region cuts through them."""
    return load(spark, SignalSource, SCHEMA, path, columns, region, split_bytes)


def write_signal(rows: DataFrame, path: str, references: Sequence[tuple[str, int]], mode: str = "append", files: int | None = None, items: int = ITEMS, children: int = CHILDREN) -> None:
    """chrom, start, end, value as files that each hold a range of the genome; overlapping intervals are an error.

    Each task writes one file, ``files`` in all where that is given, with so many ``items`` in a block and ``children`` of a node.
    """
    register(rows.sparkSession, SignalSource)
    ordered = rows.select("chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col("value").cast("double").alias("value"))
    ordered = ordered.repartitionByRange(*([files] if files else []), "chrom", "start").sortWithinPartitions("chrom", "start")
    ordered.write.format("signals").mode(mode).option("references", json.dumps([list(r) for r in references])).option("itemsPerBlock", items).option("children", children).save(path)


def chromosome_lengths(spark: SparkSession, path: str) -> DataFrame:
    """chrom and length over all files; files that disagree about one raise on use."""
    found = [(p,) for p in remote.files(path, ".bw")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("path").to_pylist():
                with remote.opened(name) as file:
                    lengths = layout(file).lengths
                yield pa.RecordBatch.from_arrays([pa.array(list(lengths), pa.string()), pa.array(list(lengths.values()), pa.int64())], names=["chrom", "length"])

    rows = spark.createDataFrame(found, "path string").repartition(max(1, len(found))).mapInArrow(run, "chrom string, length long")
    agreed = F.when(F.min("length") == F.max("length"), F.max("length")).otherwise(F.raise_error(F.concat(F.lit("files disagree about the length of "), F.first("chrom"))).cast("long"))
    return rows.groupBy("chrom").agg(agreed.alias("length"))


def correlated(counts: np.ndarray, signal: np.ndarray, width: int) -> np.ndarray:
    """For each offset below ``width``: the signal at that offset from every place, times the place's count, added up.

    ``signal`` is ``width`` - 1 places longer than ``counts``. Many places go through a Fourier transform, whose time does not
    depend on how many they are. Where signal and sums are whole numbers, so is the result, and exact; otherwise
    offsets that meet no signal are exactly 0.
    """
    places = np.flatnonzero(counts)
    with np.errstate(over="ignore"):
        size = float(np.linalg.norm(counts) * np.linalg.norm(signal))
    if len(places) <= FEW or not np.isfinite(size):
        total = np.zeros(width)
        for at in places.tolist():
            total += counts[at] * signal[at : at + width]
        return total
    n = 1 << (len(signal) - 1).bit_length()
    turned = np.conj(np.fft.rfft(counts, n))
    by_offset = lambda values: np.fft.irfft(np.fft.rfft(values, n) * turned, n)[:width]
    total = by_offset(signal)
    if np.array_equal(signal, np.rint(signal)) and size * n.bit_length() * np.finfo(float).eps < 1 / 64:
        return np.rint(total)
    return np.where(np.rint(by_offset((signal != 0).astype(float))) > 0, total, 0.0)


def dense(files: Sequence[tuple[str, Layout, np.ndarray]], chrom: str, start: int, length: int) -> np.ndarray:
    """The values of ``length`` bases of a chromosome from ``start`` on, added up over files; NaN counts 0.

    ``files`` are paths with their layout and the items of their root; a file that cannot meet the place is not opened.
    """
    values = np.zeros(length)
    for path, form, root in files:
        region = (form.ids.get(chrom, -1), start, start + length)
        if region[0] < 0 or not len(meeting(root, region)):
            continue
        with remote.opened(path) as file:
            for place in blocks(file, [form.root], region):
                own, starts, ends, found = decoded(file, place, form.packed)
                meets = (own == region[0]) & (starts < region[2]) & (ends > region[1])
                low, high = np.maximum(starts[meets], start) - start, np.minimum(ends[meets], start + length) - start
                before = np.concatenate([[0], np.cumsum(high - low)])
                bases = np.repeat(low - before[:-1], high - low) + np.arange(before[-1])
                np.add.at(values, bases, np.repeat(np.nan_to_num(found[meets]), high - low))
    return values


def window_sums(spark: SparkSession, path: str, windows: DataFrame, width: int) -> DataFrame:
    """``offset`` (from 0) and ``total``: values over windows (chrom, start) of one width, added up by place; NaN counts 0.

    Windows are dealt out by place and counted in tiles of the chromosome; a task reads the signal of each of its tiles once,
    however many windows lie there, and sends one number for each offset.
    """
    paths = remote.files(path, ".bw")
    tile = max(TILE, 1 << (width - 1).bit_length()) if width > 1 else TILE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, at, counts, files = np.zeros(width), None, np.zeros(tile), []

        def close() -> None:
            last = int(np.flatnonzero(counts)[-1])
            np.add(total, correlated(counts[: last + 1], dense(files, at[0], at[1] * tile, last + width), width), out=total)
            counts.fill(0)

        for batch in batches:
            coded, starts = batch.column("chrom").dictionary_encode(), batch.column("start").to_numpy()
            names, codes, numbers = coded.dictionary.to_pylist(), coded.indices.to_numpy(), starts // tile
            cuts = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(numbers) != 0)) + 1).tolist(), len(starts)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                place = (names[codes[a]], int(numbers[a]))
                if at is None:
                    for name in paths:
                        with remote.opened(name) as file:
                            form = layout(file)
                            files.append((name, form, node(file, form.root)[1]))
                elif place != at:
                    close()
                at = place
                np.add(counts, np.bincount(starts[a:b] - place[1] * tile, minlength=tile), out=counts)
        if at is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["offset", "total"])

    asked = windows.where("chrom is not null and start is not null").select("chrom", F.col("start").cast("long").alias("start"))
    dealt = asked.repartitionByRange(tasks(spark), "chrom", "start").sortWithinPartitions("chrom", "start")
    sums = dealt.mapInArrow(run, "offset long, total double").groupBy("offset").agg(F.sum("total").alias("total"))
    every = spark.range(width).select(F.col("id").alias("offset"))
    return every.join(sums, "offset", "left").select("offset", F.coalesce("total", F.lit(0.0)).alias("total"))


def window_profile(spark: SparkSession, path: str, regions: DataFrame, up: int, down: int, smooth: int = 10) -> DataFrame:
    """Mean signal at each offset from the regions' centres, and its moving average, read from files.

    Only windows that lie on their chromosome as a whole count; a base without signal counts 0. Columns as
    ``intervals.profile``: ``offset``, ``mean``, ``smooth``. No whole window gives no rows.
    """
    whole = intervals.whole_windows(regions, chromosome_lengths(spark, path), up, down)
    n = whole.agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    sums = window_sums(spark, path, whole.select("chrom", (F.col("centre") - up).alias("start")), up + down)
    means = sums.crossJoin(F.broadcast(n)).select((F.col("offset") - up).alias("offset"), (F.col("total") / F.col("n")).alias("mean"))
    return intervals.moving_average(means.withColumn("__all", F.lit(1)), ["__all"], "offset", "mean", smooth, "smooth").drop("__all")
