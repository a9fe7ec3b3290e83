"""Signal files: intervals come back, trees prune, and profiles equal those of a table with the same values."""

import os
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry.operators import intervals
from cohortry.sources import remote, signals

REFS = [("chrB", 300_000), ("chrA", 50_000), ("none", 10)]


def some(n=20_000, seed=2):
    rng, out = random.Random(seed), []
    for chrom, length in REFS[:2]:
        at = 0
        while at < length - 40:
            at += rng.randrange(1, 20)
            end = at + rng.randrange(1, 12)
            out.append((chrom, at, end, float(rng.randrange(-8, 9)) / 4))
            at = end
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("signal"))
    signals.write_signal(spark.createDataFrame(some(), "chrom string, start long, end long, value double"), path, REFS, files=2, items=64, children=8)
    return path


def test_intervals_come_back_and_regions_read_less(spark, folder):
    assert sorted(map(tuple, signals.read_signal(spark, folder, ["chrom", "start", "end", "value"]).collect())) == sorted(some())
    small = signals.read_signal(spark, folder, ["chrom", "start", "end", "value"], split_bytes=8192)
    assert sorted(map(tuple, small.collect())) == sorted(some()) and small.rdd.getNumPartitions() > len(remote.files(folder, ".bw"))
    for chrom, low, high in (("chrB", 100_000, 100_500), ("chrA", 0, 50_000), ("chrC", 0, 5), ("none", 0, 10)):
        got = signals.read_signal(spark, folder, ["chrom", "start", "end", "value"], region=(chrom, low, high))
        assert sorted(map(tuple, got.collect())) == sorted(r for r in some() if r[0] == chrom and r[1] < high and r[2] > low)
    pushed = signals.read_signal(spark, folder, split_bytes=8192).where("chrom = 'chrA' and start < 1000 and end > 500")
    assert pushed.rdd.getNumPartitions() < small.rdd.getNumPartitions()
    assert pushed.count() == len([r for r in some() if r[0] == "chrA" and r[1] < 1000 and r[2] > 500])


def test_deep_trees_lead_to_every_block():
    places = [(c, 10 * i, 10 * i + 10, 1000 + i, 7) for c in (0, 2) for i in range(70_000)]

    class Bytes:
        def __init__(self, data):
            self.data = data

        def read(self, at, n):
            return self.data[at : at + n]

    file = Bytes(signals.tree(places, 0))
    assert [p for p, _ in signals.blocks(file, [48], None)] == [p[3] for p in places]
    assert [p for p, _ in signals.blocks(file, [48], (2, 55, 75))] == [1005, 1006, 1007]
    assert list(signals.blocks(file, [48], (1, 0, 10**6))) == []
    nodes = signals.frontier(file, 48, None, 40)
    assert len(nodes) >= 40 and [p for p, _ in signals.blocks(file, nodes, None)] == [p[3] for p in places]


def test_the_three_kinds_of_blocks():
    head = lambda kind, n, step=0, span=0: struct.pack("<IIIIIBBH", 4, 100, 0, step, span, kind, 0, n)
    kinds = {
        1: (head(1, 2) + struct.pack("<IIfIIf", 100, 103, 1.5, 110, 111, -2), [100, 110], [103, 111]),
        2: (head(2, 2, span=5) + struct.pack("<IfIf", 100, 1.5, 120, -2), [100, 120], [105, 125]),
        3: (head(3, 2, step=10, span=4) + struct.pack("<ff", 1.5, -2), [100, 110], [104, 114]),
    }
    for data, starts, ends in kinds.values():
        chrom, a, b, values = signals.section(data)
        assert (chrom, a.tolist(), b.tolist(), values.tolist()) == (4, starts, ends, [1.5, -2.0])
    with pytest.raises(ValueError, match="unknown kind"):
        signals.section(head(9, 0))


def test_profiles_equal_those_of_a_table(spark, folder):
    rng = random.Random(5)
    rows = [(c, s, s + rng.randrange(1, 9)) for c, n in REFS[:2] for s in (rng.randrange(n) for _ in range(200))] + [("chrB", 0, 10), ("chrA", 49_990, 50_000), ("chrC", 500, 600), ("chrB", 150, 150)]
    regions = spark.createDataFrame(rows, "chrom string, start long, end long")
    got = {r.offset: (r["mean"], r.smooth) for r in signals.window_profile(spark, folder, regions, 150, 100).collect()}
    signal = np.zeros((2, 300_000))
    for c, a, b, v in some():
        signal[int(c == "chrA"), a:b] = v
    whole = [(c, (a + b) // 2) for c, a, b in rows if c in ("chrA", "chrB") and (a + b) // 2 >= 150 and (a + b) // 2 + 100 <= dict(REFS)[c]]
    assert 300 < len(whole) < 403
    mean = np.mean([signal[int(c == "chrA"), m - 150 : m + 100] for c, m in whole], axis=0)
    smooth = np.convolve(mean, np.ones(10) / 10, mode="same")
    assert sorted(got) == list(range(-150, 100))
    assert np.allclose([got[i][0] for i in range(-150, 100)], mean) and np.allclose([got[i][1] for i in range(-150, 100)], smooth)
    # the same from a table, over the same windows
    lengths = signals.chromosome_lengths(spark, folder)
    centres = intervals.whole_windows(regions, lengths, 150, 100).select("chrom", F.col("centre").alias("start"), F.col("centre").alias("end"))
    table = intervals.profile(centres, signals.read_signal(spark, folder, ["chrom", "start", "end", "value"]), 150, 100)
    assert np.allclose([r["mean"] for r in table.orderBy("offset").collect()], mean)


def test_crowded_windows_read_each_place_of_the_signal_once(spark, folder, monkeypatch):
    rng, width, n = random.Random(7), 120, 3000
    starts = [("chrB", rng.randrange(299_000)) for _ in range(n)] + [("chrA", 49_000)] * n + [("chrZ", 5)] * 3
    windows = spark.createDataFrame(starts, "chrom string, start long").coalesce(1)
    signal = np.zeros((2, 300_200))
    for c, a, b, v in some():
        signal[int(c == "chrA"), a:b] = v
    got = signals.window_sums(spark, folder, windows, width).orderBy("offset").collect()
    assert np.allclose([r.total for r in got], np.sum([signal[int(c == "chrA"), a : a + width] for c, a in starts if c != "chrZ"], axis=0))
    # whatever the number of windows, a task decodes a block for each tile that it meets, no more
    met = []
    monkeypatch.setattr(signals, "decoded", lambda *given, own=signals.decoded: met.append(given[1]) or own(*given))
    files = []
    for path in remote.files(folder, ".bw"):
        with remote.opened(path) as file:
            form = signals.layout(file)
            files.append((path, form, signals.node(file, form.root)[1]))
    assert np.array_equal(signals.dense(files, "chrB", 1000, 5000), signal[0, 1000:6000])
    assert len(met) == len(set(met))


def test_whole_numbers_are_added_up_exactly_and_absent_signal_is_zero():
    rng = np.random.default_rng(3)
    counts, width = rng.integers(0, 40, 5000).astype(float), 700
    for signal in (rng.integers(0, 10**6, 5699).astype(float), np.where(np.arange(5699) > 5600, 0.1, 0.0), np.full(5699, 1e300)):
        want = np.sum([counts[i] * signal[i : i + width] for i in range(5000)], axis=0)
        got = signals.correlated(counts, signal, width)
        assert np.allclose(got, want) and np.array_equal(got == 0, want == 0)
        assert signal[0] != np.rint(signal[0]) or signal[-1] == 0.1 or signal[0] > 1e200 or np.array_equal(got, want)


def test_missing_values_count_as_zero_and_no_window_gives_no_rows(spark, tmp_path):
    rows = spark.createDataFrame([("chrA", 10, 20, float("nan")), ("chrA", 20, 30, 4.0)], "chrom string, start long, end long, value double")
    signals.write_signal(rows.coalesce(1), str(tmp_path), REFS)
    windows = lambda *r: signals.window_profile(spark, str(tmp_path), spark.createDataFrame(list(r), "chrom string, start long, end long"), 10, 10)
    assert [(r.offset, r["mean"]) for r in windows(("chrA", 20, 20)).orderBy("offset").collect()] == [(i, 4.0 if i >= 0 else 0.0) for i in range(-10, 10)]
    assert windows(("chrA", 5, 5), ("chrZ", 20, 20)).collect() == []


def test_overlaps_and_strange_files_are_errors(spark, tmp_path):
    rows = spark.createDataFrame([("chrA", 10, 20, 1.0), ("chrA", 15, 30, 4.0)], "chrom string, start long, end long, value double")
    with pytest.raises(Exception, match="must not overlap"):
        signals.write_signal(rows.coalesce(1), str(tmp_path / "x"), REFS)
    assert not [f for _, _, names in os.walk(tmp_path / "x") for f in names]
    (tmp_path / "y.bw").write_bytes(b"\0" * 200)
    with pytest.raises(Exception, match="not a signal file"):
        signals.read_signal(spark, str(tmp_path / "y.bw")).collect()
    assert zlib.decompress(zlib.compress(b"x")) == b"x"
