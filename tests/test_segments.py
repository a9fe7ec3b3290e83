"""Segments equal a search over whole chromosomes in plain Python, whatever the tiles; planted segments are found."""

import math
import random

import pytest

from cohortry.operators import segments as sg

SCHEMA = "chrom string, pos long, diff double"


def plain(sites, width, least, threshold, max_gap, level=None):
    """Segment starts by definition, chromosome by chromosome."""
    chroms = {}
    for c, p, d in sorted(sites):
        chroms.setdefault(c, []).append((p, d))
    steps = [b[1] - a[1] for rows in chroms.values() for a, b in zip(rows, rows[1:], strict=False) if b[0] - a[0] <= max_gap]
    level = level if level is not None else math.sqrt(sum(s * s for s in steps) / len(steps) / 2) if steps else None
    out = []
    for c, rows in chroms.items():
        blocks, seg = [], []
        for i, (p, d) in enumerate(rows):
            if i == 0 or p - rows[i - 1][0] > max_gap:
                blocks.append([])
            blocks[-1].append((p, d))
        for block in blocks:
            stat = []
            for i in range(len(block)):
                left, right = [d for _, d in block[max(0, i - width + 1) : i + 1]], [d for _, d in block[i + 1 : i + 1 + width]]
                n, m = len(left), len(right)
                stat.append(abs(sum(right) / m - sum(left) / n) * math.sqrt(n * m / (n + m)) if n >= least and m >= least else None)
            start = 0
            for i, s in enumerate(stat):
                if s is None or level is None or s < threshold * level:
                    continue
                before, after = [x for x in stat[max(0, i - width) : i] if x is not None], [x for x in stat[i + 1 : i + 1 + width] if x is not None]
                if all(s > x for x in before) and all(s >= x for x in after):
                    seg.append(block[start : i + 1])
                    start = i + 1
            seg.append(block[start:])
        out += [(c, s[0][0], s[-1][0] + 1, len(s), sum(d for _, d in s) / len(s)) for s in seg]
    return sorted(out)


def listed(found):
    return sorted((r.chrom, r.start, r.end, r.n_sites, r.mean_diff) for r in sg.segments(found).collect())


def same(got, want):
    return [g[:4] for g in got] == [w[:4] for w in want] and all(g[4] == pytest.approx(w[4]) for g, w in zip(got, want, strict=True))


def planted(n=900, seed=3):
    rng, sites = random.Random(seed), []
    for chrom in ("c1", "c2", "c3"):
        pos, level = 0, 0
        for i in range(n if chrom != "c3" else 3):
            pos += rng.randrange(1, 60) + (5000 if rng.random() < 0.01 else 0)
            if i % 90 == 0:
                level = rng.choice([0, 8, -8, 4])
            sites.append((chrom, pos, float(level + rng.randrange(-2, 3))))
    return sites


def test_equal_to_the_definition_whatever_the_tiles(spark, monkeypatch):
    from cohortry.operators import intervals

    sites = planted()
    frame = spark.createDataFrame([*sites, ("c1", None, 1.0), ("c1", 5_000_000, None)], SCHEMA).repartition(7)
    for width, least, threshold, max_gap in ((10, 5, 3.0, 300), (4, 2, 2.0, 40)):
        want = plain(sites, width, least, threshold, max_gap)
        assert len({w[1] for w in want}) > 20
        assert same(listed(sg.site_segments(frame, width, least, threshold, max_gap)), want)
        # small tiles of positions as well as of sites
        monkeypatch.setattr(intervals, "TILE", 700)
        assert same(listed(sg.site_segments(frame, width, least, threshold, max_gap, sites_per_tile=2 * width)), want)
        assert same(listed(sg.site_segments(frame, width, least, threshold, max_gap, sites_per_tile=2 * width + 3)), want)
        monkeypatch.undo()


def test_ties_go_to_the_first_and_flat_sites_have_no_changes(spark):
    wave = [("c", 10 * i, float(i // 6 % 2)) for i in range(60)]
    frame = spark.createDataFrame(wave, SCHEMA)
    assert same(listed(sg.site_segments(frame, 6, 3, 1.0, 300, level=0.5)), plain(wave, 6, 3, 1.0, 300, 0.5))
    flat = spark.createDataFrame([("c", 10 * i, 1.0) for i in range(50)], SCHEMA)
    assert listed(sg.site_segments(flat, level=0.1)) == [("c", 0, 491, 50, 1.0)]
    assert listed(sg.site_segments(spark.createDataFrame([], SCHEMA))) == []
    assert listed(sg.site_segments(spark.createDataFrame([("c", 5, 1.0)], SCHEMA))) == [("c", 5, 6, 1, 1.0)]
    with pytest.raises(ValueError, match="twice as many"):
        sg.site_segments(flat, width=10, sites_per_tile=19)


def test_planted_regions_are_called(spark):
    rng, rows = random.Random(8), []
    truth = [(100, 160, 0.4), (300, 345, -0.5), (600, 680, 0.3)]
    for i in range(1000):
        shift = next((d for a, b, d in truth if a <= i < b), 0.0)
        for s in range(12):
            group = "case" if s % 2 else "control"
            rows.append(("chr1", 50 * i, f"s{s}", group, 0.45 + (shift if group == "case" else 0) + rng.gauss(0, 0.08)))
    calls = sg.region_calls(spark.createDataFrame(rows, "chrom string, pos long, sample string, group string, value double"), min_diff=0.15).orderBy("start").collect()
    assert len(calls) == 3
    for call, (a, b, d) in zip(calls, truth, strict=True):
        assert abs(call.start / 50 - a) <= 2 and abs((call.end - 1) / 50 + 1 - b) <= 2
        assert abs(call.mean_diff - d) < 0.06 and call.mean_b - call.mean_a == pytest.approx(call.mean_diff, abs=1e-9)
        assert call.q < 0.01 and call.u == (36 if d > 0 else 0)


def test_sites_without_a_group_have_no_difference(spark):
    long = spark.createDataFrame([("c", 1, "control", 1.0), ("c", 1, "case", 3.0), ("c", 2, "case", 3.0), ("c", 3, "control", None), ("c", 3, "case", 1.0), ("c", 1, "other", 9.0)], "chrom string, pos long, group string, value double")
    assert [tuple(r) for r in sg.site_differences(long).collect()] == [("c", 1, 2.0)]
