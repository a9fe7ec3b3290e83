"""Small cases with results worked out by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry.operators import fragments, intervals, matrix, models, power, provenance, quality, regions, stats
from cohortry.plans import interval_queries


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


BED = "chrom string, start long, end long"


def test_merge_and_clip(spark):
    merged = intervals.merge(table(spark, [("c", 0, 10), ("c", 10, 20), ("c", 25, 30)], BED))
    assert {tuple(r) for r in merged.collect()} == {("c", 0, 20), ("c", 25, 30)}
    source = table(spark, [("chr1", 0, 15, "region_a", 0), ("chr1", 25, 40, "region_b", 1), ("chr2", 0, 10, "other", 2)], BED + ", name string, ord int")
    cut = intervals.clip(source, table(spark, [("chr1", 10, 30), ("chr1", 28, 35)], BED), 8)
    assert {tuple(r)[:4] for r in cut.collect()} == {("chr1", 10, 15, "region_a__panel_0"), ("chr1", 25, 35, "region_b__panel_0")}


@pytest.mark.parametrize("width", [3, 10, 1000])
def test_overlaps_equal_brute_force_for_any_bin_width(spark, width):
    rng = np.random.default_rng(1)
    a = [("ab"[i % 2], int(s), int(s + n), i) for i, (s, n) in enumerate(zip(rng.integers(0, 200, 60), rng.integers(1, 40, 60), strict=True))]
    b = [("ab"[i % 2], int(s), int(s + n), i) for i, (s, n) in enumerate(zip(rng.integers(0, 200, 60), rng.integers(1, 40, 60), strict=True))]
    got = intervals.overlap_join(table(spark, a, BED + ", i int"), table(spark, b, "chrom string, r_start long, r_end long, j int"), width)
    pairs = [(r.i, r.j) for r in got.collect()]
    want = {(x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and x[2] > y[1]}
    assert set(pairs) == want and len(pairs) == len(want)


def test_region_means_and_scores(spark):
    regions_ = table(spark, [("c", 10, 20, "r"), ("c", 50, 60, "empty")], BED + ", name string")
    points = table(spark, [("c", 10, 1.0), ("c", 11, 2.0), ("c", 20, 4.0), ("c", 21, 8.0)], "chrom string, pos long, value double")
    assert {r.name: r["mean"] for r in intervals.region_means(regions_, points, 7).collect()} == {"r": 3.0, "empty": None}
    windows = table(spark, [("c", 120, 120, "w")], BED + ", name string")
    score = lambda *reads: intervals.protection_scores(windows, table(spark, [("c", *r) for r in reads], BED)).first().wps
    assert score((0, 200)) == [1] and score((70, 200)) == [-1] and score((0, 250)) == [0] and score((0, 200), (70, 200)) == [0]


def test_union_splits_at_every_end(spark):
    rows = [("c", 0, 10, "a", 1.0), ("c", 5, 15, "b", 2.0)]
    got = {tuple(r) for r in intervals.atomic_union(table(spark, rows, BED + ", sample string, value double")).collect()}
    assert got == {("c", 0, 5, "a", 1.0), ("c", 5, 10, "a", 1.0), ("c", 5, 10, "b", 2.0), ("c", 10, 15, "b", 2.0)}


def test_aligned_bins(spark):
    schema = "sample string, contig string, start long, stop long, ratio double"
    rows = [("x", "chr1", 0, 100, 1.1), ("x", "chr1", 100, 200, 2.1), ("x", "chr2", 0, 100, 3.1), ("y", "chr1", 0, 100, 4.1), ("y", "chr2", 0, 100, 5.1)]
    got = {(r.contig, r.start): (r.x, r.y) for r in fragments.align_bins(table(spark, rows, schema), ["x", "y"]).collect()}
    assert got == {("chr1", 0): (1.1, 4.1), ("chr2", 0): (3.1, 5.1)}
    with pytest.raises(ValueError, match="twice"):
        fragments.align_bins(table(spark, [*rows, rows[0]], schema), ["x", "y"])
    with pytest.raises(ValueError, match="no bin"):
        fragments.align_bins(table(spark, rows[1:2] + rows[3:4], schema), ["x", "y"])


def test_agreement_of_two_tools(spark):
    keys = [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    mark = lambda names: table(spark, [(q, m, q in names) for q, m in keys], "qname string, mate int, marked boolean")
    got = fragments.compare_marks(mark({"a"}), mark({"a", "b"}), ["qname", "mate"]).first()
    assert (got.jaccard, got.agreement, got.n_differ) == (0.5, 0.5, 2)


def test_missing_quality_scores_half_and_passes(spark):
    rules = quality.rules_table(spark)
    got = quality.score_samples(table(spark, [("s", "flagstat_mapped_pct", None)], "sample string, metric string, value double"), rules).first()
    assert (got.qc_score, got.qc_status, got.n_missing) == (50.0, "PASS", 7)
    good = [("s", m, float(lo)) for m, _, w, lo, *_ in quality.RULES if w]
    got = quality.score_samples(table(spark, good[:-1] + [("s", "cpg_mean_depth", 1.0)], "sample string, metric string, value double"), rules).first()
    assert got.qc_status == "FAIL" and "Failed metrics: Mean CpG depth." in got.recommendation


def test_groups_samples_and_filters(spark):
    samples = table(spark, [("ctrl_1",), ("case_1",), ("x",)], "sample string")
    assert {tuple(r) for r in matrix.resolve_groups(samples, prefixes={"a": "ctrl", "b": "case"}).collect()} == {("ctrl_1", "a"), ("case_1", "b")}
    with pytest.raises(ValueError, match="nobody"):
        matrix.resolve_groups(samples, names={"a": ["nobody"]})
    long = table(spark, [("f", "a", 1.0), ("f", "b", float("nan"))], "feature string, sample string, value double").withColumn("value", matrix.null_if_nan(F.col("value")))
    got = matrix.feature_stats(long, 2).first()
    assert got.n == 1 and got.missing_frac == 0.5
    assert matrix.fixed_sample(spark.range(100), "id", 10).exceptAll(matrix.fixed_sample(spark.range(100).repartition(7), "id", 10)).count() == 0


def test_ranks_densities_and_genes(spark):
    got = [r.rank for r in stats.average_rank(table(spark, [("k", v) for v in (1.0, 2.0, 2.0, 3.0)], "k string, v double"), ["k"], "v", "rank").orderBy("v").collect()]
    assert got == [1.0, 2.5, 2.5, 4.0]
    flat = stats.kernel_density(spark.range(20000).select(F.lit("s").alias("sample"), (F.col("id") / 20000).alias("value"))).where("x between 0.3 and 0.7").agg(F.avg("density")).first()[0]
    assert abs(flat - 1) < 0.02
    rows = [("c", 1, 2, 0.001, 0.5, "G"), ("c", 5, 6, 0.0, 0.6, "G"), ("c", 9, 10, 0.2, 0.9, "H"), ("c", 12, 13, 0.01, -0.7, "na")]
    calls = table(spark, rows, BED + ", q_value double, mean_diff double, symbol string")
    classed = regions.volcano(calls)
    assert {r.start: r.direction for r in classed.collect()} == {1: "NS", 5: "Hyper", 9: "NS", 12: "Hypo"}
    assert [(r.direction, r.symbol) for r in regions.top_genes(classed).collect()] == [("Hyper", "G")]


def test_stage_order(spark):
    needs = {"a": [], "b": ["a"], "c": ["a", "b"], "d": ["e"], "e": ["d"]}
    assert provenance.topological(needs, ["c"]) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="cycle"):
        provenance.topological(needs, ["d"])
    with pytest.raises(ValueError, match="unknown"):
        provenance.topological(needs, ["z"])
    states = table(spark, [("complete",), ("ready",)], "state string")
    assert states.agg(provenance.overall(F.col("state"))).first()[0] == "ready"


def test_tiles_of_any_width_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [("abc"[i % 3], int(s), int(s + n), i % 2, float(i)) for i, (s, n) in enumerate(zip(rng.integers(-50, 300, 90), rng.integers(1, 60, 90), strict=True))]
    rows = list({(r[0], r[1], r[3]): r for r in rows}.values())
    df = table(spark, rows, BED + ", sample int, value double")

    def results():
        return (
            sorted(map(tuple, intervals.merge(df).collect())),
            sorted(map(tuple, intervals.atomic_union(df).collect())),
            sorted((r.chrom, r.start, r.gpos) for r in intervals.genome_order(df.select("chrom", "start", F.col("start").alias("end")).distinct(), ["b", "a"]).collect()),
            sorted(map(tuple, fragments.cut_sites(df).collect())),
        )

    want = results()
    covered = {c: sorted({p for r in rows if r[0] == c for p in range(r[1], r[2])}) for c in "abc"}
    assert sorted({(c, p) for c, a, b in want[0] for p in range(a, b)}) == sorted((c, p) for c in covered for p in covered[c])
    assert sorted(g for _, _, g in want[2]) == list(range(len(want[2])))
    monkeypatch.setattr(intervals, "TILE", 16)
    assert results() == want


def test_q_values_of_many_ties_and_nulls(spark):
    ps = [0.01, 0.04, 0.03, None] + [1.0] * 40 + [0.5] * 3
    got = {r.i: r.q for r in stats.adjust_p(table(spark, list(enumerate(ps)), "i int, p double")).collect()}
    known = sorted((p, i) for i, p in enumerate(ps) if p is not None)
    least, want = 1.0, {3: None}
    for rank in range(len(known), 0, -1):
        least = min(least, known[rank - 1][0] * len(ps) / rank)
        want[known[rank - 1][1]] = least
    assert got.keys() == want.keys() and all(got[i] is None if want[i] is None else abs(got[i] - want[i]) < 1e-12 for i in want)


def test_correlations_and_products_equal_numpy(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(5, 2, (40, 6))
    x[:, 5] = 3.0
    rows = [(f"f{i}", f"s{j}", float(x[i, j])) for i in range(40) for j in range(6)]
    long = table(spark, rows, "feature string, sample string, value double").repartition(3)
    names = [f"s{j}" for j in range(6)]
    got = {(r.a, r.b): r.r for r in stats.correlations(long, names).collect()}
    assert len(got) == 15 and got["s0", "s5"] is None
    assert all(abs(got[f"s{i}", f"s{j}"] - np.corrcoef(x[:, i], x[:, j])[0, 1]) < 1e-9 for i in range(5) for j in range(i + 1, 5))
    curve = table(spark, [(float(s), int(y)) for s, y in zip(np.round(x[:, 0], 0), x[:, 1] > 5, strict=True)], "score double, label int")
    a, b = [r.score for r in curve.collect() if r.label], [r.score for r in curve.collect() if not r.label]
    assert abs(stats.auc(curve).first().auc - np.mean([(p > q) + (p == q) / 2 for p in a for q in b])) < 1e-12


def test_one_sided_p_of_the_auc(spark):
    rng = np.random.default_rng(9)
    rows = [("f", "control" if i < 12 else "case", float(v)) for i, v in enumerate(np.round(np.concatenate([rng.normal(0, 1, 12), rng.normal(1, 1, 9)]), 1))]
    rows += [("flat", g, 1.0) for g in ("control", "case", "case")] + [("alone", "case", 1.0)]
    got = {r.feature: r for r in stats.auc_p(stats.rank_sum(table(spark, rows, "feature string, group string, value double"))).collect()}
    a, b = [v for f, g, v in rows if f == "f" and g == "control"], [v for f, g, v in rows if f == "f" and g == "case"]
    u = sum((y > x) + (x == y) / 2 for x in a for y in b)
    values, times = np.unique(a + b, return_counts=True)
    spread = np.sqrt(12 * 9 / 12 * (22 - (times**3 - times).sum() / (21 * 20)))
    from math import erfc

    assert abs(got["f"].auc - u / 108) < 1e-12 and abs(got["f"].p - erfc((u - 54 - 0.5) / spread / np.sqrt(2)) / 2) < 1e-9
    assert got["flat"].p == 1.0 and got["flat"].auc == 0.5 and got["alone"].p is None


def test_places_of_rows_and_missing_samples(spark, tmp_path):
    with open(tmp_path / "m.tsv", "w") as file:
        file.write("".join(f"f{i // 2}\t{i}\n" for i in range(50)))
    rows = spark.read.csv(str(tmp_path / "m.tsv"), sep="\t", schema="feature string, value int")
    assert sorted((r.ordinal, r.value) for r in matrix.with_ordinal(rows).collect()) == [(i, i) for i in range(50)]
    long = table(spark, [("a", "x", 1.0), ("b", "x", float("nan")), ("c", "x", None), ("d", "x", 3.0)], "feature string, sample string, value double")
    assert tuple(matrix.column_means(long, ["x"]).first()) == ("x", 2.0, 2, 4)
    with pytest.raises(Exception, match="no rows for sample y"):
        matrix.column_means(long, ["x", "y"]).collect()


def test_ranks_by_range_equal_ranks_by_window(spark):
    import random

    rng = random.Random(6)
    rows = [(s, i, None if rng.random() < 0.05 else float(rng.choice([0, 0, 0, 1, rng.randrange(200), -rng.random()]))) for s in ("a", "b", "c") for i in range(700)] + [("d", 1, None), ("e", 1, 2.5)]
    long = spark.createDataFrame(rows, "sample string, feature int, value double").repartition(5)
    by = lambda df: sorted((r["sample"], r.feature, r.value, r["rank"]) for r in df.where("value is not null").collect())
    got = stats.ranks_by_range(long, "sample", "value", "rank")
    assert by(got) == by(stats.average_rank(long, ["sample"], "value", "rank"))
    assert got.count() == len(rows) and got.where("value is null and rank is not null").count() == 0


def test_places_among_cuts_by_halving(spark):
    cuts = [1.0, 2.0, 2.0, 5.0, 9.0]
    values = spark.createDataFrame([(x,) for x in (0.0, 1.0, 1.5, 2.0, 3.0, 9.0, 10.0)], "x double")
    for n in range(len(cuts) + 1):
        own = F.array(*(F.lit(c) for c in cuts[:n])) if n else F.array().cast("array<double>")
        got = values.select("x", stats.range_of(F.col("x"), own, max(n, 1)).alias("at")).collect()
        assert all(r["at"] == sum(c < r.x for c in cuts[:n]) for r in got)


def test_feature_subset_by_number_share_and_all(spark):
    df = table(spark, [(f"f{i}",) for i in range(200)] * 2 + [(None,)], "feature string")
    names = lambda s: {r.feature for r in matrix.feature_subset(df, "feature", s).collect()}
    assert len(names("all")) == 200 and len(names(17)) == 17 and len(names(0.255)) == 51 and names(17) < names(51) == names(0.255)
    assert matrix.feature_subset(df, "feature", 17).count() == 17 and names(0) == set() and len(names(200)) == 200
    with pytest.raises(Exception, match="fewer than 201"):
        names(201)


def test_best_features_by_rank_p(spark):
    rng = np.random.default_rng(2)
    rows = [(f"f{i:02d}", "control" if s < 5 else "case", float(rng.integers(0, 50) + (s >= 5) * i)) for i in range(40) for s in range(11)]
    long = table(spark, [*rows, ("lone", "case", 1.0)], "feature string, group string, value double")
    tests = sorted((r.p, r.feature) for r in stats.rank_p(stats.rank_sum(long)).collect() if r.p is not None)
    assert [(r.place, r.p, r.feature) for r in sorted(stats.best_by_rank_p(long, 7).collect())] == [(i + 1, *t) for i, t in enumerate(tests[:7])]
    assert stats.best_by_rank_p(long.limit(0)).count() == 0 and stats.best_by_rank_p(long, 100).count() == 40


def test_moments_of_sites_align_and_refuse_repeated_sites(spark):
    means = table(spark, [("a", 0.5), ("b", 0.5), ("d", 0.999999999)], "site string, mean double")
    sd = table(spark, [("a", 10, 0.1), ("b", 10, 0.6), ("c", 10, 0.1), ("d", 10, 0.1), ("a", 30, 0.2), ("b", 30, None)], "site string, depth int, sd double")
    got = {r.depth: tuple(r)[1:] for r in power.feasibility(power.site_moments(means, sd)).collect()}
    assert got == {10: (3, 1, 1 / 3, 1), 30: (2, 1, 0.5, 1)}
    for a, b in ((means.union(means.limit(1)), sd), (means, sd.union(sd.limit(1)))):
        with pytest.raises(Exception, match="occurs more than once"):
            power.site_moments(a, b).collect()


def test_classifiers_follow_performance_or_places(spark):
    of = table(spark, [("x", 0), ("y", 1), ("z", 2)], "modality string, ord int")
    said = lambda c, p=None: {r.modality: r.classifier for r in models.resolve_classifiers(of, c, p).collect()}
    best = table(spark, [("x", "LR2, 1"), ("y", "RF, 99999999999"), (None, "1")], "modality string, best string")
    assert said([3, 1], best) == {"x": 1, "y": 3, "z": 3} and said([3, 1, 2]) == {"x": 3, "y": 1, "z": 2}
    assert said([2, 1]) == dict.fromkeys("xyz", 2) and said([2, 9], best)["x"] == 2
    with pytest.raises(ValueError, match="first classifier"):
        said([9])


def test_ratios_of_chromosomes_leave_out_what_is_no_number(spark):
    rows = [("s", "g", "chr1", "1.5"), ("s", "g", "chr1", "nan"), ("s", "g", "chr1", "NA"), ("s", "g", "chr1", "0.5"), ("s", "g", "chrX", "1"), ("s", "g", "chr2", None)]
    bins = table(spark, rows, "sample string, group string, chrom string, ratio string")
    assert [tuple(r) for r in fragments.chromosome_ratios(bins, ["chr1", "chr2"]).collect()] == [("s", "g", "chr1", 2, 1.0)]
    assert fragments.chromosome_ratios(bins.withColumn("ratio_corrected", F.lit(3.0)), ["chr2"]).first().ratio == 3.0


def test_scopes_and_their_keys(spark):
    rows = [(1, None, None, "kit", None, "t"), (2, None, "auto", "Kit", None, ""), (3, "genome", "panel", "kit", None, "t"), (4, None, "odd", None, None, "t"), (5, None, None, None, None, None), (6, "panel", None, None, "kit_7", "t")]
    out = provenance.resolve_scopes(table(spark, rows, "i int, requested string, configured string, assay string, profile string, target_bed string"), ["kit"], ["kit_"])
    got = {r.i: (r.targeted_assay, r.mode, r.targets, r.error is None) for r in out.collect()}
    assert got == {1: (True, "panel", "t", True), 2: (True, "panel", None, False), 3: (True, "genome", None, True), 4: (False, None, None, False), 5: (False, "genome", None, True), 6: (True, "panel", "t", True)}
    inputs = [("r", "bed", "a", "1"), ("r", "bam", "b", None)]
    key = lambda rows: provenance.scope_keys(table(spark, rows, "run string, label string, path string, signature string"), ["run"]).first().scope_key
    assert key(inputs) == key(inputs[::-1]) and len(key(inputs)) == 16 and key(inputs) != key([inputs[0], ("r", "bam", "b", "2")])


def test_dinucleotides_are_counted_in_tasks(spark):
    from cohortry.operators import fragments

    seqs = ["AATTGGcc", "gcA", "a", "", None, "A\u00e9TT\U0001f600GC", "stra\u00dfe GG", "NNNN"] * 3
    got = fragments.dinucleotides(spark.createDataFrame([(q,) for q in seqs], "seq string").coalesce(2), 2)
    want = {}
    for q in seqs:
        u = (q or "").upper()
        for i in range(len(u) - 1 if q and len(q) > 1 else 0):
            kind = "weak" if set(u[i : i + 2]) <= set("AT") else "strong" if set(u[i : i + 2]) <= set("GC") else None
            if kind:
                want[kind, i - 2] = want.get((kind, i - 2), 0) + 1
    total = lambda kind: sum(n for (k, _), n in want.items() if k == kind)
    assert {(r["class"], r.pos): (r.n, round(r.pct, 9)) for r in got.collect()} == {k: (n, round(100 * n / total(k[0]), 9)) for k, n in want.items()}
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_protection_scores_equal_those_counted_pair_by_pair(spark):
    rng = np.random.default_rng(8)
    at = lambda n: rng.integers(0, 40_000, n).tolist()
    reads = [("c", a, a + int(w)) for a, w in zip(at(4000), rng.integers(60, 260, 4000), strict=True)] + [("c", 16_300, 16_450)] * 50 + [(None, 100, 250), ("d", 5, 120)]
    windows = [("c", a, a + 100, f"w{i}") for i, a in enumerate(at(300))] + [("c", 16_200, 33_007, "long"), ("c", 7, 7, "one"), ("c", 7, 7, "again"), ("d", 50, 90, None), (None, 100, 140, "none"), ("e", 1, 1, "empty")]
    got = intervals.protection_scores(table(spark, windows, "chrom string, start long, end long, name string"), table(spark, reads, BED))
    want = []
    for c, a, b, name in windows:
        held = np.array([(x, y) for k, x, y in reads if k == c and c and 100 <= y - x + 1 <= 220]).reshape(-1, 2)
        scores = []
        for p in range(a, b + 1, 10):
            over = (held[:, 0] < p + 60) & (held[:, 1] > p - 60)
            scores.append(int(np.where((held[:, 0] <= p - 60) & (held[:, 1] >= p + 60), 1, -1)[over].sum()))
        want.append((c, a, b, name, tuple(scores), round(sum(scores) / len(scores), 9)))
    rows = [(r.chrom, r.start, r.end, r.name, tuple(r.wps), round(r.mean_wps, 9)) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(want, key=str)
    assert "pos" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_protection_query_scores_every_position_of_every_window(spark):
    sf = "/root/testdata/sf0.001"
    held = {}
    for r in interval_queries.events(spark, sf).where("end - start + 1 between 100 and 220").collect():
        held.setdefault(r.chrom, []).append((r.start, r.end))
    score = lambda c, p: sum(1 if a <= p - 60 and b >= p + 60 else -1 for a, b in held.get(c, ()) if a < p + 60 and b > p - 60)
    got = interval_queries.protection_scores(spark, sf).collect()
    assert len(got) == interval_queries.orders(spark, sf).count()
    assert all(len(r.wps.split(",")) == r.end - r.start + 1 == 101 for r in got)
    for r in sorted(got, key=lambda r: r.name)[:200]:
        assert r.wps == ",".join(str(score(r.chrom, p)) for p in range(r.start, r.end + 1))


def test_protection_scores_at_each_step_across_tiles(spark):
    rng = np.random.default_rng(9)
    reads = [("c", int(a), int(a + w)) for a, w in zip(rng.integers(0, 40_000, 3000), rng.integers(90, 240, 3000), strict=True)]
    windows = [("c", 16_350, 16_420, "over"), ("c", 16_383, 16_384, "edge"), ("c", 5, 33_000, "long"), ("c", -70, -3, "before")]
    for step in (1, 7):
        got = intervals.protection_scores(table(spark, windows, "chrom string, start long, end long, name string"), table(spark, reads, BED), step=step)
        for r in got.collect():
            at = np.arange(r.start, r.end + 1, step)
            want = np.zeros(len(at), np.int64)
            for _, x, y in reads:
                if 100 <= y - x + 1 <= 220:
                    want += np.where((x < at + 60) & (y > at - 60), np.where((x <= at - 60) & (y >= at + 60), 1, -1), 0)
            assert r.wps == want.tolist()
