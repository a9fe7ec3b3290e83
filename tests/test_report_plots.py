"""Payloads of every shape give rows; older layouts give the rows of the present one; reports merge by name."""

import base64
import gzip
import json
import time

import pytest

from cohortry.sources import logs
from cohortry.sources import report_plots as rp

EMPTY, ONE_PLOT = "N4XyA===", "N4IgZghgzgLgjgYwPpQKZwK6oHYNUhAew2xiiQAcAbQmEALmAF8mg==="


def element(text):
    return f'<script id="mqc_compressed_plotdata" type="text/plain">{text}</script>'


def packed(body):
    return base64.b64encode(gzip.compress(json.dumps(body).encode())).decode()


def plots(spark, *bodies):
    pages = [(f"r{i}", element(packed(b))) for i, b in enumerate(bodies)]
    return rp.plots(rp.payloads(spark.createDataFrame(pages, "path string, html string")))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_payloads_of_both_packers_and_placeholders():
    assert logs.payload(element(ONE_PLOT)) == {"fastqc_sequence_counts_plot": {}}
    assert logs.payload(element(EMPTY) + element(ONE_PLOT)) == {"fastqc_sequence_counts_plot": {}}
    assert logs.payload(element(packed({"legacy": {}}))) == {"legacy": {}}
    assert logs.payload(element("\n" + ONE_PLOT[:20] + "\n" + ONE_PLOT[20:])) == {"fastqc_sequence_counts_plot": {}}
    assert logs.payload(element("A" * 28)) == logs.payload(element("not base64 !")) == logs.payload(element(packed([1]))) == logs.payload("") == {}


def test_unpacking_ends_whatever_the_input():
    began = time.time()
    for text in ("A" * 28, "A" * 100_000, "/" * 50_000, "N4" + "A" * 10_000, ONE_PLOT[:30], "N4Ig" * 5000):
        with pytest.raises(ValueError):
            logs.unpack_lz(text)
    picture = base64.b64encode(bytes(range(256)) * 4000).decode()
    assert logs.payload(f'<img src="data:image/png;base64,{picture}"> <script>x = "{picture}"</script>') == {}
    assert time.time() - began < 20
    with pytest.raises(ValueError, match="too long"):
        logs.unpack_lz(ONE_PLOT, limit=5)
    assert logs.unpack_lz("BYUwNmD2Q===") == "hello" and logs.unpack_lz("Q===") == logs.unpack_lz("") == ""
    with pytest.raises(ValueError):
        logs.unpack(packed({"a": 1})[:-12])


def test_bars_of_both_layouts(spark):
    cats = [{"name": "Reads", "data": [1, None, "x"], "data_pct": [10, 20.5, 30]}, {"data": [4]}]
    present = {"bar": {"plot_type": "bar_graph", "datasets": [{"samples": ["a", "b", "c"], "cats": cats}, {"samples": ["d"], "cats": [{"name": "Other", "data": [5]}]}]}}
    old = {"bar": {"plot_type": "bar_graph", "samples": [["a", "b", "c"], ["d"]], "datasets": [cats, [{"name": "Other", "data": [5]}]]}}
    want = [(0, "1", "a", 4.0, None), (0, "1", "b", None, None), (0, "1", "c", None, None), (0, "Reads", "a", 1.0, 10.0), (0, "Reads", "b", None, 20.5), (0, "Reads", "c", None, 30.0), (1, "Other", "d", 5.0, None)]
    for body in (present, old):
        assert rows(rp.bars(plots(spark, body)), "dataset", "category", "sample", "value", "pct") == want
    # one list of samples stands for all datasets; lists of another kind of plot are no bars
    flat = {"bar": {"plot_type": "bar_graph", "samples": ["a"], "datasets": [[{"name": "x", "data": [1]}], [{"name": "x", "data": [2]}]]}, "line": {"plot_type": "xy_line", "datasets": [[{"name": "s", "data": [1]}]]}, "text": "none"}
    assert rows(rp.bars(plots(spark, flat)), "plot", "dataset", "sample", "value") == [("bar", 0, "a", 1.0), ("bar", 1, "a", 2.0)]


def test_lines_of_both_layouts(spark):
    present = {"line": {"datasets": [{"label": "CpG R1", "lines": [{"name": "s", "pairs": [[1, 0.2], ["x", None]]}, {"pairs": [[3, 4]]}]}, {"lines": []}, {"lines": [{"name": "t", "pairs": [[1, 2]]}]}]}}
    assert rows(rp.lines(plots(spark, present)), "dataset", "label", "line", "point", "x_text", "x", "y") == [
        (0, "CpG R1", "Sample 1", 0, "3", 3.0, 4.0), (0, "CpG R1", "s", 0, "1", 1.0, 0.2), (0, "CpG R1", "s", 1, "x", None, None), (2, "Dataset 2", "t", 0, "1", 1.0, 2.0),
    ]
    scalars = {"duplication": {"plot_type": "xy_line", "datasets": [[{"name": "sample", "data": [0.2, 0.8]}]], "config": {"categories": [10, 20]}}}
    assert rows(rp.lines(plots(spark, scalars)), "label", "line", "x", "y") == [("Dataset 1", "sample", 10.0, 0.2), ("Dataset 1", "sample", 20.0, 0.8)]
    scalars["duplication"]["config"]["categories"] = [1]
    assert rows(rp.lines(plots(spark, scalars)), "x", "y") == [(1.0, 0.2), (2.0, 0.8)]
    pairs = {"d": {"plot_type": "xy_line", "datasets": [[{"name": "s", "data": [[5, 1], [6, 2]]}], [{"name": "s", "pairs": [[7, 3]], "data": [[8, 9]]}]]}}
    assert rows(rp.lines(plots(spark, pairs)), "dataset", "x", "y") == [(0, 5.0, 1.0), (0, 6.0, 2.0), (1, 7.0, 3.0)]


def test_heat_maps_of_both_layouts_and_their_status(spark):
    present = {"h": {"plot_type": "heatmap", "datasets": [{"xcats": ["Basic", " Dup "], "ycats": ["s", "t"], "rows": [[1, 0.5], [0.25]]}]}}
    old = {"h": {"plot_type": "heatmap", "xcats": ["Basic", " Dup "], "ycats": ["s", "t"], "data": [[0, 0, 0.5], [0, 0, 1], [1, 0, 0.5], [0, 1, 0.25], [5, 0, 1], [0, -1, 1], ["0", 0, 9], [0.5, 0, 9], [0, 0], "x"]}}
    cell = lambda df: rows(rp.status(df), "x", "y", "value", "status")
    assert cell(rp.heat_maps(plots(spark, present))) == [(" Dup ", "s", 0.5, "Warn"), (" Dup ", "t", None, "N/A"), ("Basic", "s", 1.0, "Pass"), ("Basic", "t", 0.25, "Fail")]
    assert cell(rp.heat_maps(plots(spark, old))) == [(" Dup ", "s", 0.5, "Warn"), (" Dup ", "t", 0.0, "N/A"), ("Basic", "s", 1.0, "Pass"), ("Basic", "t", 0.25, "Fail")]
    assert rows(rp.status(rp.heat_maps(plots(spark, old)), ["dup", "none"]), "x").count((" Dup ",)) == 0


def test_reports_merge_by_name_with_gaps(spark):
    def body(sample, value, extra):
        return {
            "bar": {"datasets": [{"samples": [sample, f"{sample}2"], "cats": [*extra, {"name": "Reads", "data": [value, value + 1], "data_pct": [100, 99]}]}]},
            "line": {"datasets": [{"label": f"of {sample}", "lines": [{"name": sample, "pairs": [[1, value]]}]}]},
            "heat": {"datasets": [{"xcats": ["Basic", sample], "ycats": [sample], "rows": [[1, 0.5]]}]},
        }

    found = plots(spark, body("b", 10, []), body("a", 20, [{"name": "New", "data": [7, 8]}]))
    bars = rp.merged_bars(rp.bars(found)).orderBy("category_ord", "sample_ord").collect()
    assert [(r.category, r.sample, r.value, r.pct) for r in bars] == [
        ("Reads", "b", 10, 100), ("Reads", "b2", 11, 99), ("Reads", "a", 20, 100), ("Reads", "a2", 21, 99),
        ("New", "b", None, None), ("New", "b2", None, None), ("New", "a", 7, None), ("New", "a2", 8, None),
    ]
    lines = rp.merged_lines(rp.lines(found)).orderBy("line_ord").collect()
    assert [(r.label, r.line, r.line_ord, r.y) for r in lines] == [("of b", "b", 0, 10.0), ("of b", "a", 1, 20.0)]
    heat = rp.merged_heat_maps(rp.heat_maps(found)).orderBy("y_ord", "x_ord").collect()
    assert [(r.y, r.x, r.value) for r in heat] == [("b", "Basic", 1), ("b", "b", 0.5), ("b", "a", None), ("a", "Basic", 1), ("a", "b", None), ("a", "a", 0.5)]


def test_plots_by_name_and_pages_without_any(spark):
    one = lambda v: {"datasets": [{"samples": ["s"], "cats": [{"name": "c", "data": [v]}]}]}
    found = rp.bars(plots(spark, {"q": one(1), "q-1": one(2)}, {"q-12": one(3), "q-2": one(4), "q-x": one(5)}, {"r": one(6)}))
    assert rows(rp.named(found, "q"), "source", "value") == [("r0", 1.0), ("r1", 3.0)]
    none = spark.createDataFrame([("p", None), ("q", "<html>"), ("r", element("A" * 28))], "path string, html string")
    found = rp.plots(rp.payloads(none))
    assert rp.bars(found).count() == rp.lines(found).count() == rp.heat_maps(found).count() == 0
