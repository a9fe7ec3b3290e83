import base64
import gzip
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from cohortry.sources import logs
from cohortry.sources import text_tables as tt


def put(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def lines(spark, text, source="a"):
    return spark.createDataFrame([(source, i, x) for i, x in enumerate(text.split("\n"))], "source string, line_no int, line string")


def test_bed_and_sizes(spark, tmp_path):
    bed = tt.read_bed(spark, put(tmp_path, "a.bed", "#x\nchr1\t0\t15\tregion_a\nchr2\t5\t9\n"))
    assert {tuple(r) for r in bed.collect()} == {("chr1", 0, 15, "region_a"), ("chr2", 5, 9, "chr2:5-9")}
    with pytest.raises(Exception, match="invalid interval"):
        tt.read_bed(spark, put(tmp_path, "b.bed", "chr1\t9\t9\n")).collect()
    assert tt.read_chrom_sizes(spark, put(tmp_path, "s", "chr1\t100\nchr2\t50\n")).count() == 2
    with pytest.raises(Exception, match="invalid contig"):
        tt.read_chrom_sizes(spark, put(tmp_path, "t", "chr1\t100\nchr1\t50\n")).collect()


def test_bedgraph_ids(spark, tmp_path):
    path = put(tmp_path, "a.bedGraph", "track type=bedGraph\nchr1\t25114\t25116\t83\t5\t1\nchr1\t29336\t29337\tnan\nbad\n")
    rows = tt.read_bedgraph(spark, path, strict=False).withColumn("id", F.concat_ws("_", "chrom", (F.col("start") + 1).cast("string"))).collect()
    assert [(r.id, r.value, r.m) for r in rows] == [("chr1_25115", 83.0, 5.0), ("chr1_29337", None, None)]
    with pytest.raises(Exception, match="fewer than four"):
        tt.read_bedgraph(spark, path).collect()


def test_matrix_bins_and_sizes(spark, tmp_path):
    m = tt.read_matrix(spark, put(tmp_path, "m.tsv", "feature\ts1\ts2\nchr1:10-20\t1\tNA\nchr1:10-20\tNaN\t2\n"), ["s1", "s2"])
    assert sorted((r.s1 or 0, r.s2 or 0) for r in m.collect()) == [(0, 2), (1, 0)]
    b = tt.read_bins(spark, put(tmp_path, "d.tsv", "#contig\tstart\tstop\tratio\tratio_corrected\nchr1\t0\t100\t1\t1.1\n"), ["#contig", "start", "stop", "ratio", "ratio_corrected"])
    assert tuple(b.first()) == ("chr1", 0, 100, None, 1.1)
    for text in ("#x\nSize\tOccurrences\tSample\n100\t1\ts\n167\t2\ts\n320\t1\ts\n", "#x\n100\t1\n167\t2\n320\t1\n"):
        from cohortry.operators.quality import fragment_metrics

        got = fragment_metrics(tt.read_fragment_sizes(spark, put(tmp_path, "s.csv", text))).first()
        assert (got.sample, got["median"], got.peak, got.short_pct, got.mono_pct, got.di_pct) == ("s", 167, 167, 25.0, 50.0, 25.0)


def test_sheet_discovery_and_writers(spark, tmp_path):
    head = "sample\tgroup\trole\tinput_type\tr1\tr2\tbam\n"
    assert tt.read_sample_sheet(spark, put(tmp_path, "s.tsv", head + "a\tx\tcontrol\tbam\t\t\tp\nb\ty\tcase\tbam\t\t\tq\n")).count() == 2
    with pytest.raises(ValueError, match="repeated"):
        tt.read_sample_sheet(spark, put(tmp_path, "t.tsv", head + "a\tx\tcontrol\tbam\t\t\tp\na\ty\tcase\tbam\t\t\tq\n"))
    for n in ("x_R1.fastq.gz", "x_R2.fastq.gz", "y_1.fq.gz", "notes.txt"):
        put(tmp_path, n, "data")
    files = tt.listing(spark, str(tmp_path), "*q.gz")
    found = {r.sample: (r.r1.split("/")[-1], r.r2 and r.r2.split("/")[-1]) for r in tt.discover_inputs(files).collect()}
    assert found == {"x": ("x_R1.fastq.gz", "x_R2.fastq.gz"), "y": ("y_1.fq.gz", None)}
    tt.write_bed(spark.createDataFrame([("c", 1, 2, "n")], "chrom string, start long, end long, name string"), f"{tmp_path}/out")
    assert tuple(tt.read_bed(spark, f"{tmp_path}/out").first()) == ("c", 1, 2, "n")


def test_log_figures(spark):
    got = logs.flagstat(lines(spark, "200 + 0 in total (QC-passed)\n150 + 0 mapped (75.00%)\n140 + 0 properly paired")).first()
    assert (got.total, got.mapped, got.proper, got.mapped_pct) == (200, 150, 140, 75)
    got = logs.trimming(lines(spark, "Total reads processed:     1,234\nReads with adapters:    12 (1%)\nother")).first()
    assert (got.total_reads, got.with_adapters, got.total_bases) == (1234, 12, None)
    assert logs.duplicates(lines(spark, "sorted 100 end pairs\nfound 10 duplicates")).first().dup_pct == 5
    assert logs.duplicates(lines(spark, "found 10 duplicates (7.5 % duplicates)")).first().dup_pct == 7.5
    stats = logs.alignment_stats(lines(spark, "SN\t1st fragments:\t77\nSN\terror rate:\t1.5e-03\t# x")).first()
    assert stats.first_mates == 77 and abs(stats.error_pct - 0.15) < 1e-12
    block = logs.metrics_block(lines(spark, "## x\nBAIT_SET\tMEAN\np\t3.5\n"), "BAIT_SET")
    assert {tuple(r) for r in block.collect()} == {("a", "BAIT_SET", "p"), ("a", "MEAN", "3.5")}
    assert logs.bias_bounds(lines(spark, "Suggested: --OT 2,0,0,98 --OB 3,0,0,97")).first().top == "2,0,0,98"
    assert logs.fastq_heads(lines(spark, "@r1 x\nACGT\n+\nIIII")).first().valid


def test_zipped_reports_and_payloads(spark):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("a/summary.txt", "PASS\tBasic\tf\nFAIL\tContent\tf\n")
    modules = logs.report_modules(spark.createDataFrame([("p", raw.getvalue())], "path string, content binary"))
    assert logs.failed_share(modules).first().failed_pct == 50
    body = {"bar": {"datasets": [{"samples": ["s1", "s2"], "cats": [{"name": "c", "data": [1, None]}]}]}}
    packed = base64.b64encode(gzip.compress(json.dumps(body).encode())).decode()
    pages = spark.createDataFrame([("p", f'<script>x = "{packed}"</script>'), ("q", None)], "path string, html string")
    assert {tuple(r) for r in logs.merge_plots(logs.plot_rows(pages)).collect()} == {("bar", "s1", "c", 1.0), ("bar", "s2", "c", None)}
    assert logs.unpack_lz("BYUwNmD2Q===") == "hello"


def test_protection_table(spark, tmp_path):
    with open(tmp_path / "wps.tsv", "w") as file:
        file.write("chr\tstart\tend\tWPS\tmean_WPS\nchr1\t10\t30\t1,2,3\t2.0\nchr2\t5\t6\t-1\t-1.0\n")
    assert {tuple(r) for r in tt.read_protection(spark, str(tmp_path / "wps.tsv")).collect()} == {("chr1:10-30", 2.0), ("chr2:5-6", -1.0)}
