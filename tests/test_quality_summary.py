"""A row of figures for each sample, read reports, discovery of inputs, dictionaries and scatter points."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from cohortry.operators.provenance import dictionary_differences
from cohortry.sources import quality_summary as qs
from cohortry.sources import text_tables as tt

REPORT = "##FastQC\t0.12\n>>Basic Statistics\tpass\n#Measure\tValue\nTotal Sequences\t1200\nSequence length\t35-151\n%GC\t44\n>>END_MODULE\n>>Per base sequence quality\twarn\n1\t30\n>>END_MODULE\n>>Adapter Content\tfail\n>>END_MODULE\n>>Per base N content\tPASS\n#Total Deduplicated Percentage\t81.255\n>>Unknown\tfail\n"


def zipped(text, name="a_fastqc/fastqc_data.txt"):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr(name, text)
    return raw.getvalue()


def test_figures_of_zipped_reports(spark):
    files = [("a", zipped(REPORT)), ("b", zipped("Total Deduplicated Percentage\t60\n>>Adapter Content\n")), ("c", zipped("x", "other.txt")), ("d", b"no zip")]
    got = {r.source: r for r in qs.read_reports(qs.zipped_lines(spark.createDataFrame(files, "path string, content binary"))).collect()}
    assert set(got) == {"a", "b"}
    a = got["a"]
    assert (a.total_seqs, a.pct_gc, a.seq_length, a.base_quality, a.adapters, a.n_content, a.lengths, a.pct_modules_failed) == (1200, 44, 151, 1, 2, 0, None, 33.3)
    assert a.pct_duplicates == pytest.approx(18.74, abs=0.011) and (got["b"].pct_duplicates, got["b"].adapters, got["b"].pct_modules_failed) == (40, 2, 100)


def test_one_row_for_each_sample_from_its_files(spark, tmp_path):
    put = lambda name, text: (tmp_path / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    put("s1_R1_trimming_report.txt", "Total reads processed:  1,000\nReads with adapters: 40 (4%)\n")
    put("s1.bam.flagstat", "1500 + 0 in total\n1500 + 0 mapped (100.00%)\n")
    put("s2.bam.flagstat", "200 + 0 in total\n150 + 0 mapped (75.00%)\n")
    put("s3_R1_trimming_report.txt", "Total reads processed:  10\n")
    put("s3.bam.flagstat", "90 + 0 in total\n90 + 0 mapped (100%)\n")
    put("s1.markdup_metrics.txt", "sorted 100 end pairs\nfound 50 duplicates\n")
    put("s1_R1_fastqc.zip", zipped(REPORT))
    found = qs.figures(spark, {"trimming": str(tmp_path), "flagstat": str(tmp_path), "stats": str(tmp_path / "none"), "duplicates": str(tmp_path), "reports": str(tmp_path)})
    assert sorted(found) == ["duplicates", "flagstat", "reports", "trimming"]
    samples = spark.createDataFrame([("s1", "x"), ("s2", "x"), ("s3", "y"), ("s4", "y")], "sample string, group string")
    rows = {r["sample"]: r for r in qs.quality_rows(samples, {**found, "density": spark.createDataFrame([("s2", 0.5)], "sample string, score double")}).collect()}
    assert {s: r.mapped_pct for s, r in rows.items()} == {"s1": 75.0, "s2": 75.0, "s3": 100.0, "s4": None}
    assert (rows["s1"].duplicates_dup_pct, rows["s1"].reports_seq_length, rows["s1"].density_score, rows["s2"].density_score) == (25.0, 151.0, None, 0.5)
    twice = spark.createDataFrame([("s1", 1.0), ("s1", 2.0)], "sample string, score double")
    with pytest.raises(Exception, match="figures twice for s1"):
        qs.quality_rows(samples, {"density": twice}).collect()


def test_samples_are_discovered_unless_ambiguous(spark):
    files = lambda *names: tt.discover_samples(spark.createDataFrame([(f"/p/{n}",) for n in names], "path string"))
    got = files("a_R1.fastq.gz", "a_R2.fastq.gz", "b_L001_R1_001.FQ", "b_L001_R2_001.fq", "c.bam", "c.bam.bai", "notes.txt").orderBy("sample").collect()
    assert [tuple(r) for r in got] == [
        ("a", "", "", "fastq", "/p/a_R1.fastq.gz", "/p/a_R2.fastq.gz", ""), ("b", "", "", "fastq", "/p/b_L001_R1_001.FQ", "/p/b_L001_R2_001.fq", ""), ("c", "", "", "bam", "", "", "/p/c.bam"),
    ]
    for names, said in ((("a_R1.fq", "a_R2.fq", "a.bam"), "both reads and alignments of a"), (("a_R1.fq",), "ambiguous reads of a"), (("a_L001_R1.fq", "a_L002_R2.fq"), "ambiguous reads of a"), (("x/a.bam", "y/a.bam"), "ambiguous alignments of a")):
        with pytest.raises(Exception, match=said):
            files(*names).collect()
    with pytest.raises(ValueError, match="no pairs of reads"):
        files("notes.txt")


def test_dictionaries_and_indexes(spark, tmp_path):
    (tmp_path / "g.dict").write_text("@HD\tVN:1.6\n@SQ\tSN:chr2\tLN:50\tM5:x\n@SQ\tLN:70\tSN:chr1:a\n@SQ\tSN:bad\n")
    (tmp_path / "g.fai").write_text("chr2\t50\t6\t60\t61\nchr1:a\t71\t6\t60\t61\n\nchr3\t5\n")
    names, index = tt.read_dictionary(spark, str(tmp_path / "g.dict")), tt.read_index(spark, str(tmp_path / "g.fai"))
    assert [tuple(r) for r in names.orderBy("ord").collect()] == [(0, "chr2", 50), (1, "chr1:a", 70)]
    wrong = sorted(map(str, dictionary_differences(names, index).collect()))
    assert len(wrong) == 2 and "71" in wrong[0] + wrong[1] and "chr3" in wrong[0] + wrong[1]


def test_scatter_points_have_all_groups(spark):
    coordinates = spark.createDataFrame([("m", i, s, g, float(i), -float(i)) for i, (s, g) in enumerate([("s1", "case"), ("s2", "other"), ("s3", "control"), ("s4", "new"), ("s5", "other")])] + [("n", 0, "s1", "case", 1.0, 2.0)], "modality string, ord int, sample string, group string, pc1 double, pc2 double")
    variance = spark.createDataFrame([("m", 1, 0.5), ("m", 2, 0.25)], "modality string, pc int, value double")
    configured = spark.createDataFrame([("control", 0, None), ("case", 1, "s1"), ("case", 1, "s4"), ("empty", 2, None)], "group string, ord int, sample string")
    got = qs.scatter(coordinates, variance, configured).where("modality = 'm'").orderBy("trace_ord", "sample").collect()
    assert [(r.trace, r["sample"]) for r in got] == [("control", "s3"), ("case", "s1"), ("case", "s4"), ("other", "s2"), ("other", "s5"), ("new", "s4")]
    assert {(r.x_label, r.y_label) for r in got} == {("PC1 (50.0%)", "PC2 (25.0%)")}
    assert qs.scatter(coordinates, variance, configured).where("modality = 'n'").first().x_label == "PC1"
    percent = variance.withColumn("value", F.col("value") * 100)
    assert qs.scatter(coordinates, percent, configured).where("modality = 'm'").first().y_label == "PC2 (25.0%)"
