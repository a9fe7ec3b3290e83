"""Fragment tables: length shares, end motifs, bins of short and long fragments, occupancy and cut sites."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions.scalar import ratio
from cohortry.operators.intervals import tiled, with_carry


def length_shares(histogram: DataFrame, limit: int = 500) -> DataFrame:
    """Share in percent of each size from 0 to ``limit`` - 1 for each sample, sizes that do not occur as 0."""
    spark = histogram.sparkSession
    sums = histogram.where((F.col("size") >= 0) & (F.col("size") < limit)).groupBy("sample", "size").agg(F.sum("count").alias("count"))
    totals = sums.groupBy("sample").agg(F.sum("count").alias("total"))
    dense = totals.crossJoin(F.broadcast(spark.range(limit).select(F.col("id").cast("int").alias("size"))))
    return dense.join(sums, ["sample", "size"], "left").select("sample", "size", ratio(100 * F.coalesce("count", F.lit(0)), F.col("total")).alias("pct"))


def length_profile(shares: DataFrame) -> DataFrame:
    """Mean share of each size over samples, and whether it is the peak (the smallest size of the largest mean)."""
    means = shares.groupBy("size").agg(F.avg("pct").alias("mean_pct"))
    peak = means.agg(F.max_by("size", F.struct("mean_pct", -F.col("size"))).alias("peak"))
    return means.crossJoin(F.broadcast(peak)).select("size", "mean_pct", (F.col("size") == F.col("peak")).alias("is_peak"))


def sample_peaks(histogram: DataFrame, limit: int = 500) -> DataFrame:
    """The most frequent size under ``limit`` of each sample, the smallest of equals."""
    sums = histogram.where(F.col("size") < limit).groupBy("sample", "size").agg(F.sum("count").alias("count"))
    return sums.groupBy("sample").agg(F.max_by("size", F.struct("count", -F.col("size"))).alias("peak"))


def from_reads(reads: DataFrame) -> DataFrame:
    """Histogram of fragment sizes from mates (sample, qname, start, end): from the first start to the last end of a name."""
    spans = reads.groupBy("sample", "qname").agg((F.max("end") - F.min("start")).alias("size"))
    return spans.groupBy("sample", "size").agg(F.count(F.lit(1)).alias("count"))


def motif_frequencies(sequences: DataFrame, k: int = 4) -> DataFrame:
    """Share of each leading k-mer among a sample's sequences (sample, seq), upper-cased; shorter ones are left out."""
    heads = sequences.where(F.length("seq") >= k).groupBy("sample", F.upper(F.substring("seq", 1, k)).alias("motif")).agg(F.count(F.lit(1)).alias("n"))
    return heads.withColumn("freq", F.col("n") / F.sum("n").over(Window.partitionBy("sample")))


def top_motifs(freqs: DataFrame, n: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """The ``n`` motifs of highest mean frequency, within ``by`` if given, ties by name."""
    means = freqs.groupBy(*by, "motif").agg(F.avg("freq").alias("mean_freq"))
    if not by:
        return means.orderBy(F.desc("mean_freq"), "motif").limit(n)
    order = Window.partitionBy(*by).orderBy(F.desc("mean_freq"), "motif")
    return means.withColumn("__at", F.row_number().over(order)).where(F.col("__at") <= n).drop("__at")


def bin_ratios(fragments: DataFrame, width: int, short: tuple[int, int] = (100, 150), long: tuple[int, int] = (151, 220)) -> DataFrame:
    """Ratio of short to long fragments by midpoint in bins: sample, contig, start, stop, n_short, n_long, ratio (null without long)."""
    size = F.col("end") - F.col("start")
    at = F.floor((F.col("start") + F.col("end")) / 2 / width) * width
    n = lambda r: F.count(F.when(size.between(*r), 1))
    counted = fragments.groupBy("sample", F.col("chrom").alias("contig"), at.alias("start")).agg(n(short).alias("n_short"), n(long).alias("n_long"))
    return counted.where("n_short + n_long > 0").select("sample", "contig", "start", (F.col("start") + width).alias("stop"), "n_short", "n_long", F.when(F.col("n_long") > 0, F.col("n_short") / F.col("n_long")).alias("ratio"))


def align_bins(bins: DataFrame, samples: Sequence[str], value: str = "ratio") -> DataFrame:
    """Bins that every sample has, one column for each sample. A repeated bin of a sample, or no common bin, is an error."""
    keys = ["contig", "start", "stop"]
    twice = bins.groupBy("sample", *keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"bin {twice[0].contig}:{twice[0].start}-{twice[0].stop} occurs twice in {twice[0].sample}")
    kept = bins.where(F.col("sample").isin(list(samples)))
    wide = kept.groupBy(*keys).pivot("sample", list(samples)).agg(F.first(value))
    shared = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") == len(samples)).drop("__n")
    out = wide.join(shared, keys, "left_semi")
    if out.isEmpty():
        raise ValueError("the samples share no bin")
    return out


def occupancy(regions: DataFrame, signal: DataFrame, width: int) -> DataFrame:
    """Of every region: ``size``, ``covered`` bases, ``sum`` of signal, ``mean0`` over all bases and ``mean`` over covered ones.

    ``signal`` has chrom, start, end, value and does not overlap itself.
    """
    from cohortry.operators.intervals import overlap_join

    right = signal.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"), "value")
    both = F.least("end", "r_end") - F.greatest("start", "r_start")
    met = overlap_join(regions, right, width).groupBy("name").agg(F.sum(both).alias("covered"), F.sum(both * F.col("value")).alias("sum"))
    size = F.col("end") - F.col("start")
    full = regions.join(met, "name", "left").withColumn("covered", F.coalesce("covered", F.lit(0))).withColumn("sum", F.coalesce("sum", F.lit(0.0)))
    return full.select("name", size.alias("size"), "covered", "sum", ratio(F.col("sum"), size).alias("mean0"), F.when(F.col("covered") > 0, F.col("sum") / F.col("covered")).otherwise(0.0).alias("mean"))


def cut_sites(fragments: DataFrame) -> DataFrame:
    """Share of the fragments over a base that end there: chrom, pos, ``ends``, ``depth``, ``share``, at bases where fragments end.

    Depth is a running sum over starts and stops within tiles, each told the sum of those before it; no fragment is
    unrolled into its bases.
    """
    steps = fragments.select("chrom", F.inline(F.array(F.struct(F.col("start").alias("pos"), F.lit(1).alias("step"), F.lit(1).alias("ends")), F.struct(F.col("end").alias("pos"), F.lit(-1).alias("step"), F.lit(0).alias("ends")), F.struct((F.col("end") - 1).alias("pos"), F.lit(0).alias("step"), F.lit(1).alias("ends")))))
    sums = steps.groupBy("chrom", "pos").agg(F.sum("step").alias("step"), F.sum("ends").alias("ends"))
    sums = with_carry(tiled(sums, "pos"), ["chrom"], F.sum("step"), F.sum, "__before")
    depth = F.sum("step").over(Window.partitionBy("chrom", "__tile").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce("__before", F.lit(0))
    return sums.withColumn("depth", depth).where("ends > 0").select("chrom", "pos", "ends", "depth", (F.col("ends") / F.col("depth")).alias("share"))


# fixed values: the two classes of dinucleotides, pairs of A or T (1) and of G or C (2), by code point
KINDS = np.zeros(256, np.int8)
KINDS[[ord(c) for c in "AT"]], KINDS[[ord(c) for c in "GC"]] = 1, 2


def dinucleotides(sequences: DataFrame, centre: int = 0) -> DataFrame:
    """Share in percent of weak and strong dinucleotides at each position of equally long sequences (seq), position less ``centre``.

    Tasks count in their sequences and send one row for each class and position.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {"weak": np.zeros(0, np.int64), "strong": np.zeros(0, np.int64)}
        for batch in batches:
            text = "".join(batch.column("seq").to_pylist())
            letters, sizes = np.frombuffer(text.encode("utf-32-le"), np.uint32), batch.column("size").to_numpy()
            kind = KINDS[np.minimum(letters, 255)]
            at = np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            inside = at[1:] > 0
            for name, number in (("weak", 1), ("strong", 2)):
                found = np.bincount(at[:-1][inside & (kind[:-1] == number) & (kind[1:] == number)])
                if len(found) > len(counts[name]):
                    found, counts[name] = counts[name], found.astype(np.int64)
                counts[name][: len(found)] += found
        for name, n in counts.items():
            pos = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(pos), pa.string()), pa.array(pos), pa.array(n[pos])], names=["class", "pos", "n"])

    upper = sequences.select(F.upper("seq").alias("seq")).where(F.length("seq") >= 2).select("seq", F.length("seq").cast("long").alias("size"))
    sums = upper.mapInArrow(run, "class string, pos long, n long").groupBy("class", "pos").agg(F.sum("n").alias("n"))
    return sums.select("class", (F.col("pos") - centre).alias("pos"), "n", (100 * F.col("n") / F.sum("n").over(Window.partitionBy("class"))).alias("pct"))


def chromosome_ratios(bins: DataFrame, chromosomes: Sequence[str]) -> DataFrame:
    """``sample``, ``group``, ``chrom``, ``n_bins``, ``ratio``: mean of the bins' ratios on the named chromosomes.

    ``bins`` has sample, group, chrom, ratio and maybe ratio_corrected, which then counts instead. Ratios may be texts; what is no
    number is left out, and a chromosome without any ratio has no row.
    """
    ratio_ = F.col("ratio_corrected" if "ratio_corrected" in bins.columns else "ratio").try_cast("double")
    numbers = bins.where(F.col("chrom").isin(*chromosomes)).select("sample", "group", "chrom", F.nanvl(ratio_, F.lit(None).cast("double")).alias("value"))
    return numbers.where("value is not null").groupBy("sample", "group", "chrom").agg(F.count(F.lit(1)).alias("n_bins"), F.avg("value").alias("ratio"))


def mate_spans(reads: DataFrame, length: int = 167) -> DataFrame:
    """Spans of mate pairs (sample, chrom, start, end, mate_start, mate_end) of exactly ``length`` bases."""
    span = reads.select("sample", "chrom", F.least("start", "mate_start").alias("start"), F.greatest("end", "mate_end").alias("end"))
    return span.where(F.col("end") - F.col("start") == length)


def has_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def usable_reads(reads: DataFrame) -> DataFrame:
    """Properly paired primary reads that passed quality control and map somewhere: by flag bits and mapping quality."""
    flag = F.col("flag")
    return reads.where(has_flag(flag, 0x2) & ~has_flag(flag, 0x100) & ~has_flag(flag, 0x200) & ~has_flag(flag, 0x800) & (F.col("mapq") > 0))


def read_counts(reads: DataFrame) -> DataFrame:
    """Per sample: primary, duplicate, secondary and supplementary reads, distinct duplicate mates and names."""
    flag = F.col("flag")
    primary = ~has_flag(flag, 0x100) & ~has_flag(flag, 0x800)
    duplicate = primary & has_flag(flag, 0x400)
    n = lambda c: F.count(F.when(c, 1))
    # one row for each mate first, so that the names need no second distinct aggregate
    mates = reads.groupBy("sample", "qname", "mate").agg(n(primary).alias("primary"), n(duplicate).alias("duplicate"), n(has_flag(flag, 0x100)).alias("secondary"), n(has_flag(flag, 0x800)).alias("supplementary"))
    names = mates.groupBy("sample", "qname").agg(*(F.sum(c).alias(c) for c in ("primary", "duplicate", "secondary", "supplementary")), n(F.col("duplicate") > 0).alias("mates"))
    return names.groupBy("sample").agg(*(F.sum(c).alias(c) for c in ("primary", "duplicate", "secondary", "supplementary")), F.sum("mates").alias("duplicate_mates"), n(F.col("mates") > 0).alias("duplicate_names"))


def compare_marks(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Agreement of two tools' marks (keys, marked): sizes of intersection and union, Jaccard, differing and agreeing keys."""
    x, y = F.coalesce("marked_a", F.lit(False)), F.coalesce("marked_b", F.lit(False))
    both = a.withColumnRenamed("marked", "marked_a").join(b.withColumnRenamed("marked", "marked_b"), list(keys), "full")
    n = lambda c: F.count(F.when(c, 1))
    return both.agg(n(x & y).alias("n_both"), n(x | y).alias("n_either"), ratio(n(x & y), n(x | y)).alias("jaccard"), n(x != y).alias("n_differ"), ratio(n(x == y), F.count(F.lit(1))).alias("agreement"))


def compare_sites(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two tools' sites (keys, value, depth): shared and all sites, their ratio, mean and depth-weighted mean absolute difference."""
    one = a.select(*keys, F.col("value").alias("va"), F.col("depth").alias("da"))
    two = b.select(*keys, F.col("value").alias("vb"), F.col("depth").alias("db"))
    both = one.join(two, list(keys), "full")
    shared = F.col("va").isNotNull() & F.col("vb").isNotNull()
    gap, weight = F.abs(F.col("va") - F.col("vb")), F.col("da") + F.col("db")
    return both.agg(F.count(F.when(shared, 1)).alias("n_shared"), F.count(F.lit(1)).alias("n_all"), ratio(F.count(F.when(shared, 1)), F.count(F.lit(1))).alias("shared_fraction"), F.avg(gap).alias("mean_abs_delta"), ratio(F.sum(gap * weight), F.sum(F.when(shared, weight))).alias("weighted_delta"))
