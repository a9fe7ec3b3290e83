"""Region calls: cleaning, annotation filters, best rows per gene, volcano classes and tables of the leading genes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: texts that stand for a missing name, and prefixes of genes without a protein
EMPTY_NAMES = ("na", "nan", "none", "", ".", "-")
NON_CODING = r"^(LOC|LINC|MIR)[0-9]"


def clean_name(c: Column) -> Column:
    """The trimmed name, or an empty text for null and for texts that stand for a missing name."""
    bare = F.trim(F.coalesce(c, F.lit("")))
    return F.when(F.lower(bare).isin(*EMPTY_NAMES), "").otherwise(bare)


def coding_promoters(calls: DataFrame, promoter: str) -> DataFrame:
    """Rows annotated as the promoter type with a symbol that does not look non-coding; null symbols are left out."""
    symbol = F.col("symbol")
    return calls.where((F.col("annot_type") == promoter) & symbol.isNotNull() & ~symbol.rlike(NON_CODING) & ~symbol.endswith("AS1"))


def annotate(calls: DataFrame, annotations: DataFrame, width: int) -> DataFrame:
    """One row for each pair of a call and an annotation (chrom, start, end, annot_type, symbol) that overlap."""
    from cohortry.operators.intervals import overlap_join

    return overlap_join(calls, annotations.withColumnsRenamed({"start": "r_start", "end": "r_end"}), width)


def log_q(calls: DataFrame, floor: float = 1e-300) -> DataFrame:
    """``neg_log_q``: zero q takes the smallest q above zero of the table, and none is below ``floor``."""
    least = calls.agg(F.min(F.when(F.col("q_value") > 0, F.col("q_value"))).alias("__least"))
    q = F.when(F.col("q_value") == 0, F.coalesce("__least", F.lit(floor))).otherwise(F.col("q_value"))
    return calls.crossJoin(F.broadcast(least)).withColumn("neg_log_q", -F.log10(F.greatest(q, F.lit(floor)))).drop("__least")


def best_per_gene(calls: DataFrame) -> DataFrame:
    """The row of lowest q of each symbol, then largest effect, then place; empty symbols are left out."""
    order = Window.partitionBy("symbol").orderBy(F.asc_nulls_last("q_value"), F.desc(F.abs("mean_diff")), "chrom", "start", "end")
    named = calls.withColumn("symbol", clean_name(F.col("symbol"))).where("symbol <> ''")
    return named.withColumn("__at", F.row_number().over(order)).where("__at = 1").drop("__at")


def effect_threshold(calls: DataFrame, alpha: float = 0.05, share: float = 0.1) -> DataFrame:
    """One row: the quantile of absolute effects among significant calls, by linear interpolation."""
    return calls.where(F.col("q_value") < alpha).agg(F.percentile(F.abs("mean_diff"), share).alias("effect_threshold"))


def volcano(calls: DataFrame, alpha: float = 0.05) -> DataFrame:
    """``direction``: Hyper or Hypo for significant calls whose effect reaches the threshold, else NS; ``capped``: -log10 q, at most the
    next ten above the largest."""
    scored = log_q(calls).crossJoin(F.broadcast(effect_threshold(calls, alpha)))
    strong = (F.col("q_value") < alpha) & (F.abs("mean_diff") >= F.col("effect_threshold"))
    cap = log_q(calls).agg((F.ceil(F.max("neg_log_q") / 10) * 10).cast("double").alias("cap"))
    out = scored.withColumn("direction", F.when(strong & (F.col("mean_diff") > 0), "Hyper").when(strong & (F.col("mean_diff") < 0), "Hypo").otherwise("NS"))
    return out.crossJoin(F.broadcast(cap)).withColumn("capped", F.least("neg_log_q", "cap")).drop("cap", "effect_threshold")


def strongest_labels(classed: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest absolute effects of each direction but NS, with ``at`` from 1; ties by symbol and place."""
    order = Window.partitionBy("direction").orderBy(F.desc(F.abs("mean_diff")), "symbol", "chrom", "start")
    return classed.where("direction <> 'NS'").withColumn("at", F.row_number().over(order)).where(F.col("at") <= n)


def leading_genes(calls: DataFrame, n: int = 50, alpha: float = 0.05) -> DataFrame:
    """The ``n`` genes of lowest q among significant calls, best row each."""
    return best_per_gene(calls.where(F.col("q_value") < alpha)).orderBy("q_value", "symbol").limit(n)


def call_counts(calls: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Rows, significant rows and distinct genes among them."""
    hit = F.col("q_value") < alpha
    gene = clean_name(F.col("symbol"))
    return calls.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(hit, 1)).alias("n_significant"), F.count_distinct(F.when(hit & (gene != ""), gene)).alias("n_genes"))


def top_genes(classed: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most significant distinct genes of each direction, the best row of each gene; ties by gene and place."""
    named = classed.withColumn("symbol", clean_name(F.col("symbol"))).where("symbol <> '' and direction <> 'NS'")
    own = Window.partitionBy("direction", "symbol").orderBy(F.desc("neg_log_q"), "chrom", "start")
    best = named.withColumn("__at", F.row_number().over(own)).where("__at = 1").drop("__at")
    order = Window.partitionBy("direction").orderBy(F.desc("neg_log_q"), "symbol")
    return best.withColumn("at", F.row_number().over(order)).where(F.col("at") <= n)
