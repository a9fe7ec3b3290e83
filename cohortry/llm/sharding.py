"""Sharding by weighted rendezvous hashing, with DataFrame functions only.

Every shard draws a number for a record's key, an exponential variate of the shard's weight made from MD5 of key and
shard; the smallest draw takes the record. A draw depends on nothing but the key and the shard, so a further shard takes
records only into itself, and a shard that goes loses only its own. Placing is a projection: no row moves for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.common import free_name, materialise

#: Most blocks in which rows are numbered; the table of their first slots has so many rows at most, whatever the input.
BLOCKS = 2**17
#: Hex digits of an MD5 that make a draw, and those that order rows: 52 bits are exact in a double, 60 fit a long.
DRAW_DIGITS, ORDER_DIGITS = 13, 15


def _leading(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def draw(key: Column, shard: Column, weight: Column) -> Column:
    """Struct of ``draw`` and ``shard``: an exponential variate with rate ``weight``, fixed by key and shard."""
    bits = _leading(F.md5(F.concat(key, F.lit(":"), shard.cast("string"))), DRAW_DIGITS)
    uniform = (bits + F.lit(0.5)) / F.lit(float(16**DRAW_DIGITS))
    return F.struct((-F.ln(uniform) / weight).alias("draw"), shard.alias("shard"))


def first_draw(key: Column, weights: Sequence[float]) -> Column:
    """The smallest draw of all shards with a weight above zero; of equal draws, that of the smaller shard."""
    if not any(w > 0 for w in weights) or any(not 0 <= w < float("inf") for w in weights):
        raise ValueError("weights are finite, none below zero and at least one above")
    offers = F.array(*(F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights) if w > 0))
    return F.array_min(F.transform(offers, lambda o: draw(key, o["shard"], o["weight"])))


def key_text(key: Column) -> Column:
    """The key as text, a null as the empty text."""
    return F.coalesce(key.cast("string"), F.lit(""))


def place(docs: DataFrame, weights: Sequence[float], id_col: str = "doc_id", grown: Sequence[float] = ()) -> DataFrame:
    """``docs`` with ``shard`` beside its own columns, and ``grown_shard``: the shard after ``grown`` further shards.

    ``weights`` has one weight for each shard; zero takes nothing. ``grown`` has the weights of shards that are added
    after them; without any, ``grown_shard`` is ``shard``. Own columns of those names are replaced.

    Rows of equal keys share a shard, null keys that of the empty text. Empty tables and texts of any length are fine.
    """
    mark, key = free_name(docs, "drawn"), key_text(F.col(id_col))
    more = [draw(key, F.lit(len(weights) + i), F.lit(float(w))) for i, w in enumerate(grown) if w > 0]
    drawn = docs.withColumn(mark, first_draw(key, weights))
    after = F.least(F.col(mark), *more) if more else F.col(mark)
    return drawn.withColumns({"shard": F.col(f"{mark}.shard"), "grown_shard": after["shard"]}).drop(mark)


def moves(docs: DataFrame, before: Sequence[float], after: Sequence[float], id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose shard differs between two lists of weights, with ``from_shard`` and ``to_shard``."""
    key = key_text(F.col(id_col))
    placed = docs.withColumns({"from_shard": first_draw(key, before)["shard"], "to_shard": first_draw(key, after)["shard"]})
    return placed.where("from_shard <> to_shard")


def slots(placed: DataFrame, shards: int, id_col: str = "doc_id", chunk: int = 65_536) -> DataFrame:
    """``placed`` with ``slot``, gapless from 0 in each ``shard``, by MD5 of the key and then by all columns in order.

    Rows are numbered in blocks of leading bits of that hash, at most ``BLOCKS`` in all, and only the blocks' counts are
    summed along a shard. Equal rows are counted first and dealt out again by ``chunk`` at a time, so a key that holds
    most rows is no block's burden. Columns must be orderable; leave texts behind. Own columns ``slot`` are replaced.
    """
    placed = placed.drop("slot")
    n, start, order, block, part = (free_name(placed, c) for c in ("n", "start", "order", "block", "part"))
    bits = max(0, (BLOCKS // shards).bit_length() - 1)
    counted = materialise(placed.groupBy(*placed.columns).agg(F.count(F.lit(1)).alias(n)), "shard-rows")
    hashed = counted.withColumn(order, _leading(F.md5(key_text(F.col(id_col))), ORDER_DIGITS)).withColumn(block, F.shiftright(F.col(order), 4 * ORDER_DIGITS - bits).cast("int"))
    pieces = hashed.withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(chunk).cast("long")))).withColumn(n, F.least(F.col(n) - F.col(part), F.lit(chunk)))
    before = lambda w: F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    firsts = hashed.groupBy("shard", block).agg(F.sum(n).alias(n)).select(F.col("shard"), block, before(Window.partitionBy("shard").orderBy(block)).alias(start))
    inside = Window.partitionBy("shard", block).orderBy(order, *placed.columns, part)
    dealt = pieces.join(F.broadcast(firsts), ["shard", block]).withColumn(start, F.col(start) + before(inside))
    spread = dealt.select(*placed.columns, start, n).repartition(F.col("shard"), F.col(start))
    return spread.withColumn("slot", F.explode(F.sequence(F.col(start), F.col(start) + F.col(n) - 1))).drop(start, n)


def write_shards(docs: DataFrame, folder: str, weights: Sequence[float], id_col: str = "doc_id") -> None:
    """``docs`` as Parquet under ``folder``, a subfolder ``shard=i`` for each shard that has rows.

    Rows move once; shards above the session's advisory partition size are split over tasks.
    """
    place(docs, weights, id_col).drop("grown_shard").hint("rebalance", "shard").write.partitionBy("shard").parquet(folder)
