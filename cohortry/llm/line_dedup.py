"""Line deduplication with DataFrame functions only.

Lines are known by a 128-bit hash of their key. Document frequencies are counted with map-side combining; only lines
whose key is frequent enough go on. Those are range-partitioned by hash, sorted by document (largest id first) and
position, and a window streams the first occurrence of each. A key in very many documents is dealt over several
ranges, and its first document is the one that the count found. What comes back is a sparse bitmap per document, not text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.common import free_name, materialise, texts

BLANK = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased (other letters stay)."""
    bare = F.btrim(line, F.lit(BLANK))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def drop_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20, rows_per_range: int = 512) -> DataFrame:
    """Sparse bitmaps of the lines to drop: ``doc_id``, ``text_hash``, ``n_dropped``, ``words`` (array of word, bits).

    Bit ``i`` of the entry with ``word = w`` stands for line ``64 w + i``; lines without a set bit are kept, and words
    without one are left out. Only documents that lose a line have a row. A key of at least ``min_chars`` code points
    found in at least ``min_docs`` rows loses its lines except in the largest id that holds it.

    Nulls: a null text is one empty line; a null id counts as a document and is never the largest while another holds
    the key. Repeated rows count as documents of their own, and rows of the same id all keep the line when that id is
    the largest. An empty table gives no rows. Further columns are ignored.
    """
    rows = texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n").alias("lines"))
    long_enough = lambda k: F.char_length(k) >= min_chars
    once = rows.select("doc_id", F.explode(F.array_distinct(F.filter(F.transform("lines", line_key), long_enough))).alias("key"))
    # written down, so that the join below may split the lines of a hot key over tasks
    frequent = materialise(
        once.select("doc_id", *_hashes(F.col("key")))
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("newest"))
        .where(F.col("n") >= min_docs),
        "frequent-lines",
    )
    places = rows.select("doc_id", "text_hash", F.posexplode("lines").alias("pos", "line")).withColumn("key", line_key(F.col("line"))).where(long_enough(F.col("key")))
    spread = F.ceil(F.col("n") / F.lit(rows_per_range))
    found = (
        places.select("doc_id", "text_hash", "pos", *_hashes(F.col("key")))
        .join(frequent, ["h1", "h2"])
        .withColumn("range", F.pmod(F.xxhash64("doc_id", "text_hash"), spread))
        .repartitionByRange("h1", "h2", "range")
    )
    stream = Window.partitionBy("h1", "h2", "range").orderBy(F.desc_nulls_last("doc_id"), "pos").rowsBetween(Window.unboundedPreceding, 0)
    first = F.when(spread > 1, F.col("newest")).otherwise(F.first("doc_id").over(stream))
    lost = found.withColumn("first_doc", first).where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    bit = F.expr("shiftleft(1L, cast(pos % 64 as int))")
    words = lost.groupBy("doc_id", "text_hash", (F.col("pos") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("doc_id", "text_hash").agg(F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"), F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))


def dense_words(words: Column) -> Column:
    """The bits of a sparse bitmap as an array that is read by place, with a zero for each word left out before the last."""
    places = F.transform(words, lambda w: w["word"])
    before = F.slice(F.concat(F.array(F.lit(-1)), places), F.lit(1), F.size(places))
    zeros = lambda w, last: F.array_repeat(F.lit(0).cast("long"), w["word"] - last - 1)
    return F.flatten(F.zip_with(words, before, lambda w, last: F.concat(zeros(w, last), F.array(w["bits"]))))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped``, ``kept_text`` and ``drop_words`` (the bitmap) beside its own columns.

    Own columns of those names are replaced. The bitmaps meet their documents again by id and text, nulls included.
    """
    mark = free_name(docs, "mark")
    marks = drop_bitmaps(docs, id_col, text_col, min_docs, min_chars).select(F.struct("doc_id", "text_hash", "n_dropped", "words", dense_words(F.col("words")).alias("bits")).alias(mark))
    text, of = F.coalesce(F.col(text_col), F.lit("")), lambda c: F.col(f"{mark}.{c}")
    joined = docs.join(marks, F.col(id_col).cast("long").eqNullSafe(of("doc_id")) & (F.xxhash64(text) == of("text_hash")), "left")
    stays = lambda _, i: F.getbit(F.coalesce(F.get(of("bits"), (i / 64).cast("int")), F.lit(0).cast("long")), i % 64) == 0
    kept = F.array_join(F.filter(F.split(text, "\n"), stays), "\n")
    added = {
        "n_lines": (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long"),
        "n_dropped": F.coalesce(of("n_dropped"), F.lit(0)).cast("long"),
        "kept_text": F.when(of("n_dropped").isNull(), text).otherwise(kept),
        "drop_words": of("words"),
    }
    return joined.withColumns(added).drop(mark)
