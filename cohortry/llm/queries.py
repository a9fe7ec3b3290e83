"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm import centroids, decontamination, filter_audit, fingerprints, line_dedup, lm_scoring, pii, sentencepiece, sharding, simhash_dedup, token_store, toxicity, url_filter
from cohortry.llm.common import materialise, shared_folder, table


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file; only the driver reads it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = materialise(fingerprints.with_edited(table(spark, sf_dir, "documents")), "edited-fingerprints")
    asked = F.col("doc_id") % 100 == 0
    near = fingerprints.count_within(found.where(asked), found).withColumnsRenamed({"low": "q_low", "high": "q_high"})
    as_hex = lambda high, low: F.concat(*(F.lpad(F.lower(F.hex(c)), 16, "0") for c in (high, low)))
    # n_near: of the rows whose id is divisible by 100, how many other rows are within three bits; null for the others
    return found.join(near, asked & (F.col("low") == F.col("q_low")) & (F.col("high") == F.col("q_high")), "left").select(
        "doc_id", "n_chars", "edited_sha256", as_hex("high", "low").alias("fingerprint"), as_hex("edited_high", "edited_low").alias("edited_fingerprint"), "near_edited", "near_next", "n_near"
    )


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    scored = lm_scoring.score_all(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"))
    return judged.withColumn("host_words", F.array_join("host_words", " "))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/token-store-{uuid.uuid4().hex}"
    encoder = token_store.byte_bpe(tokenizer_file("byte_bpe_50k.json"))
    token_store.write(table(spark, sf_dir, "documents"), folder, encoder, vocabulary=50_257)
    return token_store.read_all(token_store.open_store(spark, folder))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"), with_text=False)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, machine)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"))
    placed = sharding.place(rows, [1.0] * 24, grown=[1.0])
    return sharding.slots(placed, 24)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.lloyd(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, list_extract(string_split(coalesce(text, ''), chr(10)), i) AS line
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)
), keyed AS (
  SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), frequent AS (
  SELECT k, max(doc_id) AS newest FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT keyed.doc_id, i, line, newest IS NOT NULL AND newest <> keyed.doc_id AS gone FROM keyed LEFT JOIN frequent USING (k)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# the checksum goes bit by bit; list_reduce starts from the first element
OP11_SQL = """
WITH draws AS (
  SELECT doc_id, shard, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || shard), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) AS draw
  FROM (SELECT DISTINCT doc_id FROM documents), (SELECT unnest(range(25)) AS shard)
), placed AS (
  SELECT doc_id, arg_min(shard, draw) FILTER (WHERE shard < 24) AS shard, arg_min(shard, draw) AS grown_shard FROM draws GROUP BY doc_id
), bits AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size,
    flatten(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: list_transform(range(8), lambda i: (('0x' || h)::BIGINT >> i) & 1))) AS bits
  FROM documents
), sums AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bits), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) AS text_crc32 FROM bits
)
SELECT s.doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard, grown_shard::INTEGER AS grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY substr(md5(coalesce(s.doc_id::VARCHAR, '')), 1, 15), s.doc_id, size, text_crc32) - 1 AS slot
FROM sums s JOIN placed p ON s.doc_id IS NOT DISTINCT FROM p.doc_id
"""


def _lloyd_sql(k: int = 16, rounds: int = 3) -> str:
    """Plain Lloyd as a chain of common table expressions, two for each round."""
    far = "list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    near = f"SELECT v.at, v.vec_id, any_value(v.q) AS q, min({{}}) AS distance, arg_min(c.cluster, ({{}}, c.cluster)) AS cluster FROM kept v, c{{}} c GROUP BY v.at, v.vec_id"
    steps = [
        "kept AS (SELECT row_number() OVER () AS at, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), q) - 1 AS cluster, q FROM kept ORDER BY cluster LIMIT {k})",
    ]
    for r in range(rounds + 1):
        steps.append(f"a{r} AS ({near.format(far, far, r)})")
        if r < rounds:
            floored = "((sum(q[i]) - ((sum(q[i]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT"
            spread = f"SELECT cluster, i, {floored} AS x FROM (SELECT cluster, q, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY cluster, i"
            steps.append(f"c{r + 1} AS (SELECT o.cluster, coalesce(n.q, o.q) AS q FROM c{r} o LEFT JOIN (SELECT cluster, list(x ORDER BY i) AS q FROM ({spread}) GROUP BY cluster) n USING (cluster))")
    return f"""WITH {', '.join(steps)}
SELECT vec_id, a.cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (cluster)"""


OP13_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), texts AS (
  SELECT doc_id, part, text, len(w) AS n, len(list_distinct(w)) AS n_distinct FROM words
), failed AS (
  SELECT doc_id, part,
    (n < 100)::INT + 2 * (100 * n_distinct < 80 * n)::INT
    + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text))::INT + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), min(doc_id) OVER (PARTITION BY text) IS NOT NULL)::INT AS mask
  FROM texts
), marked AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, mask, count(*) AS docs, coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS toxic FROM failed LEFT JOIN marked USING (doc_id) GROUP BY part, mask
), orders AS (
  SELECT '' AS filter_order UNION ALL
  SELECT filter_order || f FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) WHERE NOT contains(filter_order, f)
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS filter, 1 << (ascii(substr(filter_order, step, 1)) - 65) AS own,
    list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(filter_order, i::INT, 1)) - 65))) AS earlier
  FROM orders, (SELECT unnest(range(1, 6))::INT AS step) WHERE length(filter_order) = 5
), counted AS (
  SELECT part, filter_order, step, filter,
    sum(docs) FILTER (WHERE mask & (own | coalesce(earlier, 0)::INT) = 0) AS kept,
    sum(docs) FILTER (WHERE mask & own > 0 AND mask & coalesce(earlier, 0)::INT = 0) AS removed,
    sum(docs) FILTER (WHERE mask & own > 0 AND mask & coalesce(earlier, 0)::INT > 0) AS redundant,
    sum(docs) FILTER (WHERE mask = own) AS unique_fails,
    sum(good) FILTER (WHERE mask & own > 0 AND mask & coalesce(earlier, 0)::INT = 0) AS good_lost,
    sum(toxic) FILTER (WHERE mask & own > 0 AND mask & coalesce(earlier, 0)::INT = 0) AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, filter), 0)::BIGINT AS shapley
FROM counted
"""

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_fingerprints": op2_fingerprints,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_url_filter": op5_url_filter,
    "op6_token_store": op6_token_store,
    "op7_line_dedup": op7_line_dedup,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_pii": op9_pii,
    "op10_toxicity": op10_toxicity,
    "op11_sharding": op11_sharding,
    "op12_centroids": op12_centroids,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL = {
    "op7_line_dedup": OP7_SQL,
    "op11_sharding": OP11_SQL,
    "op12_centroids": _lloyd_sql(),
    "op13_filter_audit": OP13_SQL,
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it uses this module's settings

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
