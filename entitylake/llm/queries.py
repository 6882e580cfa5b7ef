"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.llm import (
    byte_bpe,
    exact_dedup,
    hard_negatives,
    language_id,
    near_dedup,
    order_minhash,
    packing,
    quality_mil,
    quality_rules,
    secret_scan,
    sharding,
    warc,
    whitening,
)
from entitylake.llm.common import table
from entitylake.sources.scratch import scratch_path

SHARDS = 24
QUALITY_THRESHOLD = 0.3


def _remainder(key: str, modulus: int) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, folder, "documents"), with_ids=False)
    return packing.pack(pieces)


def op2_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    known = warc.headers(table(spark, folder, "pages"), "page_id", "url", "html")
    path = scratch_path(spark, "archives")
    run = warc.write_archives(warc.resolved(known), path)
    back = warc.read_archives(spark, path, run)
    digest = F.when(
        F.col("html").isNotNull(), F.sha1(F.encode("html", "UTF-8"))
    ).otherwise(F.col("digest"))
    size = F.coalesce(F.octet_length("html").cast("long"), F.col("payload_bytes"))
    return back.select(
        F.col("page_id").cast("long").alias("page_id"), size.alias("payload_bytes"),
        digest.alias("payload_digest"), "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.digests(byte_bpe.round_trip(table(spark, folder, "documents")))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = secret_scan.train(documents)
    found = secret_scan.scan(documents.select("doc_id", "text"), model)
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        *[
            F.size(F.filter("secrets", lambda s: s["kind"] == i)).cast("long").alias(f"n_{kind}")  # noqa: B023
            for i, kind in enumerate(secret_scan.KINDS[:3])
        ],
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("secrets")).alias("spans"),
    )


def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), words=3, percent=85)


def op6_hypergeometric_shards(spark: SparkSession, folder: str) -> DataFrame:
    # digests are of the texts that arrived at their places
    placed = sharding.shuffled_shards(table(spark, folder, "documents"), SHARDS)
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return placed.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_quality_mil(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(_remainder("doc_id", 5) != 0)
    model = quality_mil.train(documents, labels, "doc_id", "text", "quality")
    scored = documents.select("doc_id", quality_mil.quality(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id", (_remainder("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = _remainder("doc_id", 3) == 1
    model = language_id.train(documents.where(~held_out), "text", "lang", "doc_id")
    return language_id.with_language(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score"
    )


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules.assessed(documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def op11_lanczos_whitening(spark: SparkSession, folder: str) -> DataFrame:
    data = whitening.vectors(table(spark, folder, "embeddings"), "vec_id", "embedding", scale=1024)
    model = whitening.fit(data, components=8)
    whitened = whitening.whiten(data, model, "vec_id")
    error = whitening.identity_error(whitened, len(model.variances))
    rows = whitening.component_rows(whitened, model, "vec_id", "deviation")
    return rows.select(
        "vec_id", "component", F.lit(model.rows).cast("long").alias("n"), "deviation", "whitened",
        "explained", F.lit(error).alias("identity_error"),
    )


def op12_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    pairs = order_minhash.with_following(documents, "doc_id", "text")
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    head = F.substring(F.col("text"), F.lit(1), size - half)
    edited = F.concat(head, F.substring(F.col("next_text"), F.lit(1), half))
    # the edited text is read twice: as columns of their own the two readers share it
    made = pairs.select("doc_id", "fingerprint", "next_fingerprint", size.cast("long").alias("n_chars"),
                        edited.alias("edited"))
    made = made.withColumn("edited_fingerprint", order_minhash.fingerprint(F.col("edited")))
    return made.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        order_minhash.as_hex(F.col("fingerprint")).alias("fingerprint"),
        order_minhash.as_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        order_minhash.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        order_minhash.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = table(spark, folder, "embeddings")
    key, label = F.col("vec_id"), F.col("label").cast("long")
    shifted = F.when(key % 7 == 0, F.pmod(label + 1, F.lit(10))).otherwise(label)
    return hard_negatives.mined(embeddings, "vec_id", "embedding", shifted, key % 100 == 0)


SQL_OP2 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
r AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
                 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes)
                 ELSE page_id END AS first_id
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       nullif(first_id, page_id) AS refers_to
FROM r
"""

SQL_OP10 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT norm, first(doc_id ORDER BY chars DESC, doc_id) AS keep_id, count(*) AS group_size
  FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM d JOIN g USING (norm)
"""

SQL_OP13 = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
         list_dot_product(a.v, r.v)::BIGINT AS score
  FROM e AS a JOIN e AS r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
  SELECT p.*, other_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""

CASES = {
    "op1_best_fit_packing": (op1_best_fit_packing, None),
    "op2_warc_revisits": (op2_warc_revisits, SQL_OP2),
    "op3_byte_bpe": (op3_byte_bpe, None),
    "op4_secret_scan": (op4_secret_scan, None),
    "op5_minhash_near_dedup": (op5_minhash_near_dedup, None),
    "op6_hypergeometric_shards": (op6_hypergeometric_shards, None),
    "op7_quality_mil": (op7_quality_mil, None),
    "op8_language_id": (op8_language_id, None),
    "op9_quality_rules": (op9_quality_rules, None),
    "op10_exact_dedup": (op10_exact_dedup, SQL_OP10),
    "op11_lanczos_whitening": (op11_lanczos_whitening, None),
    "op12_order_minhash": (op12_order_minhash, None),
    "op13_hard_negatives": (op13_hard_negatives, SQL_OP13),
}
