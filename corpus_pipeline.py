"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept and returns documents with the same columns;
the last returns pieces of documents with their places in sequences.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.llm import (
    exact_dedup,
    language_id,
    near_dedup,
    packing,
    secret_scan,
)
from entitylake.llm.common import ship, table
from entitylake.operators.linkage import even_join
from entitylake.sources.scratch import staged

#: The stages cannot be expressed in SQL; tests compare them with brute force.
ORACLE_SQL = None


def _only(rows: DataFrame, chosen: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """``columns`` of the rows whose ``name``, never NULL, is listed; one row of each name.

    That is the one with the longest text, of these the one with the largest hash.  Both sides are
    dealt by the name for the join, and rows of one name then meet without another shuffle.
    """
    listed = chosen.select(F.col(name).alias("_listed")).distinct()
    met = rows.join(listed, F.col(name) == F.col("_listed"), "left_semi")
    longest = F.struct(F.length("text"), F.xxhash64("text"))
    best = met.groupBy(name).agg(F.max_by(F.struct(*columns), longest).alias("_best"))
    return best.select("_best.*")


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` and a ``_row`` for each distinct pair of id and text: a hash without collisions.

    Starts a job, and another with the next seed should two pairs have one hash.
    """
    for seed in itertools.count():
        rows = docs.withColumn("_row", F.xxhash64(F.lit(seed), "doc_id", F.coalesce("text", F.lit(""))))
        pair = F.struct(F.col("doc_id"), F.sha2(F.coalesce("text", F.lit("")), 256))
        spread = rows.groupBy("_row").agg(F.min(pair).alias("a"), F.max(pair).alias("b"))
        if not spread.where("not (a <=> b)").limit(1).count():
            return rows


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: those without any letter."""
    ship(spark)
    model = language_id.train(docs, "text", "lang", "doc_id")
    if not model.languages:  # nothing to learn from: no language can be told apart
        return docs.where(F.col("text").rlike(r"\p{L}"))
    known = docs.withColumn("_language", language_id.predict(model, F.col("text")))
    return known.where(F.col("_language.lang_pred") != language_id.UNDETERMINED).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts: the row that the operator keeps.

    The name of a row is its id, which may be missing, and its text's digest; ids alone say nothing,
    as distinct texts may share one.
    """
    ship(spark)

    def named(rows: DataFrame, digest: Column) -> DataFrame:
        return rows.withColumn("_name", F.concat_ws("|", F.col("doc_id").cast("string"), digest))

    kept = exact_dedup.exact_duplicates(docs).where("kept")
    rows = named(docs, exact_dedup.text_digest(F.col("text")))
    return _only(rows, named(kept, F.col("text_sha256")), "_name", docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by near copies: five words, similarity of 0.8.

    Rows are compared under numbers of their own, so that those without an id, and those that share
    one, are linked by their texts alone.  The smallest id of a group stays, a missing one last.
    """
    ship(spark)
    rows = _numbered(docs)
    found = near_dedup.near_duplicates(rows, key="_row", words=5, percent=80)
    found = found.select(F.col("doc_id").alias("_row"), "component_id").distinct()
    ids = even_join(found, rows.select("_row", "doc_id").distinct(), ["_row"])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id"), F.col("_row")))
    kept = ids.groupBy("component_id").agg(first["_row"].alias("_row"))
    return _only(rows, kept, "_row", docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blanks secrets; ``n_chars`` follows the text."""
    ship(spark)
    found = secret_scan.scan(docs, secret_scan.train(docs))
    clean = secret_scan.redact(found)
    size = F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", size).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens.

    Executors still hold what the stages before took, so that fewer words are remembered.
    """
    ship(spark)
    return packing.pack(packing.token_pieces(docs, with_ids=False, kept=100_000, portion_bytes=1 << 20))


STAGES = [
    ("language ID", language),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("secret scans", secrets),
    ("best-fit packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
