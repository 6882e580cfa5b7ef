"""Entities kept up to date while documents arrive in any order.

A crosswalk may land long before or after the attributes it lists.  Every batch is therefore reduced to
facts (attribute values, listed URIs, reference ids), which are stored by a hash of the entity that
their URI names.  The entities a batch touches are then linked anew from all facts known about them, old
and new, and their rows replace the earlier ones; other entities are neither read nor written.  The
result equals the batch plan over all documents so far, whatever the chunks.

Facts count as a set: a document that lands twice changes nothing.  Each batch is one commit of facts, rows
and the list of touched entities, so readers see whole batches, and a batch that runs again, after a
failure at any point, is stored once.  After ``compact_every`` commits each dataset is rewritten to a
single folder, in the same commit.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from entitylake.functions.membership import membership
from entitylake.functions.paths import attribute_paths
from entitylake.functions.uri import attribute_name, entity_id
from entitylake.operators.crosswalk import crosswalk_uri_table
from entitylake.operators.linkage import (
    even_join,
    largest_value_per_uri,
    reference_id_join,
    uri_join,
)
from entitylake.operators.melt import LONG_COLUMNS, melt_single, reference_ids
from entitylake.operators.pivot import SINGLE_KEYS, pivot_single
from entitylake.sources.manifest import Commit, Manifest
from entitylake.sources.scratch import discard, staged

NAMED = 1000  # names of attributes that links are looked up among
#: a batch of few files that cannot be split is written in parts that can be read beside each other
GROUPED = {"parquet.block.size": 8 << 20}

ATTRIBUTE, LISTED, REFERENCE = "attribute", "listed", "reference"
_TEXTS = ("kind", "entity", *LONG_COLUMNS, "sourceid", "cross_value", "cross_source")
FACTS = StructType(
    [*[StructField(n, StringType()) for n in _TEXTS], StructField("bucket", IntegerType())]
)
TOUCHED = StructType([StructField("entity", StringType()), StructField("version", LongType())])


def _owner(uri: str) -> Column:
    """The entity that a URI names, as a key that is never NULL."""
    return F.coalesce(entity_id(uri), F.lit(""))


@dataclass(frozen=True)
class EntityState:
    """The entity dataset of a stream below ``base``; the arguments are those of ``entity_wide``."""

    base: str
    paths: Sequence[str | Mapping[str, str]]
    names: Sequence[str]
    reference_path: str
    reference_name: str = "ReferenceId"
    prefer: str = "value"
    how: str = "inner"
    buckets: int = 64
    compact_every: int = 16
    stamps: Mapping[str, str] = field(default_factory=dict)

    def facts(self, docs: DataFrame) -> DataFrame:
        """What ``docs`` say: one row shape for all three kinds.  Facts may be said more than once."""
        listed = [p for p in attribute_paths(self.paths) if p.path.lower() != self.reference_path.lower()]
        parts = {
            ATTRIBUTE: largest_value_per_uri(melt_single(docs, listed, self.prefer, keep_empty=False)),
            LISTED: crosswalk_uri_table(docs, keep_empty=False),
            REFERENCE: reference_ids(docs, self.reference_path, self.prefer),
        }
        rows = None
        for kind, part in parts.items():
            part = part.where(F.col("uri").isNotNull())
            part = part.withColumns({"kind": F.lit(kind), "entity": _owner("uri")})
            rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
        bucket = F.pmod(F.hash("entity"), F.lit(self.buckets)).alias("bucket")
        return rows.select(*[F.col(n).cast("string").alias(n) for n in _TEXTS], bucket)

    def linked(self, facts: DataFrame, touched: DataFrame | None = None) -> DataFrame:
        """The entity rows that follow from facts, with their entity as ``entity``.

        With ``touched``, rows ``(entity, bucket)``, only those of the entities there.  A link has the entity of the
        attribute that it meets, so attributes alone, which are few beside the links, are looked up there.
        """

        def of(kind: str) -> DataFrame:
            rows = facts.where(F.col("kind") == kind)
            return rows if touched is None else even_join(rows, touched, ["entity", "bucket"], "left_semi")

        attributes = largest_value_per_uri(of(ATTRIBUTE).select(*LONG_COLUMNS))
        # a link that was said twice changes no maximum, so it is not worth a shuffle of all links
        links = self._promising(facts, touched).select("uri", "sourceid", "cross_value", "cross_source")
        names = [n for n in self.names if n != self.reference_name]
        single = pivot_single(uri_join(links, attributes), names)
        ids = of(REFERENCE).select(*LONG_COLUMNS).distinct()
        columns = [*names, *SINGLE_KEYS, self.reference_name]
        rows = reference_id_join(single, ids, self.reference_name, columns, self.how, **self.stamps)
        return rows.withColumn("entity", F.coalesce("EntityID", F.lit("")))

    @staticmethod
    def _promising(facts: DataFrame, touched: DataFrame | None) -> DataFrame:
        """The links that may meet an attribute, told before they are shuffled.

        Equal URIs name one attribute and one entity.  So a link is left out when no attribute fact has its name, and,
        where few entities are touched, when its entity is surely not among them.  Starts jobs that count both.
        """
        links = facts.where(F.col("kind") == LISTED)
        said = facts.where(F.col("kind") == ATTRIBUTE).select(attribute_name("uri").alias("name")).distinct()
        names = {r.name for r in said.limit(NAMED + 1).collect()}
        if len(names) <= NAMED:
            name = attribute_name("uri")
            known = F.coalesce(name.isin(sorted(names - {None})), F.lit(False))
            links = links.where(known | name.isNull() if None in names else known)
        if touched is not None:
            hashes = touched.select(F.xxhash64("entity").alias("hash"))
            may = membership(hashes, "hash", hashes.count())
            links = links if may is None else links.where(may(F.xxhash64("entity")))
        return links

    @property
    def schema(self) -> StructType:
        names = [n for n in self.names if n != self.reference_name]
        texts = [*names, *SINGLE_KEYS, self.reference_name, *self.stamps, "entity"]
        return StructType([*[StructField(n, StringType()) for n in texts], StructField("version", LongType())])

    def store(self, batch: DataFrame, run: str, number: int) -> Commit:
        """Take in batch ``number`` of the stream ``run``; one that is stored already is left alone."""
        spark = batch.sparkSession
        manifest = Manifest(spark, self.base)
        latest = manifest.read()
        batches = dict(latest.notes["batches"]) if latest else {}
        if latest and batches.get(run, -1) >= number:
            return latest
        version = latest.version + 1 if latest else 0
        batches[run] = number
        known = {n: list(latest.datasets[n]) if latest else [] for n in ("facts", "entities", "touched")}

        def write(name: str, rows: DataFrame, by: Sequence[str] = ()) -> str:
            folder = manifest.folder(name)
            rows.write.option("compression", "zstd").partitionBy(*by).parquet(manifest.absolute(folder))
            return folder

        docs = staged(batch, "batch", compression="zstd", **GROUPED)
        facts = write("facts", self.facts(docs).hint("rebalance", "bucket"), ["bucket"])
        discard(docs)
        known["facts"].append(facts)
        fresh = spark.read.schema(FACTS).parquet(manifest.absolute(facts))
        touched = staged(fresh.select("entity", "bucket").distinct(), "touched")
        buckets = [r.bucket for r in touched.select("bucket").distinct().collect()]
        if buckets:
            draft = Commit(version, known, {})
            about = manifest.dataset("facts", FACTS, draft).where(F.col("bucket").isin(buckets))
            mark = F.lit(version).cast("long").alias("version")
            rows = self.linked(about, touched).select(*self.schema.names[:-1], mark)
            known["entities"].append(write("entities", rows))
            known["touched"].append(write("touched", touched.select("entity", mark)))
        discard(touched)
        if len(known["facts"]) >= self.compact_every:
            draft = Commit(version, known, {})
            every = manifest.dataset("facts", FACTS, draft).distinct().hint("rebalance", "bucket")
            rows = self._latest(manifest, draft).hint("rebalance")
            marks = self._marks(manifest, draft).hint("rebalance")
            known = {
                "facts": [write("facts", every, ["bucket"])],
                "entities": [write("entities", rows)], "touched": [write("touched", marks)],
            }
        return manifest.commit(version, known, {"batches": batches})

    @staticmethod
    def _marks(manifest: Manifest, commit: Commit | None) -> DataFrame:
        marks = manifest.dataset("touched", TOUCHED, commit)
        return marks.groupBy("entity").agg(F.max("version").alias("version"))

    def _latest(self, manifest: Manifest, commit: Commit | None) -> DataFrame:
        rows = manifest.dataset("entities", self.schema, commit)
        if commit is None or len(commit.datasets["entities"]) < 2:
            return rows  # one folder holds one row set per entity
        return even_join(rows, self._marks(manifest, commit), ["entity", "version"]).select(*rows.columns)

    def current(self, spark: SparkSession) -> DataFrame:
        """The entity dataset as of the latest batch."""
        manifest = Manifest(spark, self.base)
        return self._latest(manifest, manifest.read()).drop("entity", "version")


def keep_entities(
    docs: DataFrame, state: EntityState, checkpoint: str, wait: bool = True
) -> StreamingQuery:
    """Take in every batch of a document stream until nothing new has landed."""

    def store(batch: DataFrame, number: int) -> None:
        (metadata,) = batch.sparkSession.read.text(f"{checkpoint}/metadata").collect()
        state.store(batch, json.loads(metadata.value)["id"], number)

    query = (
        docs.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query
