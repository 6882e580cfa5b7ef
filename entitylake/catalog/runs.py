"""Queries over datasets that are kept up to date, run by run or batch by batch."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.catalog.attributes import CITY, COUNTRY, RANK, SINGLE_PATHS
from entitylake.catalog.facts import ATTRIBUTES, NESTED
from entitylake.catalog.links import ENTITIES, NAMES, STAMPS
from entitylake.functions.paths import attribute_paths
from entitylake.operators.columns import conform_columns
from entitylake.operators.upkeep import PivotState
from entitylake.plans.entity import groups_wide, linked_tagged, single_of
from entitylake.samples.documents import (
    DOCUMENT_SCHEMA,
    crosswalk_documents,
    customer_documents,
    entity_documents,
    table,
)
from entitylake.sources.compaction import compact_landing, compacted_folders
from entitylake.sources.documents import narrow_schema, read_documents
from entitylake.sources.manifest import Manifest, publish
from entitylake.sources.scratch import scratch_path, staged
from entitylake.streaming.archive import archive_consumed, archive_state
from entitylake.streaming.intake import append_available, document_stream
from entitylake.streaming.linked import EntityState, keep_entities


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Leave a stream as it is when it dies after storing a batch: the batch will run again."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    numbered = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().isdigit()]
    files.delete(max(numbered, key=lambda p: int(p.getName())), False)


def streamed_entities(spark: SparkSession, sf: str) -> DataFrame:
    """The entity dataset from documents whose attributes and crosswalks land in different chunks.

    Attributes of odd customers land first, then all crosswalks, then the other attributes, as compressed
    JSON Lines.  The last batch is run again.
    """
    landing, checkpoint, base = (scratch_path(spark, n) for n in ("landing", "checkpoint", "entities"))
    customers = customer_documents(spark, sf, (F.col("c_custkey") % 2 == 1).alias("odd"))
    odd, even = (customers.where(c).drop("odd") for c in ("odd", "not odd"))
    state = EntityState(
        base, SINGLE_PATHS, NAMES, "attributes.ReferenceId", stamps=STAMPS, buckets=8
    )
    for docs in (odd, crosswalk_documents(spark, sf), even):
        docs.repartition(2, "uri").write.mode("append").json(landing, compression="lz4")
    for _ in range(2):
        stream = document_stream(spark, landing, DOCUMENT_SCHEMA, chunk_size=2, layout="lines")
        keep_entities(stream, state, checkpoint)
        forget_last_commit(spark, checkpoint)
    return state.current(spark)


def compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Customer documents that landed as 64 small files, in two lots, read back from their compaction, with
    the number of the compaction that took them and of the files it wrote.  Each compaction runs twice."""
    landing, base = (scratch_path(spark, n) for n in ("landing", "compacted"))
    lots = customer_documents(spark, sf, (F.col("c_custkey") % 2).alias("lot"))
    written = []
    for lot in (0, 1):
        lots.where(F.col("lot") == lot).drop("lot").repartition(32, "uri").write.mode("append").json(landing)
        for _ in range(2):
            commit = compact_landing(spark, landing, base, target_bytes=1 << 30)
        written.append(commit.notes["written"])
    schema = narrow_schema(DOCUMENT_SCHEMA, ["uri", "attributes.Name.value"])
    rows = None
    for number, folder in enumerate(compacted_folders(spark, base)):
        docs = read_documents(spark, folder, schema, layout="lines")
        part = docs.select(
            "uri", F.get("attributes.Name.value", F.lit(0)).alias("name"), F.lit(number).alias("run"),
            F.lit(written[number]).alias("files"),
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


COMPACTED = """
SELECT 'entities/' || c_custkey AS uri, CASE WHEN c_acctbal >= 0 THEN c_name END AS name,
       CAST(c_custkey % 2 AS INTEGER) AS run, 1 AS files
FROM customer"""


def archived(spark: SparkSession, sf: str) -> DataFrame:
    """Documents read back from the archive with the batch that consumed their file.

    Three lots of files land.  The stream dies after storing the second, when only the first may be
    archived; it runs that batch again, then the third, and the archiver takes the rest.
    """
    landing, checkpoint, target, archive = (
        scratch_path(spark, n) for n in ("landing", "checkpoint", "target", "archive")
    )
    lots = customer_documents(spark, sf, (F.col("c_custkey") % 3).alias("lot"))

    def land(number: int) -> None:
        rows = lots.where(F.col("lot") == number).drop("lot")
        rows.repartition(2, "uri").write.mode("append").json(landing)

    def run() -> None:
        docs = document_stream(spark, landing, DOCUMENT_SCHEMA, chunk_size=2, layout="lines")
        append_available(docs.select("uri"), target, checkpoint)

    land(0)
    land(1)
    run()
    forget_last_commit(spark, checkpoint)
    archive_consumed(spark, landing, archive, checkpoint)
    land(2)
    run()
    for _ in range(2):
        archive_consumed(spark, landing, archive, checkpoint)
    state = archive_state(spark, landing, archive, checkpoint)
    docs = spark.read.schema("uri string").json(archive).select(
        "uri", F.regexp_extract(F.input_file_name(), "([^/]*)$", 1).alias("file")
    )
    return docs.join(state, "file").select("uri", "batch", "state")


GROUPS = {"place": [CITY, RANK], "land": [COUNTRY]}


def published(spark: SparkSession, sf: str) -> DataFrame:
    """The entity dataset and two group datasets, published by a run that fails between the groups and is
    then repeated, twice."""
    docs = entity_documents(spark, sf)
    tagged = staged(linked_tagged(docs, SINGLE_PATHS, NAMES, GROUPS), "tagged")
    wide = staged(groups_wide(tagged, GROUPS), "groups")

    def group(name: str) -> DataFrame:
        leaves = [p.leaf for p in attribute_paths(GROUPS[name])]
        rows = wide.where(F.col("attribute_group") == name)
        return rows.select("UniqueId", "cross_source", *leaves)

    frames = {"entity": single_of(tagged, NAMES), "place": group("place"), "land": group("land")}
    broken = frames["land"].withColumn("Country", F.raise_error(F.lit("lost")).cast("string"))
    manifest = Manifest(spark, scratch_path(spark, "published"))
    try:
        publish(manifest, 1, frames | {"land": broken})
    except PySparkException:
        assert manifest.read() is None  # what was written is not seen
    for _ in range(2):
        publish(manifest, 1, frames)
    columns = ["cross_source", "UniqueId", "Name", "Segment", "City", "Rank", "Country"]
    rows = None
    for name, frame in frames.items():
        part = conform_columns(
            manifest.dataset(name, frame.schema).select(*[c for c in columns if c in frame.columns]),
            columns, allow_missing=True,
        ).withColumn("dataset", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    return rows


PUBLISHED = f"""
WITH {NESTED}, {ATTRIBUTES},
single AS (
  SELECT source AS cross_source, cross_value, sid, split_part(a.uri, '/', 2) AS entity,
         max(value) FILTER (WHERE label = 'UniqueId') AS "UniqueId",
         max(value) FILTER (WHERE label = 'Name') AS "Name",
         max(value) FILTER (WHERE label = 'Segment') AS "Segment"
  FROM listed JOIN (SELECT uri, value, 'Name' AS label FROM name_attr
                    UNION ALL SELECT uri, value, 'Segment' FROM segment_attr
                    UNION ALL SELECT uri, value, 'UniqueId' FROM unique_attr) AS a USING (uri)
  GROUP BY ALL),
pivoted AS (
  SELECT source AS cross_source, split_part(n.uri, '/', 5) AS instance, cross_value,
         split_part(n.uri, '/', 2) AS entity, label = 'Country' AS land,
         max(value) FILTER (WHERE label = 'City') AS "City",
         max(value) FILTER (WHERE label = 'Rank') AS "Rank",
         max(value) FILTER (WHERE label = 'Country') AS "Country"
  FROM listed JOIN nested_attrs AS n ON listed.uri = n.uri GROUP BY ALL)
SELECT cross_source, "UniqueId", "Name", "Segment", NULL::VARCHAR AS "City", NULL::VARCHAR AS "Rank",
       NULL::VARCHAR AS "Country", 'entity' AS dataset FROM single
UNION ALL SELECT cross_source, 'U' || entity, NULL, NULL, "City", "Rank", "Country",
       CASE WHEN land THEN 'land' ELSE 'place' END FROM pivoted"""


def kept_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """Quantities and parts per order and supplier in three batches: all items, a withdrawal of
    the returned ones, late corrections of open ones.  Returned items of every third order had been
    withdrawn before they came."""
    state = PivotState(
        scratch_path(spark, "pivot"), ["l_orderkey", "l_suppkey"], ["Quantity", "Part"], buckets=8
    )
    items = table(spark, sf, "lineitem")
    returned, early = F.col("l_returnflag") == "R", F.col("l_orderkey") % 3 == 0

    def changes(rows: DataFrame, change: int, quantity: str = "l_quantity") -> DataFrame:
        part = F.struct(F.lit("Part").alias("name"), F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("value"))
        size = F.struct(
            F.lit(" quantity").alias("name"),
            F.lpad(F.expr(quantity).cast("int").cast("string"), 4, "0").alias("value"),
        )
        seen = rows.select("l_orderkey", "l_suppkey", F.explode(F.array(part, size)).alias("e"))
        return seen.select("l_orderkey", "l_suppkey", "e.*", F.lit(change).alias("change"))

    late = items.where(F.col("l_returnflag") == "N")
    batches = [
        changes(items.where(~(returned & early)), 1).unionByName(changes(items.where(returned & early), -1)),
        changes(items.where(returned & ~early), -1).unionByName(changes(items.where(returned & early), 1)),
        changes(late, -1).unionByName(changes(late, 1, "l_quantity + 1")),
    ]
    for number, batch in enumerate(batches):
        state.store(batch, number)
        state.store(batch, number)  # run again: stored once
    return state.current(spark)


KEPT_PIVOT = """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey,
       max(lpad(CAST(CAST(l_quantity + CASE l_returnflag WHEN 'N' THEN 1 ELSE 0 END AS INTEGER) AS VARCHAR),
                4, '0')) AS "Quantity",
       max(lpad(CAST(l_partkey AS VARCHAR), 8, '0')) AS "Part"
FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL"""

CASES = {
    "landing_compaction": (compacted, COMPACTED),
    "archive_files": (
        archived,
        "SELECT 'entities/' || c_custkey AS uri, c_custkey % 3 AS batch, 'archived' AS state FROM customer",
    ),
    "publish_run": (published, PUBLISHED),
    "pivot_incremental": (kept_pivot, KEPT_PIVOT),
    "stream_entities": (streamed_entities, ENTITIES),
}
