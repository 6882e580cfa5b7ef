"""Queries over sources, sinks, the run audit and the file stream.

Each writes to a path of its own in the shared folder and returns what it reads back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.catalog.attributes import CITY, COUNTRY, RANK, SINGLE_PATHS
from entitylake.catalog.facts import ATTRIBUTES, NESTED
from entitylake.catalog.links import NAMES
from entitylake.operators.columns import conform_columns, empty_frame
from entitylake.operators.melt import melt_single
from entitylake.plans.entity import groups_wide, linked_tagged
from entitylake.samples.documents import (
    DOCUMENT_SCHEMA,
    customer_documents,
    entity_documents,
    table,
)
from entitylake.sources.audit import audited_write
from entitylake.sources.documents import (
    CORRUPT,
    narrow_schema,
    read_documents,
    split_quarantine,
)
from entitylake.sources.scratch import scratch_path, staged
from entitylake.sources.sinks import write_csv, write_parquet, write_tagged
from entitylake.streaming.intake import append_available, document_stream

DOCS_PER_FILE = 512
LANDED = 6  # files that the stream takes in chunks of two


def _multiline_files(spark: SparkSession, sf: str, broken: bool = False) -> str:
    """Customer documents as multi-line files, each an array of at most ``DOCS_PER_FILE``.

    A file holds the documents of one range of customer keys, whatever files the table is stored in.
    With ``broken`` every fourth range is cut short.
    """
    path = scratch_path(spark, "multiline")
    text = F.to_json(F.struct("attributes", "crosswalks", "uri"), {"pretty": "true"})
    files = (
        customer_documents(
            spark, sf,
            F.expr(f"c_custkey div {DOCS_PER_FILE}").alias("number"),
        )
        .groupBy("number")
        .agg(F.collect_list(text).alias("texts"))
    )
    whole = F.concat(F.lit("[\n"), F.array_join("texts", ",\n"), F.lit("\n]"))
    cut = F.substring(whole, F.lit(1), F.length(whole) - 40)
    value = F.when(F.col("number") % 4 == 1, cut).otherwise(whole) if broken else whole
    files.select(value.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path


_NAMES = """
SELECT 'entities/' || c_custkey AS uri, CASE WHEN c_acctbal >= 0 THEN c_name END AS name
FROM customer"""


def _names(docs: DataFrame) -> DataFrame:
    return docs.select("uri", F.get("attributes.Name.value", F.lit(0)).alias("name"))


def multiline(spark: SparkSession, sf: str) -> DataFrame:
    schema = narrow_schema(DOCUMENT_SCHEMA, ["uri", "attributes.Name.value"])
    return _names(read_documents(spark, _multiline_files(spark, sf), schema))


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """One document per line, schema inferred."""
    path = scratch_path(spark, "lines")
    customer_documents(spark, sf).write.json(path)
    return _names(read_documents(spark, path, layout="lines"))


def without_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """A broken multi-line file is dropped whole."""
    schema = narrow_schema(DOCUMENT_SCHEMA, ["uri", "attributes.Name.value"])
    path = _multiline_files(spark, sf, broken=True)
    return _names(read_documents(spark, [path], schema, malformed="drop"))


def quarantined(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that came out, and the range of customers in the text kept of each broken file."""
    schema = narrow_schema(DOCUMENT_SCHEMA, ["uri"])
    path = _multiline_files(spark, sf, broken=True)
    good, bad = split_quarantine(read_documents(spark, path, schema, malformed="quarantine"))
    customer = F.regexp_extract(CORRUPT, r"entities/(\d+)", 1).cast("long")
    files = bad.select(customer.alias("customer"), "source_file").select(
        F.lit("broken file").alias("kind"),
        F.expr(f"cast(customer div {DOCS_PER_FILE} as string)").alias("name"),
        F.col("source_file").endswith(".txt").alias("has_file"),
    )
    documents = good.select(
        F.lit("document").alias("kind"), F.col("uri").alias("name"), F.lit(False).alias("has_file")
    )
    return documents.unionByName(files)


QUARANTINED = f"""
SELECT 'document' AS kind, 'entities/' || c_custkey AS name, false AS has_file FROM customer
WHERE c_custkey // {DOCS_PER_FILE} % 4 <> 1
UNION ALL
SELECT DISTINCT 'broken file', CAST(c_custkey // {DOCS_PER_FILE} AS VARCHAR), true FROM customer
WHERE c_custkey // {DOCS_PER_FILE} % 4 = 1"""


def streamed(spark: SparkSession, sf: str) -> DataFrame:
    """Documents land as files, are streamed in chunks, melted, appended and archived."""
    landing, checkpoint, target, archive = (
        scratch_path(spark, n) for n in ("landing", "checkpoint", "target", "archive")
    )
    customer_documents(spark, sf).repartition(LANDED, "uri").write.json(landing)
    docs = document_stream(
        spark, landing, DOCUMENT_SCHEMA, chunk_size=2, archive=archive, layout="lines"
    )
    for _ in range(2):  # the second run finds nothing new
        append_available(melt_single(docs, SINGLE_PATHS, keep_empty=False), target, checkpoint)
    return spark.read.parquet(target)


_LONG = """SELECT uri, value, split_part(uri, '/', 4) AS joined_column,
       split_part(uri, '/', 2) AS "EntityID" FROM"""
STREAMED = f"""
WITH {ATTRIBUTES}
{_LONG} name_attr UNION ALL {_LONG} segment_attr UNION ALL {_LONG} unique_attr"""


def parquet_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends, one with an explicit number of files."""
    path = scratch_path(spark, "parquet")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    finished = F.col("o_orderstatus") == "F"
    write_parquet(orders.where(finished), path, target_files=4)
    write_parquet(orders.where(~finished), path)
    return spark.read.parquet(path)


def csv_files(spark: SparkSession, sf: str) -> DataFrame:
    """Quotes, commas, line breaks, NULL and empty text all survive."""
    path = scratch_path(spark, "csv")
    rows = table(spark, sf, "conversations").select(
        "conv_id", "turn",
        F.when(F.col("turn") == 0, F.lit("")).when(F.col("turn") == 1, None)
        .otherwise(F.concat(F.lit('"a", '), "text")).alias("text"),
    )
    write_csv(rows, path, null_value="\\N")
    reader = spark.read.schema(rows.schema).option("header", True).option("multiLine", True)
    return reader.option("escape", '"').option("nullValue", "\\N").csv(path)


CSV_FILES = """
SELECT conv_id, turn, CASE turn WHEN 0 THEN '' WHEN 1 THEN NULL ELSE '"a", ' || text END AS text
FROM conversations"""

GROUPS = {"place": [CITY, RANK], "land": [COUNTRY], "void": ["attributes.Address.value.County"]}


def group_datasets(spark: SparkSession, sf: str) -> DataFrame:
    """One dataset per attribute group, read back together; the empty group has none."""
    base = scratch_path(spark, "groups")
    tagged = staged(linked_tagged(entity_documents(spark, sf), SINGLE_PATHS, NAMES, GROUPS), "tagged")
    written = write_tagged(groups_wide(tagged, GROUPS), base, list(GROUPS))
    columns = ["UniqueId", "cross_source", "City", "Rank", "Country"]
    parts = [
        spark.read.parquet(f"{base}/attribute_group={g}").select(*columns, F.lit(g).alias("attribute_group"))
        for g, rows in written.items()
        if rows
    ]
    out = empty_frame(spark, [*columns, "attribute_group"])
    for part in parts:
        out = out.unionByName(part)
    return out


GROUP_DATASETS = f"""
WITH {NESTED},
pivoted AS (
  SELECT source AS cross_source, split_part(n.uri, '/', 5) AS instance, cross_value,
         split_part(n.uri, '/', 2) AS entity, label = 'Country' AS land,
         max(value) FILTER (WHERE label = 'City') AS "City",
         max(value) FILTER (WHERE label = 'Rank') AS "Rank",
         max(value) FILTER (WHERE label = 'Country') AS "Country"
  FROM listed JOIN nested_attrs AS n ON listed.uri = n.uri GROUP BY ALL)
SELECT 'U' || entity AS "UniqueId", cross_source, "City", "Rank", "Country",
       CASE WHEN land THEN 'land' ELSE 'place' END AS attribute_group
FROM pivoted"""


def audit_trail(spark: SparkSession, sf: str) -> DataFrame:
    """A run that succeeds and one that fails, as recorded."""
    audit, target = scratch_path(spark, "audit"), scratch_path(spark, "audited")
    orders = table(spark, sf, "orders")
    started = "2024-02-29 12:00:00"
    audited_write(
        orders, lambda df: df.where(F.col("o_orderstatus") == "F"), target, audit,
        "orders", "001", "orders", "finished", started, run_id="first",
    )
    try:
        audited_write(
            orders, lambda df: conform_columns(df, ["o_orderkey"]), target, audit,
            "orders", "002", "orders", "finished", started, run_id="second",
        )
    except ValueError:
        pass
    return spark.read.parquet(audit).select(
        "job_name", "job_id", "job_run_id", "job_start_time", "src_obj_name", "tgt_obj_name", "src_rec_count",
        "tgt_rec_count", "error_type", "flag",
    )


AUDIT_TRAIL = """
SELECT 'orders' AS job_name, '001' AS job_id, 'first' AS job_run_id, '2024-02-29 12:00:00' AS job_start_time,
       'orders' AS src_obj_name, 'finished' AS tgt_obj_name, count(*) AS src_rec_count,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS tgt_rec_count, '' AS error_type,
       'SUCCESS' AS flag FROM orders
UNION ALL SELECT 'orders', '002', 'second', '2024-02-29 12:00:00', '', '', 0, 0, 'ValueError', 'FAIL'"""

CASES = {
    "json_scan": (multiline, _NAMES),
    "json_lines_scan": (lines, _NAMES),
    "json_scan_dropmalformed": (
        without_malformed, f"{_NAMES} WHERE c_custkey // {DOCS_PER_FILE} % 4 <> 1"
    ),
    "json_scan_quarantine": (quarantined, QUARANTINED),
    "stream_intake": (streamed, STREAMED),
    "parquet_roundtrip": (
        parquet_files, "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"
    ),
    "csv_roundtrip": (csv_files, CSV_FILES),
    "group_outputs": (group_datasets, GROUP_DATASETS),
    "run_audit": (audit_trail, AUDIT_TRAIL),
}
