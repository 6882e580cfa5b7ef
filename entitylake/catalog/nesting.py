"""Queries over nested-to-flat operators and document scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.catalog.facts import ATTRIBUTES
from entitylake.operators.nested import (
    explode_array,
    explode_map,
    flatten_normalized,
    flatten_path,
    flatten_wide,
)
from entitylake.samples.documents import (
    crosswalk_documents,
    customer_documents,
    order_documents,
    table,
)


def wide(spark: SparkSession, sf: str) -> DataFrame:
    """Struct and array: an order document gives one row per item, or one without items."""
    flat = flatten_wide(order_documents(spark, sf))
    return flat.select(
        "o_orderkey", "o_custkey", "head_status", "head_prio",
        "items_l_linenumber", "items_l_partkey", "items_l_quantity",
    )


WIDE = """
SELECT o_orderkey, o_custkey, o_orderstatus AS head_status, o_orderpriority AS head_prio,
       l_linenumber AS items_l_linenumber, l_partkey AS items_l_partkey,
       l_quantity AS items_l_quantity
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey"""


def wide_siblings(spark: SparkSession, sf: str) -> DataFrame:
    """Sibling arrays multiply; an empty one keeps its row with NULL."""
    items = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.filter(F.array("l_quantity", "l_extendedprice"), lambda v: v >= 20).alias("amounts"),
        F.struct(F.array("l_partkey", "l_suppkey").alias("keys")).alias("ref"),
    )
    return flatten_wide(items)


WIDE_SIBLINGS = """
SELECT l_orderkey, a.amount AS amounts, k.ref_key AS ref_keys
FROM (SELECT *, row_number() OVER () AS rid FROM lineitem) AS l
LEFT JOIN (SELECT rid, l_quantity AS amount
             FROM (SELECT *, row_number() OVER () AS rid FROM lineitem) WHERE l_quantity >= 20
           UNION ALL
           SELECT rid, l_extendedprice
             FROM (SELECT *, row_number() OVER () AS rid FROM lineitem) WHERE l_extendedprice >= 20
          ) AS a ON a.rid = l.rid
JOIN (SELECT rid, unnest([l_partkey, l_suppkey]) AS ref_key
        FROM (SELECT *, row_number() OVER () AS rid FROM lineitem)) AS k ON k.rid = l.rid"""


def wide_drop(spark: SparkSession, sf: str) -> DataFrame:
    """A dropped array multiplies nothing, a dropped struct adds no columns."""
    docs = crosswalk_documents(spark, sf).select("uri", "crosswalks")
    flat = flatten_wide(
        docs, ["crosswalks_singleAttributeUpdateDates", "crosswalks_attributes"]
    )
    return flat.select(
        "uri", "crosswalks_sourceTable", "crosswalks_type", "crosswalks_uri", "crosswalks_value"
    )


WIDE_DROP = """
SELECT 'entities/' || o_custkey AS uri, o_orderpriority AS "crosswalks_sourceTable",
       'configuration/sources/' || o_orderstatus AS crosswalks_type,
       'entities/' || o_custkey || '/crosswalks/' || o_orderkey AS crosswalks_uri,
       'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS crosswalks_value
FROM orders"""


def _normalized(spark: SparkSession, sf: str, **options: bool) -> dict[str, DataFrame]:
    return flatten_normalized(customer_documents(spark, sf).select("uri", "attributes"), **options)


def normalized_root(spark: SparkSession, sf: str) -> DataFrame:
    """Scalars and struct leaves only: no array is exploded."""
    order = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("prio"))
    docs = table(spark, sf, "orders").select(
        "o_orderkey", order.alias("head"), F.array("o_custkey", "o_orderkey").alias("refs")
    )
    return flatten_normalized(docs)["root"]


NORMALIZED_ROOT = """
SELECT o_orderkey, o_orderstatus AS head_status, o_orderpriority AS head_prio FROM orders"""


def normalized_child(spark: SparkSession, sf: str) -> DataFrame:
    """An array's own frame: the scalars above it, its position and its elements' fields."""
    return _normalized(spark, sf)["root_attributes_Segment"]


NORMALIZED_CHILD = f"""
WITH {ATTRIBUTES}
SELECT 'entities/' || c AS uri, CAST(right(uri, 1) AS INTEGER) - 1 AS "attributes_Segment_pos",
       code AS "attributes_Segment_lookupCode", ov AS "attributes_Segment_ov",
       uri AS "attributes_Segment_uri", value AS "attributes_Segment_value"
FROM segment_attr"""


def normalized_grandchild(spark: SparkSession, sf: str) -> DataFrame:
    """An array inside an array element, without the outer position."""
    frames = _normalized(spark, sf)
    frame = frames["root_attributes_Address_attributes_Address_value_City"]
    return frame.select(
        "uri", "attributes_Address_uri", "attributes_Address_value_City_pos",
        "attributes_Address_value_City_uri", "attributes_Address_value_City_value",
    )


NORMALIZED_GRANDCHILD = """
SELECT 'entities/' || c_custkey AS uri, a AS "attributes_Address_uri",
       CAST(p AS INTEGER) AS "attributes_Address_value_City_pos",
       a || '/City/c' || (p + 1) AS "attributes_Address_value_City_uri",
       CASE p WHEN 0 THEN 'CITY' || c_nationkey ELSE 'TOWN' || (c_custkey % 97) END || 'a' || n
         AS "attributes_Address_value_City_value"
FROM (SELECT *, 'entities/' || c_custkey || '/attributes/Address/a' || n AS a
      FROM customer, (VALUES (1), (2)) AS v(n)
      WHERE n = 1 OR c_nationkey % 2 = 0), (VALUES (0), (1)) AS q(p)"""


def map_entries(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    docs = events.select("event_id", F.create_map("event_type", "value").alias("m"))
    return explode_map(docs, "m")


MAP_ENTRIES = """
SELECT event_id, 0 AS m_pos, event_type AS m_key, value AS m_value FROM events"""


def inner_elements(spark: SparkSession, sf: str) -> DataFrame:
    """The inner form leaves out rows without elements."""
    docs = order_documents(spark, sf).select("o_orderkey", "items")
    rows = explode_array(docs, "items", outer=False, pos=False)
    return rows.select("o_orderkey", F.col("items.l_partkey").alias("l_partkey"))


INNER_ELEMENTS = """
SELECT o_orderkey, l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey"""


def element_positions(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "lineitem").select(
        "l_orderkey", F.array("l_partkey", "l_suppkey").alias("keys")
    )
    return explode_array(docs, "keys", outer=True, pos=True)


ELEMENT_POSITIONS = """
SELECT l_orderkey, 0 AS keys_pos, l_partkey AS keys FROM lineitem
UNION ALL SELECT l_orderkey, 1, l_suppkey FROM lineitem"""


def path_through_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """An array inside an array inside a struct, selected by path and flattened."""
    docs = customer_documents(spark, sf)
    return flatten_path(docs, "attributes.Address.refRelation.crosswalks")


PATH_THROUGH_ARRAYS = """
SELECT a || '/' || tail AS "crosswalks_attributeURIs", CAST(NULL AS VARCHAR) AS crosswalks_value
FROM (SELECT 'entities/' || c_custkey || '/attributes/Address/a' || n AS a,
             unnest(['City/c1', 'Rank/r1']) AS tail
      FROM customer, (VALUES (1), (2)) AS v(n) WHERE n = 1 OR c_nationkey % 2 = 0)"""

CASES = {
    "flatten_wide": (wide, WIDE),
    "flatten_wide_siblings": (wide_siblings, WIDE_SIBLINGS),
    "flatten_wide_drop": (wide_drop, WIDE_DROP),
    "flatten_normalized_root": (normalized_root, NORMALIZED_ROOT),
    "flatten_normalized_child": (normalized_child, NORMALIZED_CHILD),
    "flatten_normalized_grandchild": (normalized_grandchild, NORMALIZED_GRANDCHILD),
    "explode_map": (map_entries, MAP_ENTRIES),
    "explode_inner": (inner_elements, INNER_ELEMENTS),
    "explode_pos": (element_positions, ELEMENT_POSITIONS),
    "flatten_path": (path_through_arrays, PATH_THROUGH_ARRAYS),
}
