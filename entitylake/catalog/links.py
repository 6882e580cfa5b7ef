"""Queries over crosswalk tables, joins and the two complete jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.catalog.attributes import (
    CITY,
    COUNTRY,
    RANK,
    SINGLE_PATHS,
    ZIP4,
    ZIP5,
)
from entitylake.catalog.facts import ATTRIBUTES, CROSSWALKS, LINKED_ADDRESSES, NESTED, SINGLE
from entitylake.operators.crosswalk import crosswalk_table, crosswalk_uri_table
from entitylake.operators.linkage import (
    largest_value_per_uri,
    nested_entity_join,
    reference_id_join,
    semi_join_uri,
    substring_join,
    uri_join,
)
from entitylake.operators.melt import melt_nested, melt_single, reference_ids
from entitylake.operators.pivot import pivot_discovered, pivot_nested
from entitylake.operators.prose import prose_join
from entitylake.plans.address import address_wide, melt_address_uri
from entitylake.plans.entity import entity_wide, linked_single
from entitylake.samples.documents import (
    address_documents,
    crosswalk_documents,
    entity_documents,
    linked_address_documents,
    table,
)

NAMES = ["Name", "Segment", "UniqueId"]
STAMPS = {"createdDate": "2024-02-29 12:00:00.000", "updatedDate": "2024-02-29 12:00:00.000"}


def records(spark: SparkSession, sf: str) -> DataFrame:
    return crosswalk_table(crosswalk_documents(spark, sf))


RECORDS = f"""
WITH {CROSSWALKS}
SELECT DISTINCT sid AS crosswalks_value, entity AS "EntityID", source AS cross_source FROM records"""


def record_uris(spark: SparkSession, sf: str) -> DataFrame:
    return crosswalk_uri_table(crosswalk_documents(spark, sf))


RECORD_URIS = f"""
WITH {CROSSWALKS}
SELECT uri, sid AS sourceid, cross_value, source AS cross_source FROM listed"""


def linked_attributes(spark: SparkSession, sf: str) -> DataFrame:
    docs = entity_documents(spark, sf)
    return uri_join(crosswalk_uri_table(docs), melt_single(docs, SINGLE_PATHS))


LINKED_ATTRIBUTES = f"""
WITH {ATTRIBUTES}, {CROSSWALKS},
attrs AS (SELECT uri, value FROM name_attr UNION ALL SELECT uri, value FROM segment_attr
          UNION ALL SELECT uri, value FROM unique_attr)
SELECT uri, sid AS sourceid, cross_value, source AS cross_source, value,
       split_part(uri, '/', 4) AS joined_column, split_part(uri, '/', 2) AS "EntityID"
FROM listed JOIN attrs USING (uri)"""


def linked_instances(spark: SparkSession, sf: str) -> DataFrame:
    docs = entity_documents(spark, sf)
    return uri_join(crosswalk_uri_table(docs), melt_nested(docs, [CITY, RANK, COUNTRY]))


LINKED_INSTANCES = f"""
WITH {NESTED}
SELECT uri, sid AS sourceid, cross_value, source AS cross_source, value,
       split_part(uri, '/', 6) AS joined_column, split_part(uri, '/', 2) AS "EntityID"
FROM listed JOIN nested_attrs USING (uri)"""


def listed_attributes(spark: SparkSession, sf: str) -> DataFrame:
    """Attribute rows that some crosswalk lists."""
    docs = entity_documents(spark, sf)
    attributes = melt_nested(docs, [CITY, COUNTRY])
    return semi_join_uri(attributes, crosswalk_uri_table(docs))


LISTED_ATTRIBUTES = f"""
WITH {NESTED}
SELECT uri, value, label AS joined_column, split_part(uri, '/', 2) AS "EntityID"
FROM nested_attrs WHERE label <> 'Rank' AND uri IN (SELECT uri FROM listed)"""


def with_reference_ids(spark: SparkSession, sf: str) -> DataFrame:
    docs = entity_documents(spark, sf)
    single = linked_single(docs, SINGLE_PATHS, NAMES)
    return reference_id_join(single, reference_ids(docs, "attributes.ReferenceId"))


WITH_REFERENCE_IDS = f"""
WITH {SINGLE}
SELECT single.*, r.value AS "ReferenceId"
FROM single JOIN reference_attr AS r ON "EntityID" = CAST(r.c AS VARCHAR) AND r.ov"""


def with_unique_ids(spark: SparkSession, sf: str) -> DataFrame:
    docs = entity_documents(spark, sf)
    attributes = largest_value_per_uri(melt_nested(docs, [CITY, RANK], keep_empty=False))
    crosswalks = crosswalk_uri_table(docs, keep_empty=False)
    nested = pivot_nested(uri_join(crosswalks, attributes), ["City", "Rank"])
    single = linked_single(docs, SINGLE_PATHS, NAMES)
    return nested_entity_join(single, nested, ["City", "Rank"], **STAMPS)


WITH_UNIQUE_IDS = f"""
WITH {NESTED}
SELECT 'U' || split_part(n.uri, '/', 2) AS "UniqueId", cross_source, "City", "Rank",
       '2024-02-29 12:00:00.000' AS "createdDate", '2024-02-29 12:00:00.000' AS "updatedDate"
FROM (SELECT source AS cross_source, split_part(n.uri, '/', 5) AS instance, cross_value,
             'entities/' || split_part(n.uri, '/', 2) AS uri,
             max(value) FILTER (WHERE label = 'City') AS "City",
             max(value) FILTER (WHERE label = 'Rank') AS "Rank"
      FROM listed JOIN nested_attrs AS n ON listed.uri = n.uri
      WHERE label IN ('City', 'Rank') GROUP BY ALL) AS n"""


def _needles(spark: SparkSession, sf: str) -> DataFrame:
    """Order numbers in three formats and lengths."""
    key = F.col("o_orderkey").cast("string")
    number = (
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("PRE/"), F.lpad(key, 10, "0")))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("FIN"), F.lpad(key, 9, "0")))
        .otherwise(F.concat(F.lit("ORD-"), F.lpad(key, 8, "0")))
    )
    return table(spark, sf, "orders").select(number.alias("number"), "o_orderkey")


def _haystacks(spark: SparkSession, sf: str) -> DataFrame:
    """Each line item names its order in one of the three formats."""
    key = F.col("l_orderkey").cast("string")
    text = (
        F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("PRE/"), F.lpad(key, 10, "0")))
        .when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("FIN"), F.lpad(key, 9, "0")))
        .otherwise(F.concat(F.lit("ORD-"), F.lpad(key, 8, "0")))
    )
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("L"), "l_linenumber", F.lit("|"), text, F.lit("|"), "l_returnflag").alias(
            "reference"
        ),
        "l_partkey",
    )


_MATCHES = """
SELECT number, o_orderkey, reference, l_partkey
FROM (SELECT *, CASE o_orderstatus
                WHEN 'P' THEN 'PRE/' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0')
                WHEN 'F' THEN 'FIN' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0')
                ELSE 'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') END AS number
      FROM orders) AS n
JOIN (SELECT *, 'L' || l_linenumber || '|' || CASE l_linenumber % 3
                WHEN 0 THEN 'PRE/' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0')
                WHEN 1 THEN 'FIN' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0')
                ELSE 'ORD-' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') END
                || '|' || l_returnflag AS reference
      FROM lineitem) AS h
ON contains(reference, number)"""
# the key inside the text is a necessary condition: it spares the oracle a nested-loop join
MATCHES = f"{_MATCHES} AND l_orderkey = o_orderkey"


def substring_links(spark: SparkSession, sf: str) -> DataFrame:
    return substring_join(_needles(spark, sf), _haystacks(spark, sf), "number", "reference")


def substring_links_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The strategy for any number of needles."""
    return substring_join(
        _needles(spark, sf), _haystacks(spark, sf), "number", "reference", strategy="shuffle"
    )


def prose_links(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and the benchmark passages they quote; each passage also in a version of its own length."""
    passages = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("passage"))
    cut = F.substring(F.col("passage"), F.lit(4), F.length("passage") - 3 - F.col("item_id") % 40)
    passages = passages.withColumn("part", F.lit("whole")).unionByName(
        passages.select("item_id", cut.cast("string").alias("passage"), F.lit("inner").alias("part"))
    )
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return prose_join(passages, documents, "passage", "text").select("item_id", "part", "doc_id")


PROSE_LINKS = """
SELECT item_id, part, doc_id
FROM (SELECT item_id, 'whole' AS part, text AS passage FROM benchmark
      UNION ALL SELECT item_id, 'inner', substr(text, 4, CAST(length(text) - 3 - item_id % 40 AS BIGINT))
      FROM benchmark) AS p
JOIN documents AS d ON contains(d.text, p.passage)"""


def addresses(spark: SparkSession, sf: str) -> DataFrame:
    """The complete address job."""
    paths = [CITY, RANK, ZIP4, ZIP5, "attributes.Address.value.County"]
    return address_wide(linked_address_documents(spark, sf), paths)


ADDRESSES = f"""
WITH {LINKED_ADDRESSES}
SELECT crosswalks_value, entityid, cross_source, max(value) FILTER (WHERE part = 'City') AS "City",
       max(value) FILTER (WHERE part = 'Rank') AS "Rank",
       max(value) FILTER (WHERE part = 'Zip_Zip4') AS "Zip_Zip4",
       max(value) FILTER (WHERE part = 'Zip_Zip5') AS "Zip_Zip5", CAST(NULL AS VARCHAR) AS "County"
FROM long GROUP BY ALL"""


def own_links(spark: SparkSession, sf: str) -> DataFrame:
    """Order numbers in line items whose supplier belongs to the same tenth as the order's customer."""
    needles = _needles(spark, sf).join(
        table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 10).alias("tenth")), "o_orderkey"
    )
    key = F.col("l_orderkey").cast("string")
    rows = table(spark, sf, "lineitem").select(
        F.concat(F.lit("L"), "l_linenumber", F.lit("|ORD-"), F.lpad(key, 8, "0")).alias("reference"),
        (F.col("l_suppkey") % 10).alias("owner"), "l_partkey",
    )
    found = substring_join(needles, rows, "number", "reference", same=("tenth", "owner"))
    return found.select("number", "o_orderkey", "reference", "owner", "l_partkey")


OWN_LINKS = """
SELECT 'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS number, o_orderkey,
       'L' || l_linenumber || '|ORD-' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS reference,
       l_suppkey % 10 AS owner, l_partkey
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE o_orderstatus NOT IN ('P', 'F') AND l_suppkey % 10 = o_custkey % 10"""


def own_addresses(spark: SparkSession, sf: str) -> DataFrame:
    """The address job where customers are suppliers of the same number, each with its own records only."""
    suppliers = address_documents(spark, sf)
    suppliers = suppliers.withColumn("uri", F.replace("uri", F.lit("entities/S"), F.lit("entities/")))
    docs = suppliers.unionByName(crosswalk_documents(spark, sf))
    return address_wide(docs, [CITY, RANK, ZIP5], same_entity=True)


OWN_ADDRESSES = f"""
WITH {LINKED_ADDRESSES}, own AS (
  SELECT linked.* FROM linked WHERE entityid = CAST(l_suppkey AS VARCHAR))
SELECT crosswalks_value, entityid, cross_source,
       greatest(max(CASE WHEN l_quantity >= 10 THEN 'C' || l_returnflag END),
                max(CASE WHEN l_tax < 0.04 THEN 'B' || l_linestatus END)) AS "City",
       max(CAST(l_linenumber AS VARCHAR)) AS "Rank",
       max(lpad(CAST(l_partkey AS VARCHAR), 5, '0')) AS "Zip_Zip5"
FROM own GROUP BY ALL"""


def addresses_by_uri(spark: SparkSession, sf: str) -> DataFrame:
    """Address values by listed attribute URI, pivoted per entity of the URI and crosswalk value."""
    rows = melt_address_uri(linked_address_documents(spark, sf), [CITY, ZIP5])
    return pivot_discovered(rows)


ADDRESSES_BY_URI = f"""
WITH {LINKED_ADDRESSES}
SELECT entityid AS "EntityID", crosswalks_value AS cross_value,
       max(value) FILTER (WHERE leaf = 'City') AS "CityValue",
       max(value) FILTER (WHERE leaf = 'Zip5') AS "Zip5Value"
FROM long WHERE part IN ('City', 'Zip_Zip5') GROUP BY ALL"""


def addresses_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The address job for any number of crosswalks; only flagged attributes decide on presence."""
    return address_wide(linked_address_documents(spark, sf), [CITY, ZIP4], strategy="shuffle")


ADDRESSES_SHUFFLED = f"""
WITH {LINKED_ADDRESSES}
SELECT crosswalks_value, entityid, cross_source, max(value) FILTER (WHERE part = 'City') AS "City",
       max(value) FILTER (WHERE part = 'Zip_Zip4') AS "Zip_Zip4"
FROM long WHERE part IN ('City', 'Zip_Zip4') GROUP BY ALL"""


def entities(spark: SparkSession, sf: str) -> DataFrame:
    """The complete entity dataset."""
    docs = entity_documents(spark, sf)
    return entity_wide(docs, SINGLE_PATHS, NAMES, "attributes.ReferenceId", **STAMPS)


ENTITIES = f"""
WITH {SINGLE}
SELECT single.*, r.value AS "ReferenceId", '2024-02-29 12:00:00.000' AS "createdDate",
       '2024-02-29 12:00:00.000' AS "updatedDate"
FROM single JOIN reference_attr AS r ON "EntityID" = CAST(r.c AS VARCHAR) AND r.ov"""

CASES = {
    "crosswalk_table": (records, RECORDS),
    "crosswalk_uri_table": (record_uris, RECORD_URIS),
    "uri_join_single": (linked_attributes, LINKED_ATTRIBUTES),
    "uri_join_nested": (linked_instances, LINKED_INSTANCES),
    "semi_join_uri": (listed_attributes, LISTED_ATTRIBUTES),
    "reference_id_join": (with_reference_ids, WITH_REFERENCE_IDS),
    "nested_entity_join": (with_unique_ids, WITH_UNIQUE_IDS),
    "substring_join": (substring_links, MATCHES),
    "substring_join_exact_length": (substring_links_shuffled, MATCHES),
    "substring_join_prose": (prose_links, PROSE_LINKS),
    "address_wide": (addresses, ADDRESSES),
    "address_wide_shuffled": (addresses_shuffled, ADDRESSES_SHUFFLED),
    "substring_join_same_entity": (own_links, OWN_LINKS),
    "address_wide_same_entity": (own_addresses, OWN_ADDRESSES),
    "melt_address_uri": (addresses_by_uri, ADDRESSES_BY_URI),
    "entity_wide": (entities, ENTITIES),
}
