"""Queries over column, key and text operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.functions.deid import deidentify
from entitylake.functions.text import rsplit_limit, split_limit
from entitylake.functions.uri import (
    attribute_name,
    entity_id,
    instance_id,
    source_name,
    sub_attribute_name,
)
from entitylake.operators.columns import (
    conform_columns,
    dedup_rows,
    distinct_values,
    drop_columns,
    drop_null_rows,
    empty_frame,
    ensure_columns,
    fill_nulls,
    filter_survivor,
    rename_strip_tokens,
    row_count,
    stamp_columns,
    union_all,
    union_by_name,
)
from entitylake.operators.nested import flatten_path
from entitylake.samples.documents import crosswalk_documents, customer_documents, table


def ensured(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ["c_custkey", "C_NAME", "fax", "phone"]
    return ensure_columns(table(spark, sf, "customer"), wanted).select(
        "c_custkey", "c_name", "fax", "phone"
    )


ENSURED = """
SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS fax, CAST(NULL AS VARCHAR) AS phone
FROM customer"""


def conformed(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_name")
    return conform_columns(rows, ["S_Name", "s_suppkey", "s_nationkey", "s_fax"], allow_missing=True)


CONFORMED = """
SELECT s_name AS "S_Name", CAST(s_suppkey AS VARCHAR) AS s_suppkey,
       CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(NULL AS VARCHAR) AS s_fax FROM supplier"""


def started_empty(spark: SparkSession, sf: str) -> DataFrame:
    """An empty all-string frame that table rows are then united with by name."""
    names = ["c_name", "c_mktsegment", "c_custkey"]
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return union_by_name(empty_frame(spark, names), conform_columns(rows, names))


STARTED_EMPTY = """
SELECT c_name, c_mktsegment, CAST(c_custkey AS VARCHAR) AS c_custkey FROM customer"""


def dropped(spark: SparkSession, sf: str) -> DataFrame:
    return drop_columns(table(spark, sf, "part"), ["p_type", "p_size", "p_retailprice", "nowhere"])


DROPPED = "SELECT p_partkey, p_name, p_brand FROM part"


def renamed(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Identifiers_value_id_tkn"),
        F.col("c_name").alias("attributes_Name_value"),
        F.col("c_mktsegment").alias("Addresses_ProgramCampaign_Segment"),
    )
    return rename_strip_tokens(rows)


RENAMED = 'SELECT c_custkey AS id, c_name AS "Name", c_mktsegment AS "Segment" FROM customer'


def survivors(spark: SparkSession, sf: str) -> DataFrame:
    """Survivor flags kept as text, among them text that is no boolean."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", "false").when(F.col("l_returnflag") == "A", "true")
        .otherwise("x").alias("ov"),
    )
    return filter_survivor(rows)


SURVIVORS = """
SELECT l_orderkey, l_linenumber, 'true' AS ov FROM lineitem WHERE l_returnflag = 'A'"""


def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")).alias("k"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("p"),
    )


_GAPS = """
(SELECT CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END AS k,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS p FROM orders) AS gaps"""


def without_all_null(spark: SparkSession, sf: str) -> DataFrame:
    return drop_null_rows(_gaps(spark, sf), "all")


def without_any_null(spark: SparkSession, sf: str) -> DataFrame:
    return drop_null_rows(_gaps(spark, sf), "any")


def filled(spark: SparkSession, sf: str) -> DataFrame:
    return fill_nulls(_gaps(spark, sf), {"k": 0, "p": 0})


def stamped(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "nation").select("n_nationkey", "n_name")
    stamp = "2024-02-29 12:00:00.000"
    return stamp_columns(rows, createdDate=stamp, updatedDate=stamp, source="nation")


STAMPED = """
SELECT n_nationkey, n_name, '2024-02-29 12:00:00.000' AS "createdDate",
       '2024-02-29 12:00:00.000' AS "updatedDate", 'nation' AS source FROM nation"""


def uri_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys out of nested attribute URIs; a URI that is too short gives NULL."""
    cities = flatten_path(customer_documents(spark, sf), "attributes.Address.value.City")
    return cities.select(
        F.col("City_uri").alias("uri"),
        entity_id("City_uri").alias("entity"),
        attribute_name("City_uri").alias("attribute"),
        instance_id("City_uri").alias("instance"),
        sub_attribute_name("City_uri").alias("sub_attribute"),
        source_name(F.lit("configuration/sources")).alias("too_short"),
    )


URI_KEYS = """
SELECT 'entities/' || c_custkey || '/attributes/Address/a' || n || '/City/c' || p AS uri,
       CAST(c_custkey AS VARCHAR) AS entity, 'Address' AS attribute, 'a' || n AS instance,
       'City' AS sub_attribute, CAST(NULL AS VARCHAR) AS too_short
FROM customer, (VALUES (1), (2)) AS v(n), (VALUES (1), (2)) AS q(p)
WHERE n = 1 OR c_nationkey % 2 = 0"""


def stacked(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of different types under one another, by position."""
    return union_all(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), "c_name"),
        table(spark, sf, "part").select("p_brand", "p_name"),
        table(spark, sf, "customer").select("c_mktsegment", "c_nationkey"),
    )


STACKED = """
SELECT CAST(c_custkey AS VARCHAR) AS key, c_name FROM customer
UNION ALL SELECT p_brand, p_name FROM part
UNION ALL SELECT c_mktsegment, CAST(c_nationkey AS VARCHAR) FROM customer"""


def stacked_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return union_by_name(
        table(spark, sf, "customer").select(
            F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")
        ),
        table(spark, sf, "supplier").select(
            F.col("s_nationkey").alias("NATION"), F.col("s_name").alias("Name")
        ),
    )


STACKED_BY_NAME = """
SELECT c_name AS name, c_nationkey AS nation FROM customer
UNION ALL SELECT s_name, s_nationkey FROM supplier"""


def counted(spark: SparkSession, sf: str) -> DataFrame:
    crosswalks = flatten_path(crosswalk_documents(spark, sf), "crosswalks.uri")
    return row_count(crosswalks, "n")


def distinct_labels(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_values(table(spark, sf, "part"), "p_brand")


def deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_rows(table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linenumber"))


AS_OF = dt.date(2024, 2, 29)
RESTRICTED = ("036", "059", "102", "203", "556", "692", "821", "823", "878", "879", "884", "893")


def _persons(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a made-up date of birth and postal code, some of them missing."""
    key = F.col("c_custkey")
    birth = F.date_add(F.lit(dt.date(1950, 1, 1)), (key * 37 % 20000).cast("int"))
    code = F.lpad((key * 7919 % 100000).cast("string"), 5, "0")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.when(key % 50 != 0, birth).alias("dob"),
        F.when(key % 70 != 0, code).alias("zip"),
    )


_PERSONS = """
(SELECT c_custkey,
        CASE WHEN c_custkey % 50 <> 0
             THEN DATE '1950-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER) END AS dob,
        CASE WHEN c_custkey % 70 <> 0
             THEN lpad(CAST(c_custkey * 7919 % 100000 AS VARCHAR), 5, '0') END AS zip
 FROM customer) AS persons"""


def ages(spark: SparkSession, sf: str) -> DataFrame:
    return deidentify(_persons(spark, sf), birth_columns=["dob"], as_of=AS_OF).select(
        "c_custkey", "Age"
    )


def birth_years(spark: SparkSession, sf: str) -> DataFrame:
    rows = deidentify(_persons(spark, sf), birth_columns=["dob"], as_of=AS_OF)
    return rows.select("c_custkey", F.col("YearOfBirth").cast("bigint").alias("YearOfBirth"))


def zip_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    rows = deidentify(_persons(spark, sf), zip_columns=["zip"], restricted=RESTRICTED)
    return rows.select("c_custkey", "zip", "ZipCode")


def _split(spark: SparkSession, sf: str, split) -> DataFrame:
    pages = table(spark, sf, "pages")
    url = F.col("url")
    shown = {
        "every": split(url, "/"), "at_most_two": split(url, "/", 2), "dots": split(url, ".", 1)
    }
    return pages.select("page_id", *[F.array_join(v, "<>").alias(n) for n, v in shown.items()])


def split_left(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf, split_limit)


SPLIT_LEFT = r"""
SELECT page_id, replace(url, '/', '<>') AS every,
       regexp_replace(regexp_replace(url, '/', '<>'), '/', '<>') AS at_most_two,
       regexp_replace(url, '\.', '<>') AS dots
FROM pages"""


def split_right(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf, rsplit_limit)


SPLIT_RIGHT = r"""
SELECT page_id, replace(url, '/', '<>') AS every,
       reverse(regexp_replace(regexp_replace(reverse(url), '/', '><'), '/', '><')) AS at_most_two,
       reverse(regexp_replace(reverse(url), '\.', '><')) AS dots
FROM pages"""

CASES = {
    "ensure_columns": (ensured, ENSURED),
    "conform_columns": (conformed, CONFORMED),
    "empty_frame": (started_empty, STARTED_EMPTY),
    "drop_columns": (dropped, DROPPED),
    "rename_strip_tokens": (renamed, RENAMED),
    "filter_survivor": (survivors, SURVIVORS),
    "drop_null_rows_all": (
        without_all_null, f"SELECT * FROM {_GAPS} WHERE k IS NOT NULL OR p IS NOT NULL"
    ),
    "drop_null_rows_any": (
        without_any_null, f"SELECT * FROM {_GAPS} WHERE k IS NOT NULL AND p IS NOT NULL"
    ),
    "fill_nulls": (filled, f"SELECT coalesce(k, 0) AS k, coalesce(p, '0') AS p FROM {_GAPS}"),
    "stamp_columns": (stamped, STAMPED),
    "uri_parts": (uri_keys, URI_KEYS),
    "union_all": (stacked, STACKED),
    "union_by_name": (stacked_by_name, STACKED_BY_NAME),
    "row_count": (counted, "SELECT count(*) AS n FROM orders"),
    "distinct_values": (distinct_labels, "SELECT DISTINCT p_brand FROM part"),
    "dedup_rows": (
        deduplicated, "SELECT DISTINCT l_suppkey, l_returnflag, l_linenumber FROM lineitem"
    ),
    "deid_age": (
        ages,
        "SELECT c_custkey, CAST(floor(date_diff('day', dob, DATE '2024-02-29') / 365) AS BIGINT)"
        f' AS "Age" FROM {_PERSONS}',
    ),
    "deid_birth_year": (
        birth_years,
        f'SELECT c_custkey, CAST(year(dob) AS BIGINT) AS "YearOfBirth" FROM {_PERSONS}',
    ),
    "deid_zip3": (
        zip_prefixes,
        "SELECT c_custkey, zip, CASE WHEN substr(zip, 1, 3) IN "
        f"{RESTRICTED} THEN '000' ELSE substr(zip, 1, 3) END AS \"ZipCode\" FROM {_PERSONS}",
    ),
    "split_limit": (split_left, SPLIT_LEFT),
    "rsplit_limit": (split_right, SPLIT_RIGHT),
}
