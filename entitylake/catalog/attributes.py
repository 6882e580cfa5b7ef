"""Queries over melts and pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.catalog.facts import (
    ADDRESSES,
    ATTRIBUTES,
    LINKED_ADDRESSES,
    NESTED,
    SINGLE,
)
from entitylake.operators.crosswalk import crosswalk_table, crosswalk_uri_table
from entitylake.operators.linkage import largest_value_per_uri, uri_join
from entitylake.operators.melt import melt_grouped, melt_nested, melt_single, reference_ids
from entitylake.operators.pivot import (
    pivot_conditional,
    pivot_discovered,
    pivot_explicit,
    pivot_nested,
    pivot_single,
)
from entitylake.plans.address import melt_address
from entitylake.samples.documents import (
    customer_documents,
    entity_documents,
    linked_address_documents,
)
from entitylake.sources.scratch import staged

SINGLE_PATHS = ["attributes.Name", "attributes.segment", "attributes.UniqueId", "attributes.Fax"]
CITY, RANK = "attributes.Address.value.City", "attributes.address.value.Rank"
COUNTRY = "attributes.Address.value.Country"
ZIP4, ZIP5 = (f"attributes.Address.value.Zip.value.Zip{n}" for n in (4, 5))
OLD_ZIP5 = "attributes.Address.value.OriginalZip.value.Zip5"

_LONG = """SELECT uri, {value} AS value, split_part(uri, '/', {part}) AS joined_column,
       split_part(uri, '/', 2) AS "EntityID" FROM {table}"""
_NO_ROW = """SELECT NULL, NULL, NULL, NULL FROM customer WHERE c_acctbal < 0"""


def _long(table: str, value: str = "value", part: int = 4) -> str:
    return _LONG.format(table=table, value=value, part=part)


def single(spark: SparkSession, sf: str) -> DataFrame:
    """A customer without a name leaves one row of NULLs; an attribute nobody has leaves none."""
    return melt_single(customer_documents(spark, sf), SINGLE_PATHS)


SINGLE_ROWS = f"""
WITH {ATTRIBUTES}
{_long('name_attr')} UNION ALL {_NO_ROW} UNION ALL {_long('segment_attr')}
UNION ALL {_long('unique_attr')}"""


def single_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The lookup code, where it is an attribute's first field, stands in for the value."""
    return melt_single(
        customer_documents(spark, sf), SINGLE_PATHS, prefer="first_field", keep_empty=False
    )


SINGLE_LOOKUP = f"""
WITH {ATTRIBUTES}
{_long('name_attr')} UNION ALL {_long('segment_attr', 'code')} UNION ALL {_long('unique_attr')}"""


def references(spark: SparkSession, sf: str) -> DataFrame:
    return reference_ids(customer_documents(spark, sf), "attributes.ReferenceId")


REFERENCES = f"WITH {ATTRIBUTES} {_long('reference_attr')} WHERE ov"


def nested(spark: SparkSession, sf: str) -> DataFrame:
    return melt_nested(customer_documents(spark, sf), [CITY, RANK, COUNTRY], prefer="lookup_code")


NESTED_ROWS = f"""
WITH {ADDRESSES}
{_long('city_attr', part=6)} UNION ALL {_long('rank_attr', part=6)}
UNION ALL {_long('country_attr', 'code', 6)}"""


def nested_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """The value field is configured per attribute and becomes part of the label."""
    paths = [{CITY: "value"}, {COUNTRY: "lookupCode"}]
    return melt_nested(customer_documents(spark, sf), paths, suffix=True)


NESTED_LABELLED = f"""
WITH {ADDRESSES}
SELECT uri, value, split_part(uri, '/', 6) || 'value' AS joined_column,
       split_part(uri, '/', 2) AS "EntityID" FROM city_attr
UNION ALL SELECT uri, code, split_part(uri, '/', 6) || 'lookupCode', split_part(uri, '/', 2)
FROM country_attr"""


def _records(docs: DataFrame) -> DataFrame:
    return staged(crosswalk_table(docs, keep_empty=False), "crosswalks")


def address(spark: SparkSession, sf: str) -> DataFrame:
    docs = linked_address_documents(spark, sf)
    return melt_address(_records(docs), docs, [CITY, RANK, ZIP4, ZIP5]).withColumnRenamed(
        "EntityID", "entityid"
    )


ADDRESS = f"""
WITH {LINKED_ADDRESSES}
SELECT DISTINCT crosswalks_value, entityid, cross_source, value, part AS joined_column
FROM long WHERE part IN ('City', 'Rank', 'Zip_Zip4', 'Zip_Zip5')"""


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    docs = linked_address_documents(spark, sf)
    return melt_address(_records(docs), docs, [CITY, ZIP5, OLD_ZIP5], label="labelled")


def address_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Both containers' Zip5 share one label."""
    return _labelled(spark, sf).withColumnRenamed("EntityID", "entityid")


ADDRESS_LABELLED = f"""
WITH {LINKED_ADDRESSES}
SELECT DISTINCT crosswalks_value, entityid, cross_source, value, leaf || 'Value' AS joined_column
FROM long WHERE part IN ('City', 'Zip_Zip5', 'OriginalZip_Zip5')"""

GROUPS = {
    "BRICK": ("BRICK", ["ID", "Type"]),
    "OriginalZip": ("OriginalZip", ["Zip5", "Zip4"]),
    "Zip": ("Zip", ["PostalCode", "Zip5", "Zip4"]),
    "single": (None, ["City", "Rank", "Country", "County"]),
}


def grouped(spark: SparkSession, sf: str) -> DataFrame:
    return melt_grouped(customer_documents(spark, sf), "attributes.Address", GROUPS)


GROUPED = f"""
WITH {ADDRESSES}
SELECT 'single' AS "group", 'City' AS attribute, uri, value FROM city_attr
UNION ALL SELECT 'single', 'Rank', uri, value FROM rank_attr
UNION ALL SELECT 'single', 'Country', uri, value FROM country_attr
UNION ALL SELECT 'BRICK', 'ID', uri || '/BRICK/b1/ID/i1', 'B' || (c % 11) FROM address_base
UNION ALL SELECT 'BRICK', 'Type', uri || '/BRICK/b1/Type/t1', 'sales' FROM address_base
UNION ALL SELECT 'OriginalZip', 'Zip5', uri || '/OriginalZip/o1/Zip5/f1',
                 lpad(CAST(c * 41 % 100000 AS VARCHAR), 5, '0') FROM address_base
UNION ALL SELECT 'Zip', 'Zip5', uri || '/Zip/z1/Zip5/f1',
                 lpad(CAST(c * 37 % 100000 AS VARCHAR), 5, '0') FROM address_base
UNION ALL SELECT 'Zip', 'Zip4', uri || '/Zip/z1/Zip4/f1',
                 lpad(CAST(c % 10000 AS VARCHAR), 4, '0') FROM address_base"""


def conditional(spark: SparkSession, sf: str) -> DataFrame:
    """Names with other case and blanks still match; a record with no surviving value is absent."""
    docs = linked_address_documents(spark, sf)
    rows = melt_address(_records(docs), docs, [CITY, ZIP4])
    blurred = rows.withColumn("joined_column", F.concat(F.lit(" "), F.upper("joined_column")))
    wide = pivot_conditional(blurred, ["City", "Zip_Zip4", "County"])
    return wide


CONDITIONAL = f"""
WITH {LINKED_ADDRESSES}
SELECT crosswalks_value, entityid, cross_source, max(value) FILTER (WHERE part = 'City') AS "City",
       max(value) FILTER (WHERE part = 'Zip_Zip4') AS "Zip_Zip4", CAST(NULL AS VARCHAR) AS "County"
FROM long WHERE part IN ('City', 'Zip_Zip4') GROUP BY ALL"""


def explicit(spark: SparkSession, sf: str) -> DataFrame:
    rows = _labelled(spark, sf).withColumnRenamed("EntityID", "entityid")
    return pivot_explicit(rows, ["CityValue", "Zip5Value", "RankValue"])


EXPLICIT = f"""
WITH {LINKED_ADDRESSES}
SELECT crosswalks_value, entityid, cross_source,
       max(value) FILTER (WHERE leaf = 'City') AS "CityValue",
       max(value) FILTER (WHERE leaf = 'Zip5') AS "Zip5Value", CAST(NULL AS VARCHAR) AS "RankValue"
FROM long WHERE part IN ('City', 'Zip_Zip5', 'OriginalZip_Zip5') GROUP BY ALL"""


def discovered(spark: SparkSession, sf: str) -> DataFrame:
    rows = _labelled(spark, sf).withColumnRenamed("crosswalks_value", "cross_value")
    return pivot_discovered(rows)


DISCOVERED = f"""
WITH {LINKED_ADDRESSES}
SELECT entityid AS "EntityID", crosswalks_value AS cross_value,
       max(value) FILTER (WHERE leaf = 'City') AS "CityValue",
       max(value) FILTER (WHERE leaf = 'Zip5') AS "Zip5Value"
FROM long WHERE part IN ('City', 'Zip_Zip5', 'OriginalZip_Zip5') GROUP BY ALL"""


def wide_single(spark: SparkSession, sf: str) -> DataFrame:
    docs = entity_documents(spark, sf)
    attributes = largest_value_per_uri(melt_single(docs, SINGLE_PATHS, keep_empty=False))
    linked = uri_join(crosswalk_uri_table(docs, keep_empty=False), attributes)
    return pivot_single(linked, ["Name", "Segment", "UniqueId"])


WIDE_SINGLE = f"WITH {SINGLE} SELECT * FROM single"


def wide_nested(spark: SparkSession, sf: str) -> DataFrame:
    docs = entity_documents(spark, sf)
    attributes = largest_value_per_uri(melt_nested(docs, [CITY, RANK, COUNTRY], keep_empty=False))
    linked = uri_join(crosswalk_uri_table(docs, keep_empty=False), attributes)
    return pivot_nested(linked, ["City", "Rank", "Country"])


WIDE_NESTED = f"""
WITH {NESTED}
SELECT source AS cross_source, split_part(n.uri, '/', 5) AS cross_uri, cross_value,
       split_part(n.uri, '/', 2) AS "EntityID",
       max(value) FILTER (WHERE label = 'City') AS "City",
       max(value) FILTER (WHERE label = 'Rank') AS "Rank",
       max(value) FILTER (WHERE label = 'Country') AS "Country"
FROM listed JOIN nested_attrs AS n ON listed.uri = n.uri GROUP BY ALL"""

CASES = {
    "melt_single": (single, SINGLE_ROWS),
    "melt_single_lookup": (single_lookup, SINGLE_LOOKUP),
    "reference_ids": (references, REFERENCES),
    "melt_nested": (nested, NESTED_ROWS),
    "melt_nested_labelled": (nested_labelled, NESTED_LABELLED),
    "melt_address": (address, ADDRESS),
    "melt_address_labelled": (address_labelled, ADDRESS_LABELLED),
    "melt_grouped": (grouped, GROUPED),
    "pivot_conditional": (conditional, CONDITIONAL),
    "pivot_explicit": (explicit, EXPLICIT),
    "pivot_discovered": (discovered, DISCOVERED),
    "pivot_single": (wide_single, WIDE_SINGLE),
    "pivot_nested": (wide_nested, WIDE_NESTED),
}
