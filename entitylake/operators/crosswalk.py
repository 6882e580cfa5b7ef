"""Crosswalk tables: which source-system record stands behind an entity or an attribute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from entitylake.functions.paths import find_field, resolve
from entitylake.functions.uri import crosswalk_id, entity_id, source_name
from entitylake.operators.columns import empty_frame


def _exploded(docs: DataFrame, fields: list[str], keep_empty: bool) -> DataFrame | None:
    """One row per crosswalk holding only ``fields``; absent fields are NULL."""
    found = resolve(docs.schema, "crosswalks")
    if found is None:
        return None
    element = found.element
    if not isinstance(element, StructType) or found.depths != (1,):
        raise ValueError("crosswalks must be an array of structs")
    column = F.col(f"`{found.names[0]}`")
    present = {f: find_field(element, f) for f in fields}
    # zipping single fields, rather than exploding whole structs, lets the scan prune the others
    zipped = F.arrays_zip(*[column.getField(f.name).alias(k) for k, f in present.items() if f])
    if not keep_empty:
        docs = docs.where(column.isNotNull())  # reaches the scan, unlike a condition on the zip
    generator = F.explode_outer if keep_empty else F.explode
    rows = docs.select(generator(zipped).alias("c"))
    names = [k for k, f in present.items() if f]
    values: dict[str, Column] = {k: F.col("c").getField(k) for k in names}
    return rows.select(*[values.get(f, F.lit(None).cast("string")).alias(f) for f in fields])


def crosswalk_table(docs: DataFrame, keep_empty: bool = True) -> DataFrame:
    """Distinct ``(crosswalks_value, EntityID, cross_source)``.

    With ``keep_empty`` documents without crosswalks leave one all-NULL row, which links to nothing.
    """
    names = ["crosswalks_value", "EntityID", "cross_source"]
    rows = _exploded(docs, ["value", "uri", "type"], keep_empty)
    if rows is None:
        return empty_frame(docs.sparkSession, names)
    return rows.select(
        F.col("value").cast("string").alias("crosswalks_value"),
        entity_id("uri").alias("EntityID"),
        source_name("type").alias("cross_source"),
    ).distinct()


def crosswalk_uri_table(docs: DataFrame, keep_empty: bool = True) -> DataFrame:
    """``(uri, sourceid, cross_value, cross_source)``: a row per attribute URI a crosswalk lists.

    Columns are taken by name.  With ``keep_empty`` a crosswalk that lists nothing, or a document
    without crosswalks, leaves a row with a NULL ``uri``.
    """
    names = ["uri", "sourceid", "cross_value", "cross_source"]
    rows = _exploded(docs, ["attributes", "value", "uri", "type"], keep_empty)
    if rows is None:
        return empty_frame(docs.sparkSession, names)
    if find_field(resolve(docs.schema, "crosswalks").element, "attributes") is None:
        listed = F.col("attributes")
        if not keep_empty:
            return empty_frame(docs.sparkSession, names)
    else:
        listed = (F.explode_outer if keep_empty else F.explode)(F.col("attributes"))
    return rows.select(
        listed.alias("listed"),
        F.col("value").cast("string").alias("sourceid"),
        crosswalk_id("uri").alias("cross_value"),
        source_name("type").alias("cross_source"),
    ).select(F.col("listed").cast("string").alias("uri"), *names[1:])
