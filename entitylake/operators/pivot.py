"""Long attribute rows to one wide row per key, keeping the largest value per attribute.

``max`` ignores NULL and compares strings by code point.  Each pivot is one aggregation: partial
maxima are formed before its single shuffle, so a group of any size reaches a task as few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.functions.paths import require_unique
from entitylake.functions.uri import instance_id
from entitylake.sources.scratch import staged

CROSSWALK_KEYS = ("crosswalks_value", "entityid", "cross_source")
SINGLE_KEYS = ("cross_source", "cross_value", "sourceid", "EntityID")
NESTED_KEYS = ("cross_source", "cross_uri", "cross_value", "EntityID")


def _named(name: str, match: str, column: Column) -> Column:
    if match == "exact":
        return column == F.lit(name)
    if match == "loose":
        return F.lower(F.trim(column)) == F.lit(name.strip().lower())
    raise ValueError(f"match must be 'exact' or 'loose', not '{match}'")


def pivot_max(
    rows: DataFrame,
    keys: Sequence[str],
    names: Sequence[str],
    match: str = "exact",
    name_column: str = "joined_column",
    value_column: str = "value",
) -> DataFrame:
    """Columns ``keys`` then ``names``.  A key whose rows match no name stays, all NULL."""
    require_unique([*keys, *names], "pivot columns")
    label, value = F.col(name_column), F.col(value_column)
    return rows.groupBy(*[F.col(k).alias(k) for k in keys]).agg(
        *[F.max(F.when(_named(n, match, label), value)).alias(n) for n in names]
    )


def pivot_conditional(
    rows: DataFrame, names: Sequence[str], keys: Sequence[str] = CROSSWALK_KEYS
) -> DataFrame:
    """Names compared without regard to case and surrounding blanks."""
    return pivot_max(rows, keys, names, match="loose")


def pivot_explicit(
    rows: DataFrame, names: Sequence[str], keys: Sequence[str] = CROSSWALK_KEYS
) -> DataFrame:
    """Spark's own pivot over given names; usable on a stream (complete mode)."""
    require_unique([*keys, *names], "pivot columns")
    return rows.groupBy(*keys).pivot("joined_column", list(names)).agg(F.max("value"))


def pivot_discovered(
    rows: DataFrame, keys: Sequence[str] = ("EntityID", "cross_value")
) -> DataFrame:
    """Names found in the data, in sorted order.

    Finding them is a job of its own, so the largest values per key and name are written once and read
    twice rather than computed twice.  Spark refuses more than ``spark.sql.pivotMaxValues`` names.
    """
    largest = rows.groupBy(*keys, "joined_column").agg(F.max("value").alias("value"))
    rows = staged(largest, "pivot")
    return rows.groupBy(*keys).pivot("joined_column").agg(F.max("value"))


def pivot_single(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per crosswalk and entity."""
    return pivot_max(rows, SINGLE_KEYS, names)


def pivot_nested(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per attribute *instance* (fifth part of the URI), crosswalk and entity."""
    return pivot_max(rows.withColumn("cross_uri", instance_id("uri")), NESTED_KEYS, names)
