"""Whole-frame column operators: one ``select`` each, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from entitylake.functions.paths import find_field, require_unique, resolve, truthy

# Substrings removed from column names, in this order.
NAME_TOKENS = ("_tkn", "attributes", "Addresses", "value", "Identifiers", "ProgramCampaign", "_")


def string_schema(names: Iterable[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in require_unique(names, "columns")])


def empty_frame(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """No rows, the given columns, all of them strings."""
    return spark.createDataFrame([], string_schema(names))


def ensure_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add a NULL string column for each name ``df`` lacks; a nested path is lifted to the top."""
    added: list[Column] = []
    for name in require_unique(names, "columns"):
        if find_field(df.schema, name):
            continue
        known = resolve(df.schema, name) is not None
        added.append((F.col(name) if known else F.lit(None).cast("string")).alias(name))
    return df.select("*", *added) if added else df


def conform_columns(
    df: DataFrame, target: Sequence[str], allow_missing: bool = False
) -> DataFrame:
    """Exactly the target columns, in their order, as strings.

    The two sets of names must agree (case aside); with ``allow_missing`` absent ones become NULL.
    """
    require_unique(target, "target columns")
    wanted = {t.lower() for t in target}
    surplus = [c for c in df.columns if c.lower() not in wanted]
    missing = [t for t in target if find_field(df.schema, t) is None]
    if surplus or (missing and not allow_missing):
        raise ValueError(f"columns do not conform: missing {missing}, unexpected {surplus}")
    return df.select(
        *[
            (F.lit(None) if t in missing else F.col(f"`{find_field(df.schema, t).name}`"))
            .cast("string")
            .alias(t)
            for t in target
        ]
    )


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*names)


def rename_strip_tokens(df: DataFrame, tokens: Sequence[str] = NAME_TOKENS) -> DataFrame:
    """Remove every token from every column name, one token after the other."""
    renamed = []
    for name in df.columns:
        for token in tokens:
            name = name.replace(token, "")
        renamed.append(name)
    return df.toDF(*require_unique(renamed, "columns after renaming"))


def filter_survivor(df: DataFrame, flag: str = "ov") -> DataFrame:
    """Rows whose survivor flag is true; all rows when there is no such column."""
    found = resolve(df.schema, flag)
    return df if found is None else df.where(truthy(F.col(flag), found.element))


def drop_null_rows(
    df: DataFrame, how: str = "any", subset: Sequence[str] | None = None
) -> DataFrame:
    """Drop rows in which any / all of the columns are NULL."""
    return df.na.drop(how=how, subset=list(subset) if subset else None)


def fill_nulls(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Fill NULLs per column.  A value is cast to its column's type, so it always takes effect."""
    fills = {}
    for name, value in values.items():
        field = find_field(df.schema, name)
        if field is None:
            raise ValueError(f"no column '{name}'")
        fills[field.name] = F.coalesce(F.col(f"`{field.name}`"), F.lit(value).cast(field.dataType))
    return df.withColumns(fills)


def stamp_columns(df: DataFrame, **values: Any) -> DataFrame:
    """Add literal columns, e.g. ``createdDate`` and ``updatedDate`` of a run."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by position, duplicates kept.

    All columns become strings first: a text column next to a number would otherwise be coerced to
    a number and fail on its first text.
    """
    as_text = [
        df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
        for df in (first, *others)
    ]
    out = as_text[0]
    for df in as_text[1:]:
        out = out.union(df)
    return out


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by name (case aside), duplicates kept; every frame must have the same columns."""
    out = first
    for df in others:
        out = out.unionByName(df)
    return out


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct whole rows; copies collapse on the map side before the shuffle."""
    return df.dropDuplicates()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """The number of rows, as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(name))
