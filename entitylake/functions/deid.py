"""De-identification of dates of birth and postal codes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def age_in_years(birth: Column, as_of: Column) -> Column:
    """Whole years of 365 days; leap days are not taken out.  A text that is no date gives NULL."""
    return F.floor(F.datediff(as_of, birth.try_cast("date")) / F.lit(365))


def birth_year(birth: Column) -> Column:
    return F.year(birth.try_cast("date"))


def zip3(code: Column, restricted: Iterable[str]) -> Column:
    """First three characters, ``000`` for the restricted prefixes."""
    prefix = F.substring(code, 1, 3)
    prefixes = list(restricted)
    if not prefixes:
        return prefix
    return F.when(prefix.isin(prefixes), F.lit("000")).otherwise(prefix)


def deidentify(
    df: DataFrame,
    birth_columns: Iterable[str] = (),
    zip_columns: Iterable[str] = (),
    restricted: Iterable[str] = (),
    as_of: dt.date | Column | None = None,
) -> DataFrame:
    """Add ``Age`` and ``YearOfBirth``, and ``ZipCode``; source columns stay.

    When several configured columns exist, the last one in column order supplies the value; columns
    of these names that exist already are replaced.
    """
    day = F.current_date() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    births, zips = list(birth_columns), list(zip_columns)
    added: dict[str, Column] = {}
    for name in df.columns:
        source = F.col(f"`{name}`")
        if name in births:
            added["Age"] = age_in_years(source, day)
            added["YearOfBirth"] = birth_year(source)
        if name in zips:
            added["ZipCode"] = zip3(source, restricted)
    return df.withColumns(added) if added else df
