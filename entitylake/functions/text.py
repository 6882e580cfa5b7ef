"""Literal split from the left or the right, as built-in expressions.

The delimiter is a literal string, ``limit`` is the largest number of *splits* (0 or ``None``: all)
and NULL stays NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _quoted(delimiter: str) -> str:
    if not delimiter:
        raise ValueError("empty delimiter")
    # \E inside the delimiter would end the quotation, so it is closed and reopened around it
    return "\\Q" + delimiter.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split_limit(column: Column, delimiter: str, limit: int | None = None) -> Column:
    pieces = limit + 1 if limit and limit > 0 else -1
    return F.split(column, _quoted(delimiter), pieces)


def rsplit_limit(column: Column, delimiter: str, limit: int | None = None) -> Column:
    """Split from the right: the surplus on the left stays joined as the first piece."""
    pieces = F.split(column, _quoted(delimiter), -1)
    if not limit or limit < 0:
        return pieces
    head = F.greatest(F.size(pieces) - F.lit(limit), F.lit(1))
    return F.concat(
        F.array(F.array_join(F.slice(pieces, F.lit(1), head), delimiter)),
        F.slice(pieces, head + 1, F.size(pieces)),
    )
