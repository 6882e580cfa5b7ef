"""Surviving values of an attribute, computed inside its parent row.

Array functions take the place of exploding sibling attributes against each other: the row count
stays that of the parent elements.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from entitylake.functions.paths import elements, find_field, is_struct, resolve, truthy


@dataclass(frozen=True)
class Survivors:
    """``values``: surviving values as strings.  ``present``: does the attribute keep its parent?

    An attribute with a survivor flag keeps the parent only if some element survives, whatever its
    value; one whose type has no flag always does.
    """

    values: Column
    present: Column


def survivors(
    parent: Column, parent_type: StructType, path: str, field: str = "value", flag: str = "ov"
) -> Survivors | None:
    """``None`` when the attribute or its value field does not exist in the schema."""
    value = resolve(parent_type, f"{path}.{field}")
    owner = resolve(parent_type, path)
    if value is None or owner is None or is_struct(value.element):
        return None
    owners = elements(parent, owner, outer=True)
    flagged = find_field(owner.element, flag)
    if flagged is not None:
        owners = F.filter(
            owners, lambda e: truthy(e.getField(flagged.name), flagged.dataType)
        )
    inner = resolve(owner.element, field)
    texts = owners.getField(inner.names[0])
    for _ in range(inner.depths[0]):
        texts = F.flatten(F.array_compact(texts))
    present = F.lit(True) if flagged is None else F.size(owners) > 0
    return Survivors(texts.cast("array<string>"), present)
