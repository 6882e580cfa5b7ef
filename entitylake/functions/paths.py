"""Attribute paths, resolved against a schema on the driver.

Everything here works on ``StructType`` metadata only: no job is started and no exception is used
to find out whether a column exists.  Names match without regard to case, and a path runs through
any number of arrays on its way to a field.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, StructField, StructType


def is_struct(data_type: DataType) -> bool:
    return isinstance(data_type, StructType)


def is_array(data_type: DataType) -> bool:
    return isinstance(data_type, ArrayType)


def is_map(data_type: DataType) -> bool:
    return isinstance(data_type, MapType)


def is_repeated(data_type: DataType) -> bool:
    """Arrays and maps: the types that need an explode."""
    return is_array(data_type) or is_map(data_type)


def find_field(struct: StructType, name: str) -> StructField | None:
    """The field called ``name``, ignoring case; ``None`` when absent, an error when ambiguous."""
    hits = [f for f in struct.fields if f.name.lower() == name.lower()]
    if len(hits) > 1:
        raise ValueError(f"'{name}' is ambiguous: {[f.name for f in hits]}")
    return hits[0] if hits else None


@dataclass(frozen=True)
class AttributePath:
    """One configured attribute: where it is, which field holds its value, what to call it."""

    path: str
    field: str = "value"

    @property
    def parts(self) -> list[str]:
        return self.path.split(".")

    @property
    def leaf(self) -> str:
        return self.parts[-1]

    @property
    def qualified(self) -> str:
        """``a.B.value.City`` -> ``City``; ``a.B.value.Zip.value.Zip5`` -> ``Zip_Zip5``."""
        if len(self.parts) == 4:
            return self.parts[3]
        if len(self.parts) == 6:
            return f"{self.parts[3]}_{self.parts[5]}"
        raise ValueError(f"attribute path must have 4 or 6 parts: '{self.path}'")

    @property
    def labelled(self) -> str:
        """Last part plus field name, ``City`` + ``Value``; not unique across containers."""
        return self.leaf + self.field.title()


def attribute_paths(
    entries: Iterable[AttributePath | str | Mapping[str, str]],
) -> list[AttributePath]:
    """Read a configured list: plain paths, or ``{path: field}`` mappings."""
    out: list[AttributePath] = []
    for entry in entries:
        if isinstance(entry, AttributePath):
            out.append(entry)
        elif isinstance(entry, str):
            out.append(AttributePath(entry))
        else:
            out.extend(AttributePath(path, field) for path, field in entry.items())
    return out


def require_unique(names: Iterable[str], what: str) -> list[str]:
    """The names as a list; an error when two of them differ at most by case."""
    names = list(names)
    folded = [n.lower() for n in names]
    repeated = sorted({n for n in names if folded.count(n.lower()) > 1})
    if repeated:
        raise ValueError(f"duplicate {what}: {repeated}")
    return names


@dataclass(frozen=True)
class Resolved:
    """A path that exists: per step the real field name, its array depth and the type inside."""

    names: tuple[str, ...]
    depths: tuple[int, ...]
    types: tuple[DataType, ...]

    @property
    def element(self) -> DataType:
        return self.types[-1]


def resolve(schema: StructType, path: str) -> Resolved | None:
    steps: list[tuple[str, int, DataType]] = []
    current: DataType = schema
    for part in path.split("."):
        field = find_field(current, part) if is_struct(current) else None
        if field is None:
            return None
        current, depth = field.dataType, 0
        while is_array(current):
            current, depth = current.elementType, depth + 1
        steps.append((field.name, depth, current))
    names, depths, types = zip(*steps)
    return Resolved(names, depths, types)


def has_column(df: DataFrame, path: str) -> bool:
    """Does the dotted path lead to a column of ``df``?"""
    return resolve(df.schema, path) is not None


def missing_paths(df: DataFrame, paths: Iterable[AttributePath | str]) -> list[str]:
    """The configured paths that resolve nowhere; their output columns will hold NULL only."""
    wanted = [p.path if isinstance(p, AttributePath) else p for p in paths]
    return [p for p in wanted if not has_column(df, p)]


def _or_one_null(items: Column, element: DataType) -> Column:
    """What an outer explode would yield: one NULL instead of no element."""
    return F.when(F.size(items) > 0, items).otherwise(F.array(F.lit(None).cast(element)))


def _filling(element: DataType) -> Callable[[Column], Column]:
    return lambda items: _or_one_null(items, element)


def elements(root: Column | None, found: Resolved, outer: bool = False) -> Column:
    """All elements at a resolved path as one flat array, however many arrays lie on the way.

    ``root`` is the struct the path starts from (``None`` for the row itself).  With ``outer`` an
    empty or missing array counts as one NULL element at every level, as with ``explode_outer``.
    """
    current, repeated, unfilled = root, False, False
    for name, depth, inner in zip(found.names, found.depths, found.types):
        current = F.col(f"`{name}`") if current is None else current.getField(name)
        levels = depth if repeated else max(depth - 1, 0)
        unfilled = unfilled or (depth > 0 and not repeated)
        for level in range(levels):
            if outer:
                kind = inner
                for _ in range(levels - 1 - level):
                    kind = ArrayType(kind)
                # the outermost array is filled only here, after all field accesses: a field of a
                # filled array would make the scan read whole elements
                if unfilled:
                    current = _or_one_null(current, ArrayType(kind))
                current = F.transform(current, _filling(kind))
                unfilled = False
            current = F.flatten(F.array_compact(current))
        repeated = repeated or depth > 0
    if outer and unfilled:
        current = _or_one_null(current, found.element)
    return current if repeated else F.array(current)


def truthy(flag: Column, data_type: DataType) -> Column:
    """A survivor flag as boolean; text that is no boolean counts as NULL, never as an error."""
    if isinstance(data_type, BooleanType):
        return flag
    return flag.cast("string").try_cast("boolean")
