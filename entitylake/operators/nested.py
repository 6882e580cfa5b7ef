"""Nested documents to flat frames.

``flatten_wide`` gives one table (sibling arrays multiply, as joins of their elements would);
``flatten_normalized`` gives one table per array or map and never multiplies siblings.  Both are
narrow: projections and generators, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from entitylake.functions.paths import (
    elements,
    is_array,
    is_map,
    is_repeated,
    is_struct,
    require_unique,
    resolve,
)


def _top(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass
class _Flat:
    """A pending output column."""

    name: str
    value: Column
    type: DataType


def _is_open(column: _Flat) -> bool:
    return is_struct(column.type) or is_array(column.type)


def flatten_wide(df: DataFrame, drop: Iterable[str] = ()) -> DataFrame:
    """Flatten until neither struct nor array is left; maps stay as they are.

    A struct gives way to its fields, named ``<column>_<field>`` and put last; an array is
    outer-exploded in place, so rows without elements survive with NULL.  A struct or array column
    whose flattened name is in ``drop`` is left out instead, before anything inside it is exploded.
    """
    unwanted = set(drop)
    pending = [_Flat(f.name, _top(f.name), f.dataType) for f in df.schema.fields]
    while True:
        first = next((c for c in pending if _is_open(c)), None)
        if first is None:
            break
        place = pending.index(first)
        if first.name in unwanted:
            del pending[place]
        elif is_struct(first.type):
            del pending[place]
            pending += [
                _Flat(f"{first.name}_{f.name}", first.value.getField(f.name), f.dataType)
                for f in first.type.fields
            ]
        else:
            # Spark takes one generator per select: settle everything else as a plain column
            require_unique((c.name for c in pending), "flattened columns")
            df = df.select(
                *[
                    (F.explode_outer(c.value) if c is first else c.value).alias(c.name)
                    for c in pending
                ]
            )
            pending = [
                _Flat(c.name, _top(c.name), c.type.elementType if c is first else c.type)
                for c in pending
            ]
    require_unique((c.name for c in pending), "flattened columns")
    return df.select(*[c.value.alias(c.name) for c in pending])


def flattened_names(schema: StructType) -> list[str]:
    """The column names ``flatten_wide`` would give for ``schema``, from metadata alone."""
    pending = [(f.name, f.dataType) for f in schema.fields]
    while True:
        place = next((i for i, (_, t) in enumerate(pending) if is_struct(t) or is_array(t)), None)
        if place is None:
            return [name for name, _ in pending]
        name, kind = pending[place]
        if is_array(kind):
            pending[place] = (name, kind.elementType)
        else:
            del pending[place]
            pending += [(f"{name}_{f.name}", f.dataType) for f in kind.fields]


def _leaves(schema: StructType) -> list[tuple[str, Column, DataType]]:
    """Dotted path, value and type of all fields reached through structs only."""
    out: list[tuple[str, Column, DataType]] = []

    def visit(path: str, value: Column, kind: DataType) -> None:
        if is_struct(kind):
            for f in kind.fields:
                visit(f"{path}.{f.name}", value.getField(f.name), f.dataType)
        else:
            out.append((path, value, kind))

    for field in schema.fields:
        visit(field.name, _top(field.name), field.dataType)
    return out


def _generator(outer: bool, pos: bool):
    if outer:
        return F.posexplode_outer if pos else F.explode_outer
    return F.posexplode if pos else F.explode


def flatten_normalized(
    df: DataFrame, outer: bool = True, pos: bool = True, name: str = "root"
) -> dict[str, DataFrame]:
    """One lazy frame per array or map, each with the scalars of everything above it.

    The frame ``name`` holds scalars and struct leaves.  Each array at path ``a.b`` adds the frame
    ``<parent>_a_b`` with its elements as rows (and ``a_b_pos``), each map one with ``a_b_key`` and
    ``a_b_value``; arrays inside them add further frames.  Positions of outer arrays are not carried
    into inner frames.
    """
    return _normalized(df, outer, pos, name, frozenset())


def _normalized(
    df: DataFrame, outer: bool, pos: bool, name: str, positions: frozenset[str]
) -> dict[str, DataFrame]:
    leaves = _leaves(df.schema)
    plain = [(p, v) for p, v, t in leaves if not is_repeated(t)]
    require_unique((p.replace(".", "_") for p, _, _ in leaves), f"columns of '{name}'")
    frames = {name: df.select(*[v.alias(p.replace(".", "_")) for p, v in plain])}
    carried = [v.alias(p.replace(".", "_")) for p, v in plain if p not in positions]
    for path, value, kind in leaves:
        if not is_repeated(kind):
            continue
        flat = path.replace(".", "_")
        outputs = [f"{flat}_key", f"{flat}_value"] if is_map(kind) else [flat]
        if pos:
            outputs.insert(0, f"{flat}_pos")
        child = df.select(*carried, _generator(outer, pos)(value).alias(*outputs))
        frames.update(
            _normalized(child, outer, pos, f"{name}_{flat}", frozenset([f"{flat}_pos"]))
        )
    return frames


def explode_map(
    df: DataFrame, column: str, outer: bool = True, pos: bool = True
) -> DataFrame:
    """Replace a map column by ``_key``, ``_value`` (and ``_pos``) columns, one row per entry."""
    names = [f"{column}_key", f"{column}_value"]
    if pos:
        names.insert(0, f"{column}_pos")
    others = [_top(c) for c in df.columns if c != column]
    return df.select(*others, _generator(outer, pos)(_top(column)).alias(*names))


def explode_array(
    df: DataFrame, column: str, outer: bool = True, pos: bool = True
) -> DataFrame:
    """Replace an array column by its elements (and ``_pos``), one row per element."""
    names = [f"{column}_pos", column] if pos else [column]
    others = [_top(c) for c in df.columns if c != column]
    return df.select(*others, _generator(outer, pos)(_top(column)).alias(*names))


def flatten_path(df: DataFrame, path: str, drop: Iterable[str] = ()) -> DataFrame:
    """Flatten what lies at ``path``, arrays on the way included; columns start with its last part.

    Only the arrays on the path and below it are exploded, never their siblings.
    """
    found = resolve(df.schema, path)
    if found is None:
        raise ValueError(f"no column at '{path}'")
    name = path.split(".")[-1]
    rows = df.select(F.explode(elements(None, found, outer=True)).alias(name))
    return flatten_wide(rows, drop)
