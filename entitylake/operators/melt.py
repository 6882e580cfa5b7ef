"""Attributes to long rows ``(uri, value, joined_column, EntityID)``.

All configured attributes are gathered in one array per document and exploded once: one scan and
one generator, however many attributes there are, and no union of branches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from entitylake.functions.paths import (
    AttributePath,
    attribute_paths,
    elements,
    find_field,
    is_struct,
    require_unique,
    resolve,
    truthy,
)
from entitylake.functions.uri import attribute_name, entity_id, sub_attribute_name
from entitylake.operators.columns import empty_frame
from entitylake.operators.nested import flattened_names

LONG_COLUMNS = ("uri", "value", "joined_column", "EntityID")
PREFER = ("value", "lookup_code", "first_field")


def _value_field(path: AttributePath, element: StructType, prefer: str) -> str:
    """Which field of the attribute holds its value.

    ``value``: the configured field.  ``lookup_code``: ``lookupCode`` where the attribute has one.
    ``first_field``: ``lookupCode`` only if it comes first among the attribute's flattened columns.
    """
    if prefer == "lookup_code":
        return "lookupCode" if find_field(element, "lookupCode") else path.field
    if prefer == "first_field":
        flat = flattened_names(StructType([StructField(path.leaf, element)]))
        return "lookupCode" if flat and "lookupCode" in flat[0] else path.field
    if prefer == "value":
        return path.field
    raise ValueError(f"prefer must be one of {PREFER}, not '{prefer}'")


def _strings(owners: Column, element: StructType, name: str, path: str) -> Column:
    """Field ``name`` of every owner, as strings."""
    field = find_field(element, name)
    if field is None:
        raise ValueError(f"attribute '{path}' has no field '{name}'")
    if is_struct(field.dataType) or isinstance(field.dataType, ArrayType):
        raise ValueError(f"field '{name}' of '{path}' is nested; configure the paths inside it")
    return owners.getField(field.name).cast("array<string>")


def _labelling(texts: Mapping[str, str]) -> Callable[[Column], Column]:
    """Rebuild a ``(uri, value)`` pair with constant labels behind it."""
    return lambda e: F.struct(
        e.getField("uri").alias("uri"),
        e.getField("value").alias("value"),
        *[F.lit(text).alias(name) for name, text in texts.items()],
    )


def _exploded(
    docs: DataFrame,
    paths: Sequence[AttributePath],
    prefer: str,
    keep_empty: bool,
    labels: Mapping[AttributePath, Sequence[str]] | None = None,
    label_names: Sequence[str] = (),
) -> DataFrame | None:
    """``uri, value`` (and constant labels) of every element of every attribute that exists."""
    require_unique((p.path for p in paths), "attribute paths")
    known = [p for p in paths if resolve(docs.schema, p.path) is not None]
    gathered = []
    for path in known:
        found = resolve(docs.schema, path.path)
        if not is_struct(found.element):
            raise ValueError(f"'{path.path}' is no attribute: {found.element.simpleString()}")
        owners = elements(None, found, outer=keep_empty)
        pairs = F.arrays_zip(
            _strings(owners, found.element, "uri", path.path).alias("uri"),
            _strings(owners, found.element, _value_field(path, found.element, prefer), path.path)
            .alias("value"),
        )
        texts = dict(zip(label_names, labels[path])) if labels else {}
        gathered.append(F.transform(pairs, _labelling(texts)))
    if not gathered:
        return None
    if not keep_empty:
        roots = dict.fromkeys(resolve(docs.schema, p.path).names[0] for p in known)
        docs = docs.where(reduce(or_, [F.col(f"`{r}`").isNotNull() for r in roots]))
    rows = F.flatten(F.array_compact(F.array(*gathered))) if len(gathered) > 1 else gathered[0]
    return docs.select(F.explode(rows).alias("e")).select(
        *[F.col("e").getField(n).alias(n) for n in ("uri", "value", *label_names)]
    )


def melt_single(
    docs: DataFrame,
    paths: Iterable[AttributePath | str | Mapping[str, str]],
    prefer: str = "value",
    keep_empty: bool = True,
) -> DataFrame:
    """Top-level attributes, labelled with the name in their URI.

    ``keep_empty``: a document without an attribute leaves one all-NULL row for it; such a row links
    to no crosswalk.
    """
    rows = _exploded(docs, attribute_paths(paths), prefer, keep_empty)
    if rows is None:
        return empty_frame(docs.sparkSession, LONG_COLUMNS)
    return rows.select(
        "uri", "value", attribute_name("uri").alias("joined_column"), entity_id("uri").alias("EntityID")
    )


def melt_nested(
    docs: DataFrame,
    paths: Iterable[AttributePath | str | Mapping[str, str]],
    prefer: str = "value",
    keep_empty: bool = True,
    suffix: bool = False,
) -> DataFrame:
    """Attributes inside attributes, labelled with the sub-attribute name in their URI.

    With ``suffix`` the label is followed by the name of the value field (``City`` + ``value``).
    """
    paths = attribute_paths(paths)
    label = sub_attribute_name("uri")
    if suffix:
        fields = {p: [p.field] for p in paths}
        rows = _exploded(docs, paths, prefer, keep_empty, fields, ["field"])
        label = F.concat(label, F.col("field"))
    else:
        rows = _exploded(docs, paths, prefer, keep_empty)
    if rows is None:
        return empty_frame(docs.sparkSession, LONG_COLUMNS)
    return rows.select(
        "uri", "value", label.alias("joined_column"), entity_id("uri").alias("EntityID")
    )


def melt_groups(
    docs: DataFrame,
    groups: Mapping[str, Iterable[AttributePath | str | Mapping[str, str]]],
    prefer: str = "value",
) -> DataFrame:
    """Nested attributes of several groups in one pass, with their group in ``attribute_group``.

    Rows with a NULL in any column are left out.
    """
    parts = []
    for group, paths in groups.items():
        paths = attribute_paths(paths)
        labels = {p: [group] for p in paths}
        parts.append((paths, labels))
    flat = [(p, g[p]) for paths, g in parts for p in paths]
    # one attribute may belong to several groups: each (path, group) is gathered once per group
    rows = None
    for wave in _waves(flat):
        part = _exploded(docs, list(wave), prefer, False, wave, ["attribute_group"])
        if part is not None:
            rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        return empty_frame(docs.sparkSession, [*LONG_COLUMNS, "attribute_group"])
    return rows.select(
        "uri",
        "value",
        sub_attribute_name("uri").alias("joined_column"),
        entity_id("uri").alias("EntityID"),
        "attribute_group",
    ).na.drop("any")


SINGLE_GROUP = ""


def melt_tagged(
    docs: DataFrame,
    paths: Iterable[AttributePath | str | Mapping[str, str]],
    groups: Mapping[str, Iterable[AttributePath | str | Mapping[str, str]]],
    prefer: str = "value",
) -> DataFrame:
    """Top-level attributes, in group ``SINGLE_GROUP``, and the nested ones of ``groups`` in one pass.

    Labels and rows are those of :func:`melt_single` and :func:`melt_groups`.
    """
    if SINGLE_GROUP in groups:
        raise ValueError("a group needs a name")
    tagged = {SINGLE_GROUP: attribute_paths(paths)}
    tagged |= {group: attribute_paths(listed) for group, listed in groups.items()}
    rows = None
    for wave in _waves([(p, [group]) for group, listed in tagged.items() for p in listed]):
        part = _exploded(docs, list(wave), prefer, False, wave, ["attribute_group"])
        if part is not None:
            rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        return empty_frame(docs.sparkSession, [*LONG_COLUMNS, "attribute_group"])
    single = F.col("attribute_group") == SINGLE_GROUP
    label = F.when(single, attribute_name("uri")).otherwise(sub_attribute_name("uri"))
    rows = rows.select(
        "uri", "value", label.alias("joined_column"), entity_id("uri").alias("EntityID"), "attribute_group"
    )
    whole = reduce(and_, [F.col(c).isNotNull() for c in LONG_COLUMNS])
    return rows.where(single | whole)


def _waves(
    flat: Sequence[tuple[AttributePath, Sequence[str]]],
) -> list[dict[AttributePath, Sequence[str]]]:
    """Split (path, labels) pairs so that no path occurs twice in one part: usually one part."""
    waves: list[dict[AttributePath, Sequence[str]]] = []
    for path, labels in flat:
        for wave in waves:
            if path not in wave:
                wave[path] = labels
                break
        else:
            waves.append({path: labels})
    return waves


def reference_ids(docs: DataFrame, path: str, prefer: str = "value") -> DataFrame:
    """Surviving rows of one id attribute; no rows when the documents do not have it."""
    found = resolve(docs.schema, path)
    if found is None:
        return empty_frame(docs.sparkSession, LONG_COLUMNS)
    attribute = AttributePath(path)
    owners = elements(None, found)
    columns = {
        "uri": _strings(owners, found.element, "uri", path),
        "value": _strings(
            owners, found.element, _value_field(attribute, found.element, prefer), path
        ),
    }
    flag = find_field(found.element, "ov")
    if flag is not None:
        columns["ov"] = owners.getField(flag.name)
    rows = docs.select(
        F.explode(F.arrays_zip(*[c.alias(n) for n, c in columns.items()])).alias("e")
    ).select("e.*")
    if flag is not None:
        rows = rows.where(truthy(F.col("ov"), flag.dataType))
    return rows.select(
        "uri", "value", attribute_name("uri").alias("joined_column"), entity_id("uri").alias("EntityID")
    )


def melt_grouped(
    docs: DataFrame,
    root: str,
    groups: Mapping[str, tuple[str | None, Sequence[str]]],
    prefer: str = "value",
) -> DataFrame:
    """Route the attributes under ``root`` to named groups: ``(group, attribute, uri, value)``.

    A group is ``(container, attribute names)``: the names are looked up inside that sub-attribute
    of ``root``, or directly under ``root`` when the container is ``None``.
    """
    labels: dict[AttributePath, Sequence[str]] = {}
    for group, (container, names) in groups.items():
        inside = f"{root}.value.{container}.value" if container else f"{root}.value"
        for name in names:
            labels[AttributePath(f"{inside}.{name}")] = [group, name]
    rows = _exploded(docs, list(labels), prefer, False, labels, ["group", "attribute"])
    if rows is None:
        return empty_frame(docs.sparkSession, ["group", "attribute", "uri", "value"])
    return rows.select("group", "attribute", "uri", "value")
