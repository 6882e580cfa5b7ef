"""Entity attributes per source record, linked through attribute URIs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylake.functions.paths import AttributePath, attribute_paths, require_unique
from entitylake.functions.uri import instance_id
from entitylake.operators.crosswalk import crosswalk_uri_table
from entitylake.operators.columns import conform_columns, stamp_columns
from entitylake.operators.linkage import (
    even_join,
    largest_value_per_uri,
    nested_entity_join,
    reference_id_join,
    uri_join,
)
from entitylake.operators.melt import (
    SINGLE_GROUP,
    melt_groups,
    melt_single,
    melt_tagged,
    reference_ids,
)
from entitylake.operators.pivot import NESTED_KEYS, SINGLE_KEYS, pivot_max, pivot_single

Paths = Iterable[AttributePath | str | Mapping[str, str]]


def linked_single(
    docs: DataFrame, paths: Paths, names: Sequence[str], prefer: str = "value"
) -> DataFrame:
    """One row per source record and entity with the largest value of each named attribute.

    Shuffles: attribute rows to drop copies, both sides of the URI join, the pivot.
    """
    attributes = largest_value_per_uri(melt_single(docs, paths, prefer, keep_empty=False))
    crosswalks = crosswalk_uri_table(docs, keep_empty=False)
    return pivot_single(uri_join(crosswalks, attributes), names)


def entity_wide(
    docs: DataFrame,
    paths: Paths,
    names: Sequence[str],
    reference_path: str,
    reference_name: str = "ReferenceId",
    prefer: str = "value",
    single: DataFrame | None = None,
    how: str = "inner",
    **stamps: str,
) -> DataFrame:
    """The entity dataset: single attributes, surviving reference ids, run stamps.

    Columns: ``names``, the record keys, the reference id, the stamps.  Pass ``single`` to reuse
    what :func:`linked_single` gave.
    """
    paths = [p for p in attribute_paths(paths) if p.path.lower() != reference_path.lower()]
    if single is None:
        single = linked_single(docs, paths, [n for n in names if n != reference_name], prefer)
    columns = [*[n for n in names if n != reference_name], *SINGLE_KEYS, reference_name]
    ids = reference_ids(docs, reference_path, prefer)
    return reference_id_join(single, ids, reference_name, columns, how, **stamps)


def linked_nested(
    docs: DataFrame, groups: Mapping[str, Paths], prefer: str = "value"
) -> DataFrame:
    """All groups' nested attributes in one pass: one row per group, instance and source record.

    The document scan, the URI join and the pivot happen once, not once per group; the frame has
    the attributes of every group as columns.
    """
    groups = {g: attribute_paths(paths) for g, paths in groups.items()}
    for group, paths in groups.items():
        require_unique([p.leaf for p in paths], f"attribute names in group '{group}'")
    names = list(dict.fromkeys(p.leaf for paths in groups.values() for p in paths))
    attributes = largest_value_per_uri(melt_groups(docs, groups, prefer))
    linked = uri_join(crosswalk_uri_table(docs, keep_empty=False), attributes)
    linked = linked.withColumn("cross_uri", instance_id("uri"))
    return pivot_max(linked, ["attribute_group", *NESTED_KEYS], names)


def linked_tagged(
    docs: DataFrame,
    paths: Paths,
    names: Sequence[str],
    groups: Mapping[str, Paths],
    prefer: str = "value",
) -> DataFrame:
    """What :func:`linked_single` and :func:`linked_nested` give, in one frame and one pass.

    One melt, one crosswalk table, one URI join and one aggregation serve the single attributes, whose
    rows have the group ``SINGLE_GROUP``, and all attribute groups.  Write it as a table before it feeds
    both :func:`single_of` and :func:`groups_wide`.
    """
    groups = {g: attribute_paths(listed) for g, listed in groups.items()}
    for group, listed in groups.items():
        require_unique([p.leaf for p in listed], f"attribute names in group '{group}'")
    leaves = [p.leaf for listed in groups.values() for p in listed]
    attributes = largest_value_per_uri(melt_tagged(docs, paths, groups, prefer))
    linked = uri_join(crosswalk_uri_table(docs, keep_empty=False), attributes)
    single = F.col("attribute_group") == SINGLE_GROUP
    linked = linked.withColumns(
        {
            "cross_uri": F.when(~single, instance_id("uri")),
            "sourceid": F.when(single, F.col("sourceid")),
        }
    )
    keys = ["attribute_group", *NESTED_KEYS, "sourceid"]
    return pivot_max(linked, keys, list(dict.fromkeys([*names, *leaves])))


def single_of(tagged: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows of :func:`linked_single`."""
    rows = tagged.where(F.col("attribute_group") == SINGLE_GROUP)
    return rows.select(*SINGLE_KEYS, *names)


def groups_wide(
    tagged: DataFrame, groups: Mapping[str, Paths], unique_id: str = "UniqueId", **stamps: str
) -> DataFrame:
    """All groups of :func:`nested_wide` in one frame: a row's ``attribute_group`` says which.

    One entity join.  A group's rows have NULL for the attributes of other groups.
    """
    leaves = list(dict.fromkeys(p.leaf for listed in groups.values() for p in attribute_paths(listed)))
    keys = ["EntityID", "cross_value"]
    owners = tagged.where(F.col("attribute_group") == SINGLE_GROUP)
    owners = owners.select(*keys, F.col(unique_id).alias("_unique"))
    nested = tagged.where(F.col("attribute_group") != SINGLE_GROUP)
    nested = nested.select(*keys, "cross_source", *leaves, "attribute_group")
    rows = even_join(nested, owners, keys).withColumn(unique_id, F.col("_unique"))
    rows = conform_columns(
        rows.drop("_unique", *keys), [unique_id, "cross_source", *leaves, "attribute_group"]
    )
    return stamp_columns(rows, **stamps) if stamps else rows


def nested_wide(
    nested: DataFrame,
    single: DataFrame,
    groups: Mapping[str, Paths],
    unique_id: str = "UniqueId",
    **stamps: str,
) -> dict[str, DataFrame]:
    """One lazy frame per group: unique id, source, the group's attributes, the stamps.

    ``nested`` and ``single`` feed every group, so pass them as written tables when there are
    several groups (:func:`entitylake.sources.scratch.staged`).
    """
    out = {}
    for group, paths in groups.items():
        names = [p.leaf for p in attribute_paths(paths)]
        rows = nested.where(F.col("attribute_group") == F.lit(group)).select(*NESTED_KEYS, *names)
        out[group] = nested_entity_join(single, rows, names, unique_id, **stamps)
    return out
