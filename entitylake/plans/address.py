"""Address attributes per source record, linked through the text of relation crosswalks.

An address belongs to a source record when its relation crosswalk value contains that record's
crosswalk value.  Of each attribute the largest surviving value counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

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
from entitylake.functions.survivors import Survivors, survivors
from entitylake.functions.uri import entity_id
from entitylake.operators.columns import conform_columns, empty_frame
from entitylake.operators.crosswalk import crosswalk_table, crosswalk_uri_table
from entitylake.operators.linkage import (
    BROADCAST_LIMIT,
    even_join,
    substring_links,
    substring_maxima,
)
from entitylake.operators.pivot import CROSSWALK_KEYS
from entitylake.sources.scratch import staged

ROOT = "attributes.Address"
LINK = "refRelation.crosswalks.value"
Paths = Iterable[AttributePath | str | Mapping[str, str]]


def _below(root: str, path: AttributePath) -> str:
    """The part of the path below ``root``."""
    depth = len(root.split("."))
    if ".".join(path.parts[:depth]).lower() != root.lower() or len(path.parts) == depth:
        raise ValueError(f"'{path.path}' is not below '{root}'")
    return ".".join(path.parts[depth:])


def _split_at_array(kind: StructType, path: str) -> tuple[str, str] | None:
    """The path up to and including its first array, and the rest."""
    found = resolve(kind, path)
    if found is None:
        return None
    head = next((i for i, d in enumerate(found.depths) if d), len(found.depths) - 1) + 1
    return ".".join(found.names[:head]), ".".join(found.names[head:])


def _surviving_addresses(
    docs: DataFrame, paths: list[AttributePath], root: str, link: str
) -> tuple[DataFrame, dict[AttributePath, Survivors | None]] | None:
    """One row per surviving address with ``entity``, ``address`` and ``haystacks``, and its attributes.

    Addresses are taken apart into the configured attributes before they are exploded, as a zip of
    arrays: that way the scan reads these attributes only.
    """
    found = resolve(docs.schema, root)
    if found is None:
        return None
    if not is_struct(found.element):
        raise ValueError(f"'{root}' does not hold structs")
    if resolve(found.element, link) is None:
        raise ValueError(f"'{root}' has no '{link}' to link by")
    flag = find_field(found.element, "ov")
    wanted = [link, *([flag.name] if flag else []), *[_below(root, p) for p in paths]]
    split = {w: _split_at_array(found.element, w) for w in wanted}
    heads = dict.fromkeys(s[0] for s in split.values() if s)
    whole = elements(None, found)
    columns = {
        head: reduce(lambda c, name: c.getField(name), head.split("."), whole) for head in heads
    }
    zipped = F.arrays_zip(*[c.alias(h.replace(".", "_")) for h, c in columns.items()])
    rows = docs.where(F.col(f"`{found.names[0]}`").isNotNull())
    uri = resolve(docs.schema, "uri")
    owner = entity_id(f"`{uri.names[0]}`") if uri else F.lit(None).cast("string")
    rows = rows.select(owner.alias("entity"), F.explode(zipped).alias("address"))
    kind, address = rows.schema["address"].dataType, F.col("address")

    def inside(path: str) -> str | None:
        """The path within a zipped address."""
        parts = split[path]
        if parts is None:
            return None
        head, tail = parts[0].replace(".", "_"), parts[1]
        return f"{head}.{tail}" if tail else head

    if flag is not None:
        rows = rows.where(truthy(address.getField(flag.name), flag.dataType))
    kept = {}
    for path in paths:
        place = inside(_below(root, path))
        kept[path] = survivors(address, kind, place, path.field) if place else None
    known = [s.present for s in kept.values() if s is not None]
    if not known:
        return None
    links = elements(address, resolve(kind, inside(link))).cast("array<string>")
    return rows.where(reduce(or_, known)).withColumn("haystacks", links), kept


def _per_link(rows: DataFrame, **values: Column) -> DataFrame:
    """A row per link text of an address, its values computed once per address."""
    computed = rows.select("haystacks", *[v.alias(n) for n, v in values.items()])
    out = computed.select(
        F.explode("haystacks").alias("haystack"), *[F.col(f"`{n}`") for n in values]
    )
    return out.where(F.col("haystack").isNotNull())


def address_wide(
    docs: DataFrame,
    paths: Paths,
    root: str = ROOT,
    link: str = LINK,
    strategy: str = "auto",
    limit: int = BROADCAST_LIMIT,
    records: DataFrame | None = None,
    same_entity: bool = False,
) -> DataFrame:
    """One row per ``(crosswalks_value, entityid, cross_source)`` and a column per attribute.

    A source record appears when some configured attribute survives in an address linked to it.
    Attributes the schema does not have are NULL columns.

    The distinct crosswalk table is read three times (statistics, needles, result keys) and is
    therefore written once while the plan is built; pass ``records`` to supply it.  Needles too many
    to broadcast also have the address texts written, reduced to one row each.  With ``same_entity`` an
    address is linked to source records of its own entity only, which its document's URI names.
    """
    paths = attribute_paths(paths)
    names = require_unique([p.qualified for p in paths], "attribute names")
    columns = [*names, *CROSSWALK_KEYS]
    addresses = _surviving_addresses(docs, paths, root, link)
    if addresses is None:
        return empty_frame(docs.sparkSession, columns)
    if records is None:
        records = staged(crosswalk_table(docs, keep_empty=False), "crosswalks")
    rows, kept = addresses
    values = {
        n: F.lit(None).cast("string") if kept[p] is None else F.array_max(kept[p].values)
        for p, n in zip(paths, names)
    }
    if same_entity:
        linked = _per_link(rows, EntityID=F.col("entity"), **values).where("EntityID is not null")
    else:
        linked = _per_link(rows, **values)
    own = ["EntityID"] if same_entity else []
    per_needle = substring_maxima(
        linked, records, "haystack", "crosswalks_value", strategy, limit, by=own, exact=False
    )
    keys = ["crosswalks_value", *own]
    linked = even_join(per_needle.withColumnRenamed("gram", "crosswalks_value"), records, keys)
    return conform_columns(linked, columns)


def melt_address(
    crosswalks: DataFrame,
    docs: DataFrame,
    paths: Paths,
    label: str = "qualified",
    root: str = ROOT,
    link: str = LINK,
    needle: str = "crosswalks_value",
    strategy: str = "auto",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Distinct long rows: the columns of ``crosswalks``, then ``value`` and ``joined_column``.

    ``label`` is ``qualified`` (``City``, ``Zip_Zip5``) or ``labelled`` (``CityValue``, ``Zip5Value``;
    equal sub-attributes of different containers then share a label).  Copies among the crosswalk
    rows are kept as they are.  ``crosswalks`` is read three times: pass a written table.
    """
    paths = attribute_paths(paths)
    if label not in ("qualified", "labelled"):
        raise ValueError(f"label must be 'qualified' or 'labelled', not '{label}'")
    names = [p.qualified if label == "qualified" else p.labelled for p in paths]
    if label == "qualified":
        require_unique(names, "attribute names")
    columns = [*crosswalks.columns, "value", "joined_column"]
    addresses = _surviving_addresses(docs, paths, root, link)
    if addresses is None:
        empty = crosswalks.where(F.lit(False))
        return empty.withColumns({c: F.lit(None).cast("string") for c in columns[-2:]})
    rows, kept = addresses
    pairs = [
        F.arrays_zip(
            kept[p].values.alias("value"),
            F.transform(kept[p].values, _constant(n)).alias("joined_column"),
        )
        for p, n in zip(paths, names)
        if kept[p] is not None
    ]
    addressed = _per_link(rows, pairs=F.concat(*pairs))
    found = substring_links(addressed, crosswalks, "haystack", needle, strategy, limit, exact=False)
    long = found.select(F.col("gram").alias(needle), F.explode("pairs").alias("e"))
    per_needle = long.select(needle, "e.value", "e.joined_column").distinct()
    return even_join(per_needle, crosswalks, [needle]).select(*columns)


def melt_address_uri(
    docs: DataFrame,
    paths: Paths,
    root: str = ROOT,
    link: str = LINK,
    strategy: str = "auto",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Distinct ``(uri, cross_value, value, joined_column, EntityID)``: address values by attribute URI.

    A row per URI that a linked source record lists; ``cross_value`` is the record's crosswalk value, and
    ``EntityID`` the entity that the URI names, not that of the address.  Labels are ``CityValue``; equal
    sub-attributes of different containers share one.
    """
    listed = crosswalk_uri_table(docs, keep_empty=False)
    listed = listed.select("uri", F.col("sourceid").alias("cross_value")).distinct()
    rows = melt_address(
        staged(listed, "listed"), docs, paths, "labelled", root, link, "cross_value", strategy, limit
    )
    return rows.withColumn("EntityID", entity_id("uri"))


def _constant(text: str):
    return lambda _: F.lit(text)
