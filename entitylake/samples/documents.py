"""Nested entity documents derived from the flat tables.

Three kinds of document share one schema: customers with attributes, customers with the crosswalks
of their orders, and suppliers with an address per line item.  Documents of the first kind come from
one row each.  The others gather child rows, about ``BLOCK`` of them at most: a parent with more
arrives as several partial documents, so no parent, however large, is ever gathered as a whole.  How
it is cut depends on the number and the content of its children, not on the files they are stored in.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    StringType,
    StructField,
    StructType,
)
from entitylake.operators.linkage import even_join

BLOCK = 16_384
LISTED = 100_000  # large parents, a few bytes each, that are broadcast


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(n, t) for n, t in fields.items()])


_S, _B = StringType(), BooleanType()
_TEXTS = ArrayType(_struct(ov=_B, uri=_S, value=_S))
_CODED = ArrayType(_struct(lookupCode=_S, ov=_B, uri=_S, value=_S))


def _holding(**fields: DataType) -> ArrayType:
    """An attribute whose value is again a struct of attributes."""
    return ArrayType(_struct(uri=_S, value=_struct(**fields)))


ADDRESS_TYPE = _struct(
    ov=_B,
    refRelation=_struct(
        crosswalks=ArrayType(_struct(attributeURIs=ArrayType(_S), value=_S))
    ),
    uri=_S,
    value=_struct(
        BRICK=_holding(ID=_TEXTS, Type=_TEXTS),
        City=_TEXTS,
        Country=_CODED,
        OriginalZip=_holding(Zip5=_TEXTS),
        Rank=ArrayType(_struct(uri=_S, value=_S)),
        Zip=_holding(Zip4=_TEXTS, Zip5=_TEXTS),
    ),
)
ATTRIBUTES_TYPE = _struct(
    Address=ArrayType(ADDRESS_TYPE),
    Name=_TEXTS,
    ReferenceId=_TEXTS,
    Segment=_CODED,
    UniqueId=_TEXTS,
)
CROSSWALK_TYPE = _struct(
    attributes=ArrayType(_S),
    createDate=_S,
    loadDate=_S,
    singleAttributeUpdateDates=_struct(Name=_S),
    sourceTable=_S,
    type=_S,
    uri=_S,
    value=_S,
)
DOCUMENT_SCHEMA = _struct(
    attributes=ATTRIBUTES_TYPE, crosswalks=ArrayType(CROSSWALK_TYPE), uri=_S
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _typed(df: DataFrame) -> DataFrame:
    """All columns of the document schema, absent ones NULL, then any others."""
    names = DOCUMENT_SCHEMA.names
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in DOCUMENT_SCHEMA.fields
        ],
        *[c for c in df.columns if c not in names],
    )


def _leaf(uri: str, value: str, ov: str | None = None, lookup: str | None = None) -> str:
    fields = [("lookupCode", lookup), ("ov", ov), ("uri", uri), ("value", value)]
    inner = ", ".join(f"'{n}', {v}" for n, v in fields if v is not None)
    return f"named_struct({inner})"


def _address(
    base: str, ov: str, link: str, cities: list[tuple[str, str]], country: str, code: str,
    rank: str, zip4: tuple[str, str], zip5: tuple[str, str], old_zip5: tuple[str, str],
    brick: str, kind: str,
) -> str:
    """SQL of one address element; ``base`` is the SQL of its URI."""

    def uri(tail: str) -> str:
        return f"concat({base}, '/{tail}')"

    city = ", ".join(_leaf(uri(f"City/c{i}"), v, o) for i, (v, o) in enumerate(cities, 1))
    listed = ", ".join([uri("City/c1"), uri("Rank/r1")])
    return f"""named_struct(
      'ov', {ov},
      'refRelation', named_struct('crosswalks',
          array(named_struct('attributeURIs', array({listed}), 'value', {link}))),
      'uri', {base},
      'value', named_struct(
        'BRICK', array(named_struct('uri', {uri('BRICK/b1')}, 'value', named_struct(
            'ID', array({_leaf(uri('BRICK/b1/ID/i1'), brick, 'true')}),
            'Type', array({_leaf(uri('BRICK/b1/Type/t1'), kind, 'true')})))),
        'City', array({city}),
        'Country', array({_leaf(uri('Country/k1'), country, 'true', code)}),
        'OriginalZip', array(named_struct('uri', {uri('OriginalZip/o1')}, 'value', named_struct(
            'Zip5', array({_leaf(uri('OriginalZip/o1/Zip5/f1'), *old_zip5)})))),
        'Rank', array({_leaf(uri('Rank/r1'), rank)}),
        'Zip', array(named_struct('uri', {uri('Zip/z1')}, 'value', named_struct(
            'Zip4', array({_leaf(uri('Zip/z1/Zip4/f1'), *zip4)}),
            'Zip5', array({_leaf(uri('Zip/z1/Zip5/f1'), *zip5)}))))))"""


def _customer_address(number: int) -> str:
    aid = f"a{number}"
    return _address(
        f"concat(uri, '/attributes/Address/{aid}')",
        ov="true",
        link="cast(null as string)",
        cities=[
            (f"concat('CITY', c_nationkey, '{aid}')", "true"),
            (f"concat('TOWN', c_custkey % 97, '{aid}')", "c_acctbal >= 0"),
        ],
        country="concat('Country ', c_nationkey)",
        code="concat('N', c_nationkey)",
        rank=f"'{number}'",
        zip4=("lpad(cast(c_custkey % 10000 as string), 4, '0')", "c_nationkey < 10"),
        zip5=("lpad(cast(c_custkey * 37 % 100000 as string), 5, '0')", "true"),
        old_zip5=("lpad(cast(c_custkey * 41 % 100000 as string), 5, '0')", "c_acctbal >= 0"),
        brick="concat('B', c_custkey % 11)",
        kind="'sales'",
    )


def customer_documents(spark: SparkSession, folder: str, *extra: Column) -> DataFrame:
    """One document per customer, without crosswalks; ``extra`` columns of the table follow.

    ``Name`` is empty for a negative balance; nations below 5 have a withdrawn second segment; nation
    7 has two surviving reference ids; even nations have a second address.
    """

    def uri(tail: str) -> str:
        return f"concat(uri, '/attributes/{tail}')"

    name = _leaf(uri("Name/n1"), "c_name", "true")
    legacy = _leaf(uri("Segment/s2"), "concat('LEGACY', c_nationkey)", "false", "'OLD'")
    segment = _leaf(uri("Segment/s1"), "c_mktsegment", "true", "substring(c_mktsegment, 1, 3)")
    ids = [
        _leaf(uri(f"ReferenceId/{i}"), f"concat('{c}', c_custkey)", o)
        for i, c, o in (("r1", "R", "true"), ("r2", "X", "false"), ("r3", "Q", "true"))
    ]
    one, two = _customer_address(1), _customer_address(2)
    attributes = f"""named_struct(
      'Address', if(c_nationkey % 2 = 0, array({one}, {two}), array({one})),
      'Name', if(c_acctbal >= 0, array({name}), array()),
      'ReferenceId', if(c_nationkey = 7, array({', '.join(ids)}), array({ids[0]}, {ids[1]})),
      'Segment', if(c_nationkey < 5, array({segment}, {legacy}), array({segment})),
      'UniqueId', array({_leaf(uri('UniqueId/u1'), "concat('U', c_custkey)", 'true')}))"""
    rows = table(spark, folder, "customer").withColumn("uri", F.expr("concat('entities/', c_custkey)"))
    return _typed(rows.select("uri", F.expr(attributes).alias("attributes"), *extra))


def _gathered(
    rows: DataFrame, parent: Column, columns: list[str], child: str, name: str
) -> DataFrame:
    """``uri`` and the ``child`` elements (SQL of ``uri`` and ``columns``) gathered per parent, about ``BLOCK``
    at most per document.

    Children are counted per parent, with partial counts before the shuffle.  Those of a parent with
    more than ``BLOCK`` are dealt to parts by a hash of their content; ``columns`` must tell the
    children of a parent apart.  Starts a job, which reads ``parent`` alone: usually no parent is that
    large, and nothing is joined then; up to ``LISTED`` large ones are broadcast.  Gathering has nothing
    to combine before the shuffle, so the flat ``columns`` are placed and gathered, which sorts them, and
    nested elements, many times larger, are made of a document's rows afterwards.
    """
    keys = ["uri"]
    flat = rows.select(parent.alias("uri"), *columns)
    parts = F.ceil(F.count(F.lit(1)) / BLOCK).alias("_parts")
    large = rows.groupBy(parent.alias("uri")).agg(parts).where("_parts > 1")
    listed = large.limit(LISTED + 1).collect()
    if listed:
        if len(listed) <= LISTED:
            few = F.broadcast(rows.sparkSession.createDataFrame(listed, large.schema))
            known = flat.join(few, "uri", "left")
        else:
            known = even_join(flat, large, ["uri"], "left")
        keys.append("_part")
        part = F.pmod(F.xxhash64(*columns), F.coalesce("_parts", F.lit(1)))
        flat = known.select("uri", part.alias("_part"), *columns)
    gathered = flat.repartition(*keys).groupBy(*keys).agg(F.collect_list(F.struct(*columns)).alias("_rows"))
    element = re.sub(rf"\b({'|'.join(columns)})\b", r"_row.\1", child)
    return gathered.select("uri", F.expr(f"transform(_rows, _row -> {element})").alias(name))


def crosswalk_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with a crosswalk per order; each lists the attributes its order supplied.

    Even orders supplied the first address of the customer, odd ones the second.
    """
    address = "concat(uri, '/attributes/Address/a', 1 + o_orderkey % 2)"
    listed = [
        f"concat(uri, '/attributes/{t}')"
        for t in ("Name/n1", "Segment/s1", "Segment/s2", "UniqueId/u1")
    ] + [f"concat({address}, '/{t}')" for t in ("City/c1", "City/c2", "Country/k1", "Rank/r1")]
    crosswalk = f"""named_struct(
      'attributes', array({', '.join(listed)}),
      'createDate', cast(o_orderdate as string), 'loadDate', cast(o_orderdate as string),
      'singleAttributeUpdateDates', named_struct('Name', cast(o_orderdate as string)),
      'sourceTable', o_orderpriority,
      'type', concat('configuration/sources/', o_orderstatus),
      'uri', concat(uri, '/crosswalks/', o_orderkey),
      'value', concat('ORD-', lpad(cast(o_orderkey as string), 8, '0')))"""
    columns = ["o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    customer = F.expr("concat('entities/', o_custkey)")
    orders = table(spark, folder, "orders")
    return _typed(_gathered(orders, customer, columns, crosswalk, "crosswalks"))


def address_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with an address per line item, whose link text contains the order's crosswalk value.

    Returned items are addresses that do not survive.
    """
    address = _address(
        "concat(uri, '/attributes/Address/', l_orderkey, '-', l_linenumber)",
        ov="l_returnflag <> 'R'",
        link="concat('L', l_linenumber, '|ORD-', lpad(cast(l_orderkey as string), 8, '0'))",
        cities=[
            ("concat('C', l_returnflag)", "l_quantity >= 10"),
            ("concat('B', l_linestatus)", "l_tax < 0.04"),
        ],
        country="concat('Country ', l_linenumber)",
        code="concat('N', l_linenumber)",
        rank="cast(l_linenumber as string)",
        zip4=("lpad(cast(l_suppkey as string), 4, '0')", "l_linestatus = 'O'"),
        zip5=("lpad(cast(l_partkey as string), 5, '0')", "true"),
        old_zip5=("lpad(cast(l_partkey * 7 % 100000 as string), 5, '0')", "l_quantity < 25"),
        brick="concat('B', l_linenumber)",
        kind="'sales'",
    )
    columns = [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax",
        "l_returnflag", "l_linestatus",
    ]
    supplier = F.expr("concat('entities/S', l_suppkey)")
    lines = table(spark, folder, "lineitem")
    rows = _gathered(lines, supplier, columns, address, "Address")
    attributes = F.struct(
        *[
            (F.col("Address") if f.name == "Address" else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ATTRIBUTES_TYPE.fields
        ]
    )
    return _typed(rows.select("uri", attributes.alias("attributes")))


def entity_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their attributes and, as partial documents, their crosswalks."""
    return customer_documents(spark, folder).unionByName(crosswalk_documents(spark, folder))


def linked_address_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses of suppliers and the crosswalks of customers they are linked to by text."""
    return address_documents(spark, folder).unionByName(crosswalk_documents(spark, folder))


def order_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a header struct and their line items as an array (NULL without items).

    An order with more than ``BLOCK`` items comes as several documents, cut by content.
    """
    columns = ["l_linenumber", "l_partkey", "l_quantity"]
    lines = table(spark, folder, "lineitem")
    items = _gathered(lines, F.col("l_orderkey"), columns, f"struct({', '.join(columns)})", "items")
    items = items.withColumnRenamed("uri", "o_orderkey")
    head = F.struct(
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("prio")
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", head.alias("head"))
    # an outer join could split a hot order's documents only on the side that has one row of it
    ordered = lines.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    bare = even_join(orders, ordered, ["o_orderkey"], "left_anti")
    return even_join(orders, items, ["o_orderkey"]).unionByName(bare, allowMissingColumns=True)
