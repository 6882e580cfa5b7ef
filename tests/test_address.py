"""The single-pass address plan against the plain one, on random documents."""

import pytest
from documents import (
    CITY,
    COUNTRY,
    RANK,
    ZIP4,
    ZIP5,
    plain_address_wide,
    plain_melt_address,
    random_documents,
)
from oracle import actual
from pyspark.sql import functions as F

from entitylake.operators.crosswalk import crosswalk_table
from entitylake.operators.linkage import substring_join
from entitylake.operators.pivot import pivot_conditional
from entitylake.plans.address import address_wide, melt_address, melt_address_uri

CHOICES = [
    ([CITY, COUNTRY, ZIP4, ZIP5], ["City", "Country", "Zip_Zip4", "Zip_Zip5"]),
    ([CITY, RANK], ["City", "Rank"]),
    ([ZIP5], ["Zip_Zip5"]),
    ([COUNTRY, "attributes.Address.value.County"], ["Country", "County"]),
]


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
@pytest.mark.parametrize("seed, choice", list(enumerate(CHOICES)))
def test_wide_equals_plain(spark, seed, choice, strategy):
    paths, names = choice
    docs = random_documents(spark, seed)
    plain = plain_address_wide(docs, paths, names).withColumnRenamed("EntityID", "entityid")
    wide = address_wide(docs, paths, strategy=strategy)
    assert wide.columns == [*names, "crosswalks_value", "entityid", "cross_source"]
    assert set(wide.dtypes) == {(c, "string") for c in wide.columns}
    assert actual(wide) == actual(plain)
    assert wide.count() > 5


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_melt_equals_plain_distinct(spark, strategy):
    docs = random_documents(spark, 11)
    paths = [CITY, RANK, ZIP4, ZIP5]
    records = crosswalk_table(docs)
    rows = melt_address(records, docs, paths, strategy=strategy)
    assert actual(rows) == actual(plain_melt_address(docs, paths).distinct().select(rows.columns))
    pivoted = pivot_conditional(rows, ["City", "Rank", "Zip_Zip4", "Zip_Zip5"])
    assert actual(pivoted) == actual(address_wide(docs, paths))


def test_labelled_melt_merges_containers(spark):
    docs = random_documents(spark, 5)
    rows = melt_address(crosswalk_table(docs), docs, [CITY, ZIP5], label="labelled")
    assert {r[0] for r in rows.select("joined_column").distinct().collect()} == {
        "CityValue", "Zip5Value"
    }


def test_configuration_errors(spark):
    docs = random_documents(spark, 1, 3)
    with pytest.raises(ValueError, match="duplicate"):
        address_wide(docs, [CITY, "attributes.address.value.city"])
    with pytest.raises(ValueError, match="not below"):
        address_wide(docs, ["attributes.Phone.value.Number"])
    with pytest.raises(ValueError, match="4 or 6"):
        address_wide(docs, ["attributes.Address.value.Zip_value.Zip4"])
    with pytest.raises(ValueError, match="to link by"):
        address_wide(docs, [CITY], link="refRelation.nowhere")


def test_absent_parts_give_empty_frames(spark):
    docs = random_documents(spark, 1, 3)
    assert address_wide(docs.drop("crosswalks"), [CITY]).isEmpty()
    assert address_wide(docs.drop("attributes"), [CITY]).isEmpty()
    nowhere = address_wide(docs, ["attributes.Address.value.County"])
    assert nowhere.isEmpty() and nowhere.columns[0] == "County"
    unflagged = docs.select(
        "crosswalks",
        F.struct(
            F.transform("attributes.Address", lambda a: a.dropFields("ov")).alias("Address")
        ).alias("attributes"),
    )
    assert address_wide(unflagged, [CITY]).count() >= address_wide(docs, [CITY]).count()


def test_largest_survivor_is_by_text(spark):
    schema = random_documents(spark, 0, 1).schema
    rows = [(
        "entities/1",
        ([(True, ([("xA1x",)],), ([(True, "9"), (True, "10"), (False, "z")], None, None, None))],),
        [(None, "configuration/sources/S", "entities/1/crosswalks/1", "A1")],
    )]
    assert address_wide(spark.createDataFrame(rows, schema), [CITY]).first().City == "9"


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_links_within_the_same_entity(spark, strategy):
    docs = random_documents(spark, 21, count=40)
    # six entities share the documents, and each the identifiers of the others
    shared = docs.withColumn("uri", F.concat(F.lit("entities/"), F.expr("cast(substr(uri, 10) as int) % 6")))
    own = crosswalk_table(shared)
    pairs = plain_melt_address(shared, [CITY, ZIP5])
    assert pairs.count() > 20 and own.count() > 5
    found = address_wide(shared, [CITY, ZIP5], strategy=strategy, same_entity=True)
    parts = [
        address_wide(
            shared.where(F.col("uri") == f"entities/{e}"), [CITY, ZIP5], strategy=strategy,
            records=own.where(F.col("EntityID") == str(e)),
        )
        for e in range(6)
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    assert actual(found) == actual(whole) and found.count() > 5


def test_melt_by_listed_uris(spark):
    docs = random_documents(spark, 22)
    rows = melt_address_uri(docs, [CITY, ZIP5])
    assert rows.columns == ["uri", "cross_value", "value", "joined_column", "EntityID"]
    listed = docs.select(F.explode("crosswalks").alias("c")).select(
        F.explode("c.attributes").alias("uri"), F.col("c.value").alias("cross_value")
    ).distinct()
    records = listed.select(F.col("cross_value").alias("crosswalks_value")).distinct()
    long = melt_address(records, docs, [CITY, ZIP5], label="labelled")
    want = listed.join(long, F.col("cross_value") == F.col("crosswalks_value")).select(
        "uri", "cross_value", "value", "joined_column", F.split("uri", "/")[1].alias("EntityID")
    )
    assert actual(rows) == actual(want) and rows.count() > 10


def test_substring_join_with_a_column_that_must_agree(spark):
    needles = spark.createDataFrame([("a", 1), ("a", 2), ("ab", 1), (None, 1), ("b", None)], "needle string, mine int")
    texts = spark.createDataFrame([("xab", 1), ("xab", 1), ("xab", 2), ("xab", None), ("b", 1)], "text string, theirs int")
    for strategy in ("broadcast", "shuffle"):
        found = substring_join(needles, texts, "needle", "text", strategy, same=("mine", "theirs"))
        assert sorted(tuple(r) for r in found.collect()) == [
            ("a", 1, "xab", 1), ("a", 1, "xab", 1), ("a", 2, "xab", 2), ("ab", 1, "xab", 1), ("ab", 1, "xab", 1),
        ]
