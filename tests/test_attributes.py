"""Melts, pivots and the entity plan."""

import pytest
from oracle import actual
from pyspark.sql import functions as F

from entitylake.operators import pivot as pv
from entitylake.operators.melt import (
    melt_grouped,
    melt_groups,
    melt_nested,
    melt_single,
    reference_ids,
)
from entitylake.plans.entity import entity_wide, linked_nested, linked_single, nested_wide

DDL = (
    "attributes struct<"
    "Name: array<struct<ov: boolean, uri: string, value: string>>, "
    "Code: array<struct<lookupCode: string, uri: string, value: bigint>>, "
    "Labelled: array<struct<label: string, lookupCode: string, uri: string, value: string>>, "
    "Ref: array<struct<ov: string, uri: string, value: string>>, "
    "Spot: array<struct<uri: string, value: struct<"
    "City: array<struct<uri: string, value: string>>, "
    "Land: array<struct<lookupCode: string, uri: string, value: string>>>>>>, "
    "crosswalks array<struct<attributes: array<string>, type: string, uri: string, value: string>>"
)
CITY, LAND = "attributes.Spot.value.City", "attributes.Spot.value.Land"


def uri(entity, tail):
    return f"entities/{entity}/attributes/{tail}"


def document(entity, name="n", code=5):
    u = lambda tail: uri(entity, tail)
    return (
        (
            [(True, u("Name/1"), name)] if name else [],
            [("five", u("Code/1"), code)],
            [("Five", "five", u("Labelled/1"), "5")],
            [("true", u("Ref/1"), f"R{entity}"), ("x", u("Ref/2"), "bad"), (None, u("Ref/3"), "no")],
            [
                (u("Spot/s1"), ([(u("Spot/s1/City/1"), "Rome"), (u("Spot/s1/City/2"), "Pisa")],
                                [("I", u("Spot/s1/Land/1"), "Italy")])),
                (u("Spot/s2"), ([], [])),
            ],
        ),
        [([u("Name/1"), u("Code/1"), u("Spot/s1/City/1"), u("Spot/s1/Land/1")],
          "configuration/sources/S", f"entities/{entity}/crosswalks/c", f"V{entity}")],
    )


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([document(1), document(2, name=None)], DDL)


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_single_keeps_one_empty_row_per_document(docs):
    paths = ["attributes.name", "attributes.Nowhere"]
    expected = [(uri(1, "Name/1"), "n", "Name", "1"), (None, None, None, None)]
    assert rows(melt_single(docs, paths)) == sorted(map(str, expected))
    assert rows(melt_single(docs, paths, keep_empty=False)) == [str(expected[0])]
    assert melt_single(docs, ["attributes.Nowhere"]).isEmpty()


def test_value_is_text_and_lookup_rules_differ(docs):
    paths = ["attributes.Code", "attributes.Labelled"]

    def values(prefer):
        return {(r.joined_column, r.value) for r in melt_single(docs, paths, prefer).collect()}

    assert values("value") == {("Code", "5"), ("Labelled", "5")}
    assert values("lookup_code") == {("Code", "five"), ("Labelled", "five")}
    assert values("first_field") == {("Code", "five"), ("Labelled", "5")}
    with pytest.raises(ValueError, match="prefer"):
        values("other")


def test_configuration_errors(docs):
    with pytest.raises(ValueError, match="duplicate"):
        melt_single(docs, ["attributes.Name", "attributes.name"])
    with pytest.raises(ValueError, match="nested"):
        melt_single(docs, ["attributes.Spot"])
    with pytest.raises(ValueError, match="no field"):
        melt_single(docs, [{"attributes.Name": "lookupCode"}])


def test_nested_rows_per_empty_instance(docs):
    got = melt_nested(docs.limit(1), [CITY])
    assert rows(got) == sorted(map(str, [
        (uri(1, "Spot/s1/City/1"), "Rome", "City", "1"),
        (uri(1, "Spot/s1/City/2"), "Pisa", "City", "1"),
        (None, None, None, None),
    ]))
    labelled = melt_nested(docs, [{LAND: "lookupCode"}], keep_empty=False, suffix=True)
    assert {(r.joined_column, r.value) for r in labelled.collect()} == {("LandlookupCode", "I")}


def test_reference_ids_need_a_true_flag(docs):
    assert sorted(r.value for r in reference_ids(docs, "attributes.Ref").collect()) == ["R1", "R2"]
    assert reference_ids(docs, "attributes.Nowhere").isEmpty()


def test_grouped_routes_by_container(docs):
    groups = {"spot": (None, ["City", "Land", "Zip"]), "void": ("Zip", ["Zip5"])}
    got = melt_grouped(docs, "attributes.Spot", groups)
    assert {(r.group, r.attribute) for r in got.collect()} == {("spot", "City"), ("spot", "Land")}
    assert got.count() == 6


def test_one_attribute_in_two_groups(docs):
    got = melt_groups(docs, {"a": [CITY, LAND], "b": [CITY]})
    counts = {r[0]: r[1] for r in got.groupBy("attribute_group").count().collect()}
    assert counts == {"a": 6, "b": 4}


LONG = [
    ("k", "1", "s", "9", " city "), ("k", "1", "s", "10", "City"), ("k", "1", "s", None, "City"),
    ("l", "1", "s", "x", "Street"), ("k", "1", "s", "z", "Zip"),
]


@pytest.fixture
def long(spark):
    return spark.createDataFrame(
        LONG, "crosswalks_value string, entityid string, cross_source string, value string, "
        "joined_column string",
    )


def test_pivots_take_the_largest_text(long):
    loose = pv.pivot_conditional(long, ["City", "Fax"])
    assert loose.columns == ["crosswalks_value", "entityid", "cross_source", "City", "Fax"]
    assert rows(loose) == [
        "('k', '1', 's', '9', None)", "('l', '1', 's', None, None)"
    ]
    exact = pv.pivot_max(long, pv.CROSSWALK_KEYS, ["City"])
    assert rows(exact)[0] == "('k', '1', 's', '10')"
    explicit = pv.pivot_explicit(long, ["City", "Fax"])
    assert rows(explicit)[0] == "('k', '1', 's', '10', None)"
    found = pv.pivot_discovered(long, ["entityid"])
    assert found.columns == ["entityid", " city ", "City", "Street", "Zip"]
    with pytest.raises(ValueError, match="duplicate"):
        pv.pivot_conditional(long, ["City", "city"])
    with pytest.raises(ValueError, match="match"):
        pv.pivot_max(long, ["entityid"], ["City"], match="other")


def test_entity_plan(docs):
    out = entity_wide(
        docs, ["attributes.Name", "attributes.Code", "attributes.Ref"], ["Name", "Code"],
        "attributes.Ref", createdDate="t",
    )
    assert out.columns == [
        "Name", "Code", "cross_source", "cross_value", "sourceid", "EntityID", "ReferenceId",
        "createdDate",
    ]
    assert rows(out) == [
        "('n', '5', 'S', 'c', 'V1', '1', 'R1', 't')", "(None, '5', 'S', 'c', 'V2', '2', 'R2', 't')"
    ]


def test_copies_of_documents_change_nothing_but_reference_rows(spark, docs):
    many = docs.union(docs).union(docs)
    paths, names = ["attributes.Name", "attributes.Code"], ["Name", "Code"]
    assert actual(linked_single(many, paths, names)) == actual(linked_single(docs, paths, names))
    groups = {"g": [CITY, LAND]}
    assert actual(linked_nested(many, groups)) == actual(linked_nested(docs, groups))


def test_nested_plan_gives_one_frame_per_group(docs):
    groups = {"city": [CITY], "both": [CITY, LAND], "none": ["attributes.Spot.value.Zip"]}
    single = linked_single(docs, ["attributes.Code"], ["Code"])
    frames = nested_wide(linked_nested(docs, groups), single, groups, unique_id="Code")
    assert frames["both"].columns == ["Code", "cross_source", "City", "Land"]
    assert rows(frames["both"]) == ["('5', 'S', 'Rome', 'Italy')"] * 2
    assert rows(frames["city"]) == ["('5', 'S', 'Rome')"] * 2
    assert frames["none"].isEmpty()


def test_names_compare_exactly_in_the_entity_pivot(docs):
    single = linked_single(docs, ["attributes.Code"], ["code"])
    assert single.where(F.col("code").isNotNull()).isEmpty() and single.count() == 2
