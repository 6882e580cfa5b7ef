import datetime as dt

import pytest
from pyspark.sql import functions as F

from entitylake.functions.deid import deidentify
from entitylake.functions.uri import entity_id, sub_attribute_name, uri_part
from entitylake.operators import columns as ops


def test_conform_is_strict_about_names(spark):
    df = spark.createDataFrame([(1, "x")], "a int, B string")
    out = ops.conform_columns(df, ["b", "A"])
    assert out.dtypes == [("b", "string"), ("A", "string")]
    assert out.first() == ("x", "1")
    with pytest.raises(ValueError, match="missing"):
        ops.conform_columns(df, ["a", "b", "c"])
    with pytest.raises(ValueError, match="unexpected"):
        ops.conform_columns(df, ["a"], allow_missing=True)
    with pytest.raises(ValueError, match="duplicate"):
        ops.conform_columns(df, ["a", "A", "b"])
    assert ops.conform_columns(df, ["a", "b", "c"], allow_missing=True).first().c is None


def test_ensure_columns_keeps_and_adds(spark):
    df = spark.createDataFrame([(1, (2,))], "a int, s struct<x: int>")
    out = ops.ensure_columns(df, ["A", "new", "s.x"])
    assert out.columns == ["a", "s", "new", "s.x"]
    assert tuple(out.select("a", "new", "`s.x`").first()) == (1, None, 2)


def test_rename_detects_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "a_tkn int, value_a int")
    with pytest.raises(ValueError, match="duplicate"):
        ops.rename_strip_tokens(df)


def test_rename_goes_token_by_token(spark):
    df = spark.createDataFrame([(1, 2)], "attributes_Addresses_City_value int, id_tkn int")
    assert ops.rename_strip_tokens(df).columns == ["City", "id"]


def test_survivor_flags_of_any_type(spark):
    flags = spark.createDataFrame([("true",), ("false",), ("x",), (None,)], "ov string")
    assert ops.filter_survivor(flags).count() == 1
    booleans = spark.createDataFrame([(True,), (False,), (None,)], "ov boolean")
    assert ops.filter_survivor(booleans).count() == 1
    assert ops.filter_survivor(booleans, "other_ov").count() == 3


def test_fill_nulls_casts_to_the_column(spark):
    df = spark.createDataFrame([(None, None)], "a string, b int")
    assert tuple(ops.fill_nulls(df, {"A": 0, "b": 0}).first()) == ("0", 0)
    with pytest.raises(ValueError, match="no column"):
        ops.fill_nulls(df, {"c": 0})


def test_union_keeps_text_next_to_numbers(spark):
    numbers = spark.createDataFrame([(1,)], "v bigint")
    texts = spark.createDataFrame([("x",), ("x",)], "w string")
    assert sorted(r.v for r in ops.union_all(numbers, texts).collect()) == ["1", "x", "x"]


def test_empty_frame(spark):
    df = ops.empty_frame(spark, ["a", "b"])
    assert df.dtypes == [("a", "string"), ("b", "string")] and df.isEmpty()


def test_short_uri_gives_null(spark):
    df = spark.createDataFrame([("entities/7/attributes/A/1",), ("x",), (None,)], "u string")
    rows = df.select(entity_id("u"), sub_attribute_name("u"), uri_part("u", 0)).collect()
    assert [tuple(r) for r in rows] == [("7", None, "entities"), (None, None, "x"), (None,) * 3]


def test_deidentify(spark):
    rows = [(dt.date(2000, 3, 1), "03601"), (None, None), (dt.date(2024, 2, 29), "12")]
    df = spark.createDataFrame(rows, "dob date, zip string")
    out = deidentify(df, ["dob"], ["zip"], ["036"], as_of=dt.date(2024, 2, 29))
    got = [tuple(r) for r in out.select("Age", "YearOfBirth", "ZipCode").collect()]
    assert got == [(24, 2000, "000"), (None, None, None), (0, 2024, "12")]
    assert out.columns[:2] == ["dob", "zip"]
    assert deidentify(df) is df
    text = spark.createDataFrame([("2000-03-01",)], "dob string")
    assert deidentify(text, ["dob"], as_of=F.lit(dt.date(2024, 2, 29))).first().Age == 24
