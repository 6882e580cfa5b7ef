import json

import pytest
from pyspark.sql import functions as F

from entitylake.operators.crosswalk import crosswalk_table, crosswalk_uri_table
from entitylake.operators.nested import (
    explode_array,
    explode_map,
    flatten_normalized,
    flatten_path,
    flatten_wide,
    flattened_names,
)


def _parse(spark, docs):
    texts = spark.createDataFrame([(json.dumps(d),) for d in docs], "j string")
    schema = F.schema_of_json(F.lit(json.dumps(docs[0])))
    return texts.select(F.from_json("j", schema).alias("d")).select("d.*")


DOC = {
    "a": {"p": 1, "q": {"r": [1, 2]}},
    "b": [{"x": "u", "y": [7]}, {"x": "v", "y": []}],
    "c": 5,
}


def test_wide_column_order_and_product(spark):
    df = _parse(spark, [DOC, {"a": None, "b": [], "c": 6}])
    out = flatten_wide(df)
    assert out.columns == ["c", "a_p", "b_x", "b_y", "a_q_r"]
    assert flattened_names(df.schema) == out.columns
    rows = sorted(map(str, (tuple(r) for r in out.collect())))
    assert rows == sorted(map(str, [
        (5, 1, "u", 7, 1), (5, 1, "v", None, 1), (5, 1, "u", 7, 2), (5, 1, "v", None, 2),
        (6, None, None, None, None),
    ]))


def test_wide_drop_list_spares_scalars(spark):
    df = _parse(spark, [DOC])
    out = flatten_wide(df, ["a_q", "b_y", "c"])
    assert out.columns == ["c", "a_p", "b_x"]
    assert out.count() == 2


def test_wide_leaves_maps_and_rejects_collisions(spark):
    df = spark.range(1).select(F.create_map(F.lit("k"), F.lit(1)).alias("m"))
    assert flatten_wide(df).schema == df.schema
    clash = spark.range(1).select(F.struct(F.lit(1).alias("b")).alias("a"), F.lit(2).alias("a_b"))
    with pytest.raises(ValueError, match="duplicate"):
        flatten_wide(clash)


def test_normalized_names_and_columns(spark):
    df = _parse(spark, [DOC, {"a": None, "b": [], "c": 6}])
    frames = flatten_normalized(df, outer=True, pos=True, name="root")
    assert sorted(frames) == ["root", "root_a_q_r", "root_b", "root_b_b_y"]
    assert frames["root"].columns == ["a_p", "c"]
    assert frames["root_b"].columns == ["a_p", "c", "b_pos", "b_x"]
    assert frames["root_b_b_y"].columns == ["a_p", "c", "b_x", "b_y_pos", "b_y"]
    assert frames["root_b"].count() == 3
    inner = flatten_normalized(df, outer=False, pos=False)
    assert inner["root_b"].columns == ["a_p", "c", "b_x"]
    assert inner["root_b"].count() == 2


def test_normalized_maps_of_structs(spark):
    df = spark.range(2).select(
        "id",
        F.when(F.col("id") == 0, F.create_map(F.lit("k"), F.struct(F.lit(1).alias("n")))).alias("m"),
    )
    frames = flatten_normalized(df)
    assert frames["root_m"].columns == ["id", "m_pos", "m_key", "m_value_n"]
    assert sorted(map(tuple, frames["root_m"].collect())) == [(0, 0, "k", 1), (1, None, None, None)]


def test_normalized_decimal_inside_struct(spark):
    df = spark.sql("select named_struct('d', cast(1 as decimal(10,2)), 'e', 2) as s")
    assert flatten_normalized(df)["root"].columns == ["s_d", "s_e"]


def test_explode_switches(spark):
    df = spark.sql("select 1 as id, array(5, 6) as v union all select 2, array()")
    assert explode_array(df, "v", outer=True, pos=True).columns == ["id", "v_pos", "v"]
    assert explode_array(df, "v", outer=True, pos=False).count() == 3
    assert explode_array(df, "v", outer=False, pos=True).count() == 2
    maps = spark.sql("select 1 as id, map('a', 1) as m union all select 2, map()")
    assert explode_map(maps, "m", outer=False, pos=False).columns == ["id", "m_key", "m_value"]
    assert explode_map(maps, "m").count() == 2


def test_path_through_arrays(spark):
    df = _parse(spark, [{"a": {"b": [{"c": [{"v": 1}, {"v": 2}]}, {"c": []}]}, "z": [1, 2, 3]}])
    assert sorted(map(str, (r.c_v for r in flatten_path(df, "A.b.c").collect()))) == ["1", "2", "None"]
    with pytest.raises(ValueError):
        flatten_path(df, "a.nowhere")


CROSSWALK = {
    "attributes": ["entities/1/attributes/Name/n"],
    "createDate": "d", "type": "configuration/sources/S",
    "uri": "entities/1/crosswalks/c1", "value": "V1",
}


def test_crosswalk_tables_by_name(spark):
    twin = {**CROSSWALK, "createDate": "later"}
    bare = {**CROSSWALK, "attributes": [], "value": "V2", "uri": "entities/1/crosswalks/c2"}
    df = _parse(spark, [{"crosswalks": [CROSSWALK, twin, bare]}, {"crosswalks": []}])
    table = sorted(map(str, map(tuple, crosswalk_table(df).collect())))
    assert table == ["('V1', '1', 'S')", "('V2', '1', 'S')", "(None, None, None)"]
    assert crosswalk_table(df, keep_empty=False).count() == 2
    uris = crosswalk_uri_table(df, keep_empty=False)
    assert uris.columns == ["uri", "sourceid", "cross_value", "cross_source"]
    assert [tuple(r) for r in uris.distinct().collect()] == [
        ("entities/1/attributes/Name/n", "V1", "c1", "S")
    ]
    assert crosswalk_uri_table(df).count() == 4


def test_missing_crosswalks_give_empty_frames(spark):
    df = spark.range(1)
    assert crosswalk_table(df).isEmpty() and crosswalk_uri_table(df).isEmpty()
    assert crosswalk_table(df).columns == ["crosswalks_value", "EntityID", "cross_source"]
    plain = {k: v for k, v in CROSSWALK.items() if k != "attributes"}
    without = _parse(spark, [{"crosswalks": [plain]}])
    assert crosswalk_uri_table(without, keep_empty=False).isEmpty()
    assert crosswalk_uri_table(without).first().uri is None
