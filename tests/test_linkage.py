import random
import re

import pytest
from oracle import actual
from pyspark.sql import functions as F

from entitylake.operators.linkage import (
    NeedleStats,
    choose_strategy,
    even_join,
    largest_value_per_uri,
    needle_stats,
    nested_entity_join,
    reference_id_join,
    semi_join_uri,
    substring_join,
    substring_links,
    substring_pairs,
    uri_join,
)


def _texts(spark, values, name):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{name} string, {name}_id int")


def _brute_force(needles, haystacks):
    return sorted(
        (n, i, h, j)
        for i, n in enumerate(needles) for j, h in enumerate(haystacks)
        if n is not None and h is not None and n in h
    )


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
@pytest.mark.parametrize("seed", range(3))
def test_substring_join_equals_brute_force(spark, strategy, seed):
    rng = random.Random(seed)

    def word(most):
        return "".join(rng.choice("abé😀") for _ in range(rng.randint(0, most)))

    needles = [word(4) for _ in range(25)] + [None, "", "ab", "ab"]
    haystacks = [word(12) for _ in range(60)] + [None, "", "ababab", "ababab"]
    haystacks += ["é" * 700 + "ab" + "b" * 700, "ab" * 600]
    got = substring_join(
        _texts(spark, needles, "n"), _texts(spark, haystacks, "h"), "n", "h", strategy
    )
    assert sorted(map(tuple, got.collect())) == _brute_force(needles, haystacks)


def test_long_needles_cross_piece_borders(spark):
    text = "".join(str(i) + "," for i in range(700))
    needles = [text[500:1200], text[100:105], text[1500:1530], "nowhere"]
    for strategy in ("broadcast", "shuffle"):
        pairs = substring_pairs(
            _texts(spark, [text], "h"), _texts(spark, needles, "n"), "h", "n", strategy
        )
        assert {r.gram for r in pairs.collect()} == set(needles[:3])


def test_strategy_follows_the_size_of_the_needles(spark):
    stats = needle_stats(_texts(spark, ["ab", "é", None, "", "ab"], "n"), "n")
    assert stats == NeedleStats(rows=4, bytes=6, lengths=(0, 1, 2))
    assert choose_strategy(stats) == "broadcast"
    assert choose_strategy(stats, limit=100) == "shuffle"
    nothing = needle_stats(_texts(spark, [None], "n"), "n")
    assert nothing == NeedleStats(0, 0, ())
    haystacks = _texts(spark, ["x"], "h")
    assert substring_join(_texts(spark, [None], "n"), haystacks, "n", "h").isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_links_are_one_bag_in_both_strategies(spark, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice("ab😀") for _ in range(rng.randint(0, 30))) for _ in range(40)]
    texts += ["ab-ab-ab", "ab-ab-ab", "", "ab" * 900, None]
    needles = ["ab", "ab", "", "a", "b😀a", None]
    brute = sorted((h, i, n) for i, h in enumerate(texts) if h is not None
                   for n in {n for n in needles if n is not None} if n in h)
    for strategy in ("broadcast", "shuffle"):
        got = substring_links(
            _texts(spark, texts, "h"), _texts(spark, needles, "n"), "h", "n", strategy
        )
        assert sorted(map(tuple, got.collect())) == brute


def test_too_many_needles_are_never_broadcast(spark):
    haystacks, needles = _texts(spark, ["abc"], "h"), _texts(spark, ["ab", "c"], "n")
    with pytest.raises(ValueError, match="too many"):
        substring_links(haystacks, needles, "h", "n", "broadcast", limit=100)
    found = substring_links(haystacks, needles, "h", "n", limit=100)
    assert {r.gram for r in found.collect()} == {"ab", "c"}


def test_same_column_on_both_sides_is_an_error(spark):
    df = _texts(spark, ["a"], "n")
    with pytest.raises(ValueError, match="both sides"):
        substring_join(df, df, "n", "n")


def _skewed(spark, rows):
    """A third of the rows share one key."""
    return spark.range(0, rows, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("string").alias("uri"),
        F.sha2(F.col("id").cast("string"), 256).alias("load"),
    )


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_hot_key_is_split(spark, conf, how):
    """Also when one side comes straight from an aggregation on the key."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.shuffle.partitions", "32")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "40KB")
    left = _skewed(spark, 60_000)
    right = left.groupBy("uri").agg(F.max("load").alias("largest"))
    joined = even_join(left, right, ["uri"], how)
    counted = joined.groupBy("load").count()
    assert counted.agg(F.sum("count")).first()[0] == 60_000
    counted.collect()
    assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    plain = left.join(right, "uri", how).groupBy("load").count()
    plain.collect()
    assert "skew=true" not in plain._jdf.queryExecution().executedPlan().toString()


def test_semi_join_keeps_multiplicity(spark):
    attributes = spark.createDataFrame([("u", "1"), ("u", "1"), ("v", "2"), (None, "3")], "uri string, value string")
    crosswalks = spark.createDataFrame([("u",), ("u",), (None,)], "uri string")
    assert [tuple(r) for r in semi_join_uri(attributes, crosswalks).collect()] == [("u", "1")] * 2


def test_uri_join_ignores_null_uris(spark):
    left = spark.createDataFrame([(None, "s"), ("u", "s")], "uri string, sourceid string")
    right = spark.createDataFrame([(None, "1"), ("u", "2")], "uri string, value string")
    assert [tuple(r) for r in uri_join(left, right).collect()] == [("u", "s", "2")]


def test_copies_collapse_to_their_largest_value(spark):
    rows = [("u", "1", "A"), ("u", "2", "A"), ("v", None, "A"), (None, "9", "A")]
    df = spark.createDataFrame(rows, "uri string, value string, joined_column string")
    assert actual(largest_value_per_uri(df))[1] == {
        ("'A'", "'u'", "'2'"): 1, ("'A'", "'v'", "None"): 1
    }


def test_reference_ids_fan_out_and_filter(spark):
    wide = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "EntityID string, Name string")
    ids = spark.createDataFrame(
        [("1", "x"), ("1", "y"), ("2", "z")], "EntityID string, value string"
    )
    out = reference_id_join(wide, ids, "Ref", ["Name", "EntityID", "Ref"], createdDate="t")
    assert out.columns == ["Name", "EntityID", "Ref", "createdDate"]
    assert sorted(map(tuple, out.collect())) == [
        ("a", "1", "x", "t"), ("a", "1", "y", "t"), ("b", "2", "z", "t")
    ]
    assert reference_id_join(wide, ids, "Ref", how="left").count() == 4
    with pytest.raises(ValueError, match="conform"):
        reference_id_join(wide, ids, "Ref", ["Name", "Ref"])


def test_nested_rows_get_the_unique_id(spark):
    single = spark.createDataFrame(
        [("1", "c", "U1", "S"), ("1", "c", "U2", "S")],
        "EntityID string, cross_value string, UniqueId string, cross_source string",
    )
    nested = spark.createDataFrame(
        [("1", "c", "S", "a1", "Rome"), ("1", "d", "S", "a1", "Oslo")],
        "EntityID string, cross_value string, cross_source string, cross_uri string, City string",
    )
    out = nested_entity_join(single, nested, ["City"])
    assert out.columns == ["UniqueId", "cross_source", "City"]
    assert sorted(map(tuple, out.collect())) == [("U1", "S", "Rome"), ("U2", "S", "Rome")]


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
@pytest.mark.parametrize("crowded", [False, True])
def test_identifiers_are_found_by_their_shape(spark, strategy, crowded):
    """Rows are shuffled with the few substrings of a needle's shape; crowded texts have too many of them."""
    rng = random.Random(4)
    needles = [f"A-{rng.randint(0, 99):02}" for _ in range(30)] + ["11", "12", "11", None, "a.b", "(0)"]
    texts = [f"xA-{rng.randint(0, 99):02}|A-{i % 100:02}" for i in range(60)]
    texts += ["111", "A-1é", "aXb", "a.b(0)", "\U0001F600A-11", None, ""]
    if crowded:
        texts += ["1" + "12" * 900] * 2
    stats = needle_stats(_texts(spark, needles, "n"), "n")
    assert len(stats.shapes) == 4 and "A\\-[0-9][0-9]" in stats.shapes
    got = substring_join(_texts(spark, needles, "n"), _texts(spark, texts, "h"), "n", "h", strategy)
    planned = got._jdf.queryExecution().executedPlan().toString()
    # without the joins that carry hashes to texts and back
    assert crowded or len(re.findall(r"\bSortMergeJoin\b", planned)) <= (1 if strategy == "shuffle" else 2)
    assert sorted(map(tuple, got.collect())) == _brute_force(needles, texts)
    links = substring_links(_texts(spark, texts, "h"), _texts(spark, needles, "n"), "h", "n", strategy)
    brute = {(h, j, n) for n, _, h, j in _brute_force(needles, texts)}
    assert sorted(map(tuple, links.collect())) == sorted(brute)


def test_letters_of_identifiers_are_a_class_where_they_vary(spark):
    varied = [f"{a}{b}-7" for a in "abcdef" for b in "ABCDEF"]
    assert needle_stats(_texts(spark, varied, "n"), "n").shapes == ("[a-z][A-Z]\\-[0-9]",)
    assert needle_stats(_texts(spark, ["é1"], "n"), "n").shapes is None
    assert needle_stats(_texts(spark, ["x" * i for i in range(40)], "n"), "n").shapes is None
