"""Links between passages and long texts, and the test for membership before a shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from entitylake.functions.membership import membership
from entitylake.operators import linkage, prose


def _texts(rng, count, words):
    vocabulary = ["the", "of", "a", "rare", *[f"w{i}" for i in range(40)]]
    gaps = [" ", " ", " ", "  ", "\n", "\t"]
    out = []
    for _ in range(count):
        out.append("".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.randint(0, words))))
    return out


@pytest.mark.parametrize("run", [1, 3])
def test_links_equal_containment(spark, run):
    rng = random.Random(run)
    texts = [*_texts(rng, 60, 80), None, "", "one", "the of a rare"]
    passages = ["", None, "of a", " the ", "absent words that nobody has", "w1", "the"]
    for text in rng.sample([t for t in texts if t and len(t) > 60], 30):
        start = rng.randint(0, 30)
        passages.append(text[start : start + rng.randint(1, len(text))])
    passages += passages[-3:]  # repeated needles
    haystacks = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[0]])], "id int, text string")
    needles = spark.createDataFrame(list(enumerate(passages)), "number int, passage string").repartition(3)
    found = prose.prose_join(needles, haystacks, "passage", "text", run).select("number", "id").collect()
    want = sorted(
        (n, i) for n, p in enumerate(passages) for i, t in enumerate([*texts, texts[0]])
        if p is not None and t is not None and p in t
    )
    assert sorted((r.number, r.id) for r in found) == want and len(want) > 40


def test_no_needles_and_no_texts(spark):
    texts = spark.createDataFrame([("some words in a text",)], "text string")
    needles = spark.createDataFrame([], "passage string")
    assert prose.prose_join(needles, texts, "passage", "text").count() == 0
    wanted = spark.createDataFrame([("words in a text",), ("some words in a text",)], "passage string")
    assert prose.prose_join(wanted, texts.limit(0), "passage", "text").count() == 0
    assert prose.prose_join(wanted, texts, "passage", "text").count() == 2
    with pytest.raises(ValueError, match="both sides"):
        prose.prose_join(texts, texts, "text", "text")


def test_a_passage_that_a_third_of_the_texts_share(spark):
    rows = spark.range(600).select(
        "id", F.when(F.col("id") % 3 == 0, F.concat(F.lit("before a well known passage of words after "), "id"))
        .otherwise(F.concat(F.lit("nothing of the kind "), "id")).alias("text"),
    )
    needles = spark.createDataFrame([("well known passage of words",)], "passage string")
    assert prose.prose_join(needles, rows, "passage", "text").count() == 200


def test_members_are_never_refused_and_most_others_are(spark):
    keys = spark.range(5_000).select(F.xxhash64("id").alias("h"))
    test = membership(keys, "h", 5_000)
    others = spark.range(5_000, 45_000).select(F.xxhash64("id").alias("h"))
    assert keys.where(test(F.col("h"))).count() == 5_000
    assert others.where(test(F.col("h"))).count() < 4_000
    assert keys.where(membership(keys.limit(0), "h", 0)(F.col("h"))).count() == 0
    assert membership(keys, "h", 5_000, max_bits=1 << 14) is None


def test_links_are_the_same_without_the_needle_filter(spark, monkeypatch):
    rng = random.Random(5)
    texts = [f"{rng.randint(0, 99)}|K{rng.randint(0, 99):03}|é{rng.randint(0, 9)}" for _ in range(300)] + ["", None]
    ids = [f"K{i:03}" for i in range(0, 99, 2)] + ["", None, "é1", "7|K"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    needles = spark.createDataFrame([(i,) for i in ids], "needle string")

    monkeypatch.setattr(linkage, "FILTER_FROM", 0)

    def links():
        found = linkage.substring_join(needles, rows, "needle", "text", strategy="shuffle")
        return sorted(tuple(r) for r in found.collect())

    with_filter = links()
    monkeypatch.setattr(linkage, "membership", lambda *_: None)
    assert links() == with_filter == sorted(
        (i, t) for i in ids for t in texts if i is not None and t is not None and i in t
    )
