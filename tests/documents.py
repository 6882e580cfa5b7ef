"""Random entity documents and the plain, row-multiplying way to process them.

The plain way (flatten everything, join by containment, one branch per attribute, pivot) is what the
library's single-pass plans must equal.  It is for small test input only.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import functions as F

from entitylake.operators.crosswalk import crosswalk_table
from entitylake.operators.nested import flatten_wide

LEAF = "array<struct<ov: boolean, value: string>>"
ADDRESS = (
    "struct<ov: boolean, refRelation: struct<crosswalks: array<struct<value: string>>>, "
    f"value: struct<City: {LEAF}, Country: {LEAF}, Rank: array<struct<value: string>>, "
    f"Zip: array<struct<value: struct<Zip4: {LEAF}, Zip5: {LEAF}>>>>>"
)
CROSSWALK = "struct<attributes: array<string>, type: string, uri: string, value: string>"
DDL = f"uri string, attributes struct<Address: array<{ADDRESS}>>, crosswalks array<{CROSSWALK}>"
CITY, COUNTRY, RANK = (f"attributes.Address.value.{n}" for n in ("City", "Country", "Rank"))
ZIP4, ZIP5 = (f"attributes.Address.value.Zip.value.{n}" for n in ("Zip4", "Zip5"))


def random_documents(spark, seed: int, count: int = 60):
    rng = random.Random(seed)
    ids = ["A1", "A12", "B7", "7", "", "é9", "long-identifier-0001"]

    def some(make, most=3):
        pick = rng.random()
        return None if pick < 0.1 else [make() for _ in range(rng.randint(0, most))]

    def leaf():
        return (rng.choice([True, True, False, None]), rng.choice(["9", "10", "x", None, "y"]))

    def text():
        parts = [rng.choice(ids) for _ in range(rng.randint(0, 3))]
        return (None if rng.random() < 0.1 else "|".join(parts),)

    def zips():
        return ((some(leaf, 2), some(leaf, 2)),)

    def address():
        value = (some(leaf), some(leaf), some(lambda: leaf()[1:], 1), some(zips, 2))
        return (rng.choice([True, True, False, None]), (some(text, 2),), value)

    def crosswalk(entity):
        return (
            [f"entities/{entity}/attributes/Name/1"], f"configuration/sources/S{rng.randint(1, 2)}",
            f"entities/{entity}/crosswalks/{rng.randint(1, 5)}", rng.choice([*ids, None]),
        )

    rows = [
        (f"entities/{e}", (some(address),), some(lambda e=e: crosswalk(e))) for e in range(count)
    ]
    return spark.createDataFrame(rows, DDL)


def _flattened(docs):
    flat = flatten_wide(docs.select("attributes.Address")).na.drop("all").distinct()
    pairs = crosswalk_table(docs).join(
        flat, flat.Address_refRelation_crosswalks_value.contains(F.col("crosswalks_value"))
    )
    return pairs.where("Address_ov")


def plain_melt_address(docs, paths):
    pairs, branches = _flattened(docs), []
    for path in paths:
        parts = path.split(".")
        column = "_".join(parts[1:])
        if f"{column}_value" not in pairs.columns:
            continue
        kept = pairs.where(f"{column}_ov") if f"{column}_ov" in pairs.columns else pairs
        name = parts[3] if len(parts) == 4 else f"{parts[3]}_{parts[5]}"
        branches.append(
            kept.select(
                "crosswalks_value", "EntityID", "cross_source",
                F.col(f"{column}_value").alias("value"), F.lit(name).alias("joined_column"),
            )
        )
    return reduce(lambda a, b: a.union(b), branches)


def plain_address_wide(docs, paths, names):
    rows = plain_melt_address(docs, paths)
    return rows.groupBy("crosswalks_value", "EntityID", "cross_source").agg(
        *[F.max(F.when(F.col("joined_column") == n, F.col("value"))).alias(n) for n in names]
    )

