"""Uniformly random shards of exact sizes, by a communication matrix of hypergeometric draws.

Rows are dealt by hash to partitions, counted, and for each partition the numbers of its rows that go to
each shard are drawn exactly as a uniform shuffle would split them: a multivariate
hypergeometric distribution, partition by partition.  Each partition permutes its rows and cuts them
by its line of the matrix; after the exchange each shard's rows are permuted again.  Together that is a
uniform shuffle in which shard counts differ by one at most.

The second permutation works on cells of a shard with a table of their sizes, so no task holds a
whole shard.  The matrix has a line per partition and a column per shard; the number of partitions is a
parameter, or follows the row count.

Defined results: every row gets a place, rows with NULL in any column too.  Rows equal in all
columns are interchangeable.  Columns that have the name of a result column are replaced.  An empty
table gives an empty one.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylake.operators.linkage import even_join
from entitylake.sources.scratch import staged

ROWS_PER_PARTITION = 100_000
MIN_PARTITIONS = 32
MAX_PARTITIONS = 100_000
SEED = 90_001


def communication_matrix(
    sizes: list[int], shard_sizes: list[int], random: np.random.Generator
) -> np.ndarray:
    """Rows of each partition that go to each shard; margins are exact."""
    left = np.array(shard_sizes, np.int64)
    matrix = np.zeros((len(sizes), len(shard_sizes)), np.int64)
    for i, size in enumerate(sizes):
        matrix[i] = _draw(left, size, random)
        left -= matrix[i]
    return matrix


def _draw(colours: np.ndarray, size: int, random: np.random.Generator) -> np.ndarray:
    """One multivariate hypergeometric draw, as a chain of univariate ones."""
    out = np.zeros(len(colours), np.int64)
    rest = int(colours.sum())
    for i, number in enumerate(colours.tolist()):
        rest -= number
        if size and number:
            out[i] = _hypergeometric(number, rest, size, random)
            size -= int(out[i])
    return out


def _hypergeometric(good: int, bad: int, size: int, random: np.random.Generator) -> int:
    """numpy's generator takes populations up to 10^9."""
    if good + bad < 1_000_000_000:
        return int(random.hypergeometric(good, bad, size))
    return _hypergeometric_inverse(good, bad, size, random)


def _hypergeometric_inverse(good: int, bad: int, size: int, random: np.random.Generator) -> int:
    """Inversion outwards from the mode by the ratio of neighbouring probabilities."""
    low, high = max(0, size - bad), min(size, good)
    mode = min(high, max(low, (size + 1) * (good + 1) // (good + bad + 2)))
    log = (
        _log_choose(good, mode) + _log_choose(bad, size - mode) - _log_choose(good + bad, size)
    )
    up, down, place = math.exp(log), math.exp(log), random.random()
    place -= up
    above = below = mode
    while place > 0 and (above < high or below > low):
        if above < high:
            up *= (good - above) * (size - above) / ((above + 1) * (bad - size + above + 1))
            above += 1
            place -= up
            if place <= 0:
                return above
        if below > low:
            down *= below * (bad - size + below) / ((good - below + 1) * (size - below + 1))
            below -= 1
            place -= down
            if place <= 0:
                return below
    return mode


def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def shuffled_shards(
    rows: DataFrame, shards: int, partitions: int | None = None, seed: int = SEED,
    cells_per_shard: int | None = None,
) -> DataFrame:
    """All columns of ``rows`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    Starts jobs.  ``rows`` is staged with a number for each row: counts and draws must be of the same
    rows.  Both ranks are taken by numbers and draws alone; the rows move once, to their places.
    """
    rows = rows.drop("shard", "slot")
    numbered = staged(
        rows.select(
            F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"),
            F.monotonically_increasing_id().alias("_number"),
        ),
        "shard-rows",
    )
    spark = rows.sparkSession
    total = numbered.count()
    if partitions is None:
        partitions = min(MAX_PARTITIONS, max(MIN_PARTITIONS, math.ceil(total / ROWS_PER_PARTITION)))
    cells = cells_per_shard or max(1, math.ceil(total / shards / ROWS_PER_PARTITION * 4))
    keyed = staged(_keyed(numbered, partitions, seed, "_row"), "shard-keys")
    # rows equal in all columns have equal draws: a third of all rows may, so their number is mixed in
    copies = keyed.groupBy("_first", "_second").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    if copies.limit(1).count():
        keyed = staged(_keyed(numbered, partitions, seed, "_row", "_number"), "shard-keys")
    counts = dict(map(tuple, keyed.groupBy("_part").count().collect()))
    sizes = [counts.get(p, 0) for p in range(partitions)]
    wanted = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix(sizes, wanted, np.random.default_rng(seed))
    lines = spark.createDataFrame(
        [(p, line.tolist()) for p, line in enumerate(np.cumsum(matrix, 1)) if sizes[p]],
        "_part long, _ends array<long>",
    )
    local = keyed.withColumn(
        "_rank", F.expr("row_number() over (partition by _part order by _first, _second, _cell) - 1")
    )
    dealt = even_join(local, lines, ["_part"]).select(
        "_number",
        F.size(F.filter("_ends", lambda e: e <= F.col("_rank"))).alias("shard"),
        F.pmod("_cell", F.lit(cells)).alias("_at"), "_first", "_second",
    )
    dealt = staged(dealt, "dealt-shards")
    filled = dealt.groupBy("shard", "_at").agg(F.count(F.lit(1)).alias("_n"))
    before = filled.withColumn(
        "_before",
        F.expr(
            "coalesce(sum(_n) over (partition by shard order by _at"
            " rows between unbounded preceding and 1 preceding), 0)"
        ),
    ).drop("_n")
    ranked = dealt.withColumn(
        "_place",
        F.expr("row_number() over (partition by shard, _at order by _second, _first) - 1"),
    )
    places = even_join(ranked, before, ["shard", "_at"]).select(
        "_number", "shard", (F.col("_before") + F.col("_place")).alias("slot")
    )
    return even_join(numbered, places, ["_number"]).select("_row.*", "shard", "slot")


def _keyed(numbered: DataFrame, partitions: int, seed: int, *columns: str) -> DataFrame:
    """``_number`` of each row, its partition and its draws, which are hashes of ``columns``."""

    def draw(part: int):
        return F.xxhash64(F.lit(seed), F.lit(part), *columns)

    return numbered.select(
        "_number", F.pmod(draw(1), F.lit(partitions)).alias("_part"), draw(2).alias("_first"),
        draw(3).alias("_second"), draw(4).alias("_cell"),
    )
