"""A compact test for membership in a set of 64-bit hashes, for use before a shuffle.

The set is reduced on the executors to a bitmap of bounded size, in which each hash sets two bits.  The
bitmap becomes a constant of the plan, so that rows are tested where they are made, inside Spark's own
expressions.  A member is never refused; of the others a few pass, which an exact join has to remove.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 22  # 512 kB
BITS_PER_KEY = 8  # wanted: one in twenty others passes, or fewer
LEAST_BITS_PER_KEY = 4  # one in seven; with fewer the test is not worth its while


def _places(key: Column, bits: int) -> list[Column]:
    mask = F.lit(bits - 1).cast("long")
    return [key.bitwiseAND(mask), F.shiftrightunsigned(key, 32).bitwiseAND(mask)]


def membership(
    hashes: DataFrame, column: str, rows: int, max_bits: int = MAX_BITS
) -> Callable[[Column], Column] | None:
    """A test whether a hash may be in ``column``; ``None`` when the set is too large for a useful one.

    ``rows`` is the number of hashes, or more.  Starts a job; at most ``max_bits / 64`` numbers reach
    the driver.
    """
    if rows * LEAST_BITS_PER_KEY > max_bits:
        return None
    bits = 64
    while bits < min(rows * BITS_PER_KEY, max_bits):
        bits *= 2
    place = F.explode(F.array(*_places(F.col(column), bits))).alias("place")
    one = F.shiftleft(F.lit(1).cast("long"), 0)
    flagged = hashes.select(place).select(
        F.shiftright("place", 6).alias("word"),
        F.call_function("shiftleft", one, F.col("place").bitwiseAND(F.lit(63).cast("long")).cast("int"))
        .alias("bit"),
    )
    found = flagged.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow().to_pydict()
    words = dict(zip(found["word"], found["bits"]))
    listed = ",".join(str(words.get(i, 0)) for i in range(bits // 64))
    # a constant expression: evaluated once, when the plan is optimised
    bitmap = F.split(F.lit(listed), ",").cast("array<bigint>")

    def may_contain(key: Column) -> Column:
        first, second = _places(key, bits)

        def has(place: Column) -> Column:
            word = F.get(bitmap, F.shiftright(place, 6).cast("int"))
            return F.getbit(word, place.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1

        return has(first) & has(second)

    return may_contain
