"""Order MinHash: document fingerprints that feel edits and moved passages, in DataFrame functions.

A text's k-mers are its runs of ``words`` consecutive words; equal ones are numbered by occurrence.
A hash of k-mer and number deals them to ``components`` buckets and orders them within each, so every
component of the signature has a random order of its own at the price of one hash.  From each bucket
the ``picked`` smallest are selected, put back into the order in which they stand in the text, and
hashed as a tuple.  Two texts agree in a component if they share its selected k-mers *and* their
order; the share of agreeing components falls with the edit distance of the texts.

Texts are read whole.  Words are runs of anything but white space.  Defined results: a text with fewer
words than a k-mer has one k-mer, all its words; a missing text is an empty one; a text without words
has only empty buckets, is like another such text (1) and unlike any other (0).  Equal texts, and texts
that differ in white space only, have equal fingerprints.  A bucket that is empty in both texts does
not count.  Nothing is collected: a text's k-mers stay in its row, as arrays of 64-bit numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

WORDS = 3
COMPONENTS = 64
PICKED = 2
RANGE_ROWS = 32_768
MAX_RANGES = 1 << 18

_ORDER = "known boolean, key long, hash long"
_PLACE = 30  # low bits of a packed number: the position; a hash of 34 bits stands above


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _packed(hashed: Column, place: Column) -> Column:
    return F.shiftleft(hashed, _PLACE).bitwiseOR(place.cast("long"))


def _hash(packed: Column) -> Column:
    return F.shiftright(packed, _PLACE)


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << _PLACE) - 1).cast("long"))


def _up_to(size: Column) -> Column:
    """The numbers from 0 to below ``size``, which is at least 1."""
    return F.sequence(F.lit(0), size - 1)


def _starts(packed: Column, group: Callable[[Column], Column]) -> Column:
    """Where a new group begins in a sorted array; one index past the end closes the list."""
    size = F.size(packed)
    first = F.filter(
        _up_to(size),
        lambda i: ~group(F.get(packed, i)).eqNullSafe(group(F.get(packed, i - 1))),
    )
    return F.concat(first, F.array(size))


def _numbered(packed: Column) -> Column:
    """Sorted k-mers, each hashed again with the number of equal ones before it."""

    def by_start(starts: Column) -> Column:
        groups = F.size(starts) - 1

        def member(start: Column, i: Column) -> Column:
            kmer = F.get(packed, i)
            return _packed(F.xxhash64(_hash(kmer), i - start), _place(kmer))

        firsts = F.transform(F.slice(starts, 1, groups), lambda s: member(s, s))
        repeated = F.filter(
            _up_to(groups), lambda g: F.get(starts, g + 1) - F.get(starts, g) > 1
        )
        others = F.transform(
            repeated,
            lambda g: F.transform(
                F.sequence(F.get(starts, g) + 1, F.get(starts, g + 1) - 1),
                lambda i: member(F.get(starts, g), i),
            ),
        )
        return F.concat(firsts, F.flatten(others))

    return _let(_starts(packed, _hash), by_start)


def fingerprint(
    text: Column, words: int = WORDS, components: int = COMPONENTS, picked: int = PICKED
) -> Column:
    """The signature of a text: an array of ``components`` numbers, 0 for an empty bucket.

    ``components`` is a power of two, 1,024 at most.
    """
    bits = components.bit_length() - 1
    if components != 1 << bits or not 1 <= bits <= 10:
        raise ValueError("components must be a power of two from 2 to 1024")
    if words < 1 or picked < 1:
        raise ValueError("words and picked must be positive")

    def bucket(packed: Column) -> Column:
        return F.shiftrightunsigned(packed, 64 - bits)

    def kmers(hashes: Column) -> Column:
        return F.transform(
            _up_to(F.greatest(F.size(hashes) - (words - 1), F.lit(1))),
            lambda i: _packed(F.xxhash64(*[F.get(hashes, i + n) for n in range(words)]), i),
        )

    def component(ordered: Column, start: Column, end: Column) -> Column:
        chosen = F.slice(ordered, start + 1, F.least(end - start, F.lit(picked)))
        in_text = F.sort_array(F.transform(chosen, lambda x: F.struct(_place(x), _hash(x))))
        tuple_hash = F.xxhash64(F.transform(in_text, lambda x: x["col2"]))
        return F.greatest(tuple_hash.bitwiseAND(F.lit(0x7FFFFFFF).cast("long")), F.lit(1)).cast("int")

    def signature(ordered: Column, starts: Column) -> Column:
        found = F.transform(
            F.slice(starts, 1, F.size(starts) - 1),
            lambda s, g: F.struct(
                bucket(F.get(ordered, s)).alias("bucket"),
                component(ordered, s, F.get(starts, g + 1)).alias("value"),
            ),
        )
        at = F.sequence(F.lit(0).cast("long"), F.lit(components - 1).cast("long"))

        def spread(buckets: Column, values: Column) -> Column:
            place = lambda b: F.array_position(buckets, b).cast("int") - 1
            return F.transform(at, lambda b: F.coalesce(F.get(values, place(b)), F.lit(0)))

        return _let(
            found, lambda p: _let(p["bucket"], lambda b: _let(p["value"], lambda v: spread(b, v)))
        )

    def of_words(found: Column) -> Column:
        hashes = F.transform(found, lambda w: F.xxhash64(w))
        ordered = _let(hashes, lambda h: F.sort_array(kmers(h)))
        ordered = _let(ordered, lambda p: F.sort_array(_numbered(p)))
        whole = _let(ordered, lambda o: _let(_starts(o, bucket), lambda s: signature(o, s)))
        nothing = F.array_repeat(F.lit(0), components)
        return F.when(F.size(found) > 0, whole).otherwise(nothing)

    return _let(_words(text), of_words)


def _words(text: Column) -> Column:
    split = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.array_remove(split, "")  # before leading and after trailing white space


def likeness(first: Column, second: Column) -> Column:
    """The share of components, not empty in both, in which two fingerprints agree; 1 if all are."""

    def share(pairs: Column) -> Column:
        used = F.size(F.filter(pairs, lambda p: (p["a"] != 0) | (p["b"] != 0)))
        same = F.size(F.filter(pairs, lambda p: (p["a"] == p["b"]) & (p["a"] != 0)))
        return F.when(used == 0, F.lit(1.0)).otherwise(same / used)

    both = F.zip_with(first, second, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return _let(both, share)


def as_hex(signature: Column) -> Column:
    """A fingerprint as text: eight hexadecimal digits a component."""
    return F.lower(F.concat_ws("", F.transform(signature, lambda x: F.lpad(F.hex(x), 8, "0"))))


def fingerprints(documents: DataFrame, text: str = "text", **parameters: int) -> DataFrame:
    """All columns of ``documents`` and ``fingerprint``, in place of any column of that name."""
    return documents.withColumn("fingerprint", fingerprint(F.col(text), **parameters))


def with_following(documents: DataFrame, key: str, text: str, **parameters: int) -> DataFrame:
    """``key``, ``text``, ``fingerprint`` of every row and ``next_text``, ``next_fingerprint`` of the
    row that follows it by ascending ``key``, an integer; after the last comes the first.

    Rows with equal keys follow one another by a hash of their texts; rows without a key come first.
    Ranges of key and hash hold some 32,768 rows each.  Their bounds come from keys and hashes alone, so
    texts are shuffled once, to their range, where each row sees the next; a range's first row is sent to
    the range before it as well.  Of rows equal in key and text that exceed a range by themselves one is
    sent, with their number.  Starts two jobs; the driver gets the bounds, 262,144 at most.
    """
    rows = documents.select(
        F.col(key).cast("long").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text")
    ).withColumn("_hash", F.xxhash64("_text"))
    total = documents.count()
    parallel = 2 * documents.sparkSession.sparkContext.defaultParallelism
    wanted = max(parallel, min(total // RANGE_ROWS, MAX_RANGES))
    bounds, heavy = _ranges(rows, wanted, max(total // wanted, RANGE_ROWS))
    rows = _folded(rows, heavy).withColumn("_print", fingerprint(F.col("_text"), **parameters))
    placed = _in_ranges(rows.withColumn("_order", _order()), bounds)
    window = Window.partitionBy("_range").orderBy("_guest", "_order")
    follower = F.struct(F.col("_text").alias("text"), F.col("_print").alias("print"))
    linked = placed.withColumn("_after", F.lead(follower).over(window)).where("not _guest")
    if heavy:  # all copies but the last are followed by their like
        numbered = linked.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        same = F.col("_copy") < F.col("_copies")
        linked = numbered.withColumn("_after", F.when(same, follower).otherwise(F.col("_after")))
    return linked.select(
        F.col("_key").alias(key), F.col("_text").alias(text), F.col("_print").alias("fingerprint"),
        F.col("_after.text").alias("next_text"), F.col("_after.print").alias("next_fingerprint"),
    )


def _order() -> Column:
    """What rows are ordered by, without missing parts: they compare alike everywhere."""
    known = F.col("_key").isNotNull()
    return F.struct(
        known.alias("known"), F.coalesce("_key", F.lit(0)).alias("key"), F.col("_hash").alias("hash")
    )


def _ranges(rows: DataFrame, wanted: int, most: int) -> tuple[list[Row], list[Row]]:
    """The first key and hash of every range, and those that more than ``most`` rows share."""
    counted = rows.groupBy("_key", "_hash").agg(F.count(F.lit(1)).alias("copies"))
    dealt = counted.withColumn("order", _order()).repartitionByRange(wanted, "order")
    found = (
        dealt.withColumn("part", F.spark_partition_id())
        .groupBy("part")
        .agg(
            F.min("order").alias("first"),
            F.collect_list(F.when(F.col("copies") > most, F.col("order"))).alias("heavy"),
        )
        .collect()
    )
    return sorted(r["first"] for r in found), [pair for r in found for pair in r["heavy"]]


def _folded(rows: DataFrame, heavy: list[Row]) -> DataFrame:
    """One row, with the number of ``_copies``, for the rows of each heavy key and hash."""
    single = F.lit(1).cast("long").alias("_copies")
    if not heavy:
        return rows.select("*", single)
    listed = rows.sparkSession.createDataFrame([tuple(r) for r in heavy], _ORDER)
    listed = F.broadcast(listed.select(F.struct("known", "key", "hash").alias("_order")))
    ordered = rows.withColumn("_order", _order())
    folded = (
        ordered.join(listed, "_order", "left_semi")
        .groupBy("_key", "_hash")
        .agg(F.first("_text").alias("_text"), F.count(F.lit(1)).alias("_copies"))
    )
    others = ordered.join(listed, "_order", "left_anti").drop("_order").select("*", single)
    return others.unionByName(folded)


def _in_ranges(rows: DataFrame, bounds: list[Row]) -> DataFrame:
    """Rows with the number of their ``_range``: the last bound that is not above them, found among a
    range's neighbours once these have been found among all.  A range's first key and hash come again,
    as ``_guest``, at the end of the range before."""
    if not bounds:
        return rows.select("*", F.lit(0).alias("_range"), F.lit(False).alias("_guest"))
    step = math.isqrt(len(bounds) - 1) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    names = ("known", "key", "hash")
    heads = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, g[0])]) for g in groups])
    listed = [(i, [tuple(b) for b in g]) for i, g in enumerate(groups)]
    listed = rows.sparkSession.createDataFrame(listed, f"_group int, _bounds array<struct<{_ORDER}>>")

    def last_below(among: str | Column) -> Column:
        return F.size(F.filter(among, lambda b: b <= F.col("_order"))) - 1

    known = rows.withColumn("_group", last_below(heads)).join(F.broadcast(listed), "_group")
    at = known.withColumn("_at", last_below("_bounds"))
    number = (F.col("_group") * step + F.col("_at")).cast("int")
    first = F.get("_bounds", F.col("_at")) == F.col("_order")
    before = F.pmod(number - 1, F.lit(len(bounds)))
    here = F.struct(number.alias("_range"), F.lit(False).alias("_guest"))
    there = F.struct(before.alias("_range"), F.lit(True).alias("_guest"))
    places = F.explode(F.when(first, F.array(here, there)).otherwise(F.array(here)))
    dealt = at.select(*rows.columns, places.alias("_place"))
    return dealt.select(*rows.columns, "_place._range", "_place._guest")
