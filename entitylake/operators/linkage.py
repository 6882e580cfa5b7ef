"""Links between attributes, entities and source-system records.

A key may be hot: one URI, entity or identifier can carry a large share of all rows.  Two habits
keep that harmless.  Sides that only feed a maximum are reduced to one row per key first, with
partial aggregation before the shuffle; and joins go through :func:`even_join`, whose inputs are
plain shuffles, so that adaptive execution can cut a skewed partition into several tasks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from string import ascii_lowercase, ascii_uppercase, digits

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.functions.membership import membership
from entitylake.functions.paths import require_unique
from entitylake.operators.columns import conform_columns, stamp_columns
from entitylake.sources.scratch import staged

BROADCAST_LIMIT = 64 * 1024 * 1024
FILTER_FROM = 8 * 1024 * 1024  # fewer bytes of needles are not worth a filter
PIECE = 512  # positions per piece of a long haystack
ROW_OVERHEAD = 64  # assumed bytes per row of a broadcast hash table, beside the text itself
SHAPES = 16  # needles of more different shapes are not looked for by shape
SHAPED = 256  # nor are longer ones
FEW = 4  # substrings of a needle's shape per text, on average, that may be shuffled with their rows


def even_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join whose skewed partitions adaptive execution can split.

    Spark splits a skewed partition only when both inputs of the join are plain shuffles.  An input
    that was just aggregated on the join key would be used as it is, without a shuffle of its own.
    Joining on the key and its hash makes Spark shuffle both inputs for the join.
    """
    marker = "_key_hash"
    hashed = F.hash(*[F.col(f"`{c}`") for c in on])
    joined = left.withColumn(marker, hashed).join(
        right.withColumn(marker, hashed), [*on, marker], how
    )
    return joined.drop(marker)


# --- URI links ---------------------------------------------------------------------------------


def uri_join(crosswalks: DataFrame, attributes: DataFrame) -> DataFrame:
    """Attribute rows with every crosswalk that lists their URI (inner, duplicates kept)."""
    return even_join(crosswalks, attributes, ["uri"])


def semi_join_uri(attributes: DataFrame, crosswalks: DataFrame) -> DataFrame:
    """Attribute rows whose URI some crosswalk lists."""
    listed = crosswalks.select("uri").where(F.col("uri").isNotNull()).distinct()
    return even_join(attributes, listed, ["uri"], "left_semi")


def largest_value_per_uri(attributes: DataFrame) -> DataFrame:
    """One row per distinct attribute row without its value, with the largest value.

    Before a maximum pivot this changes nothing but the volume: copies of a document no longer meet
    all the copies of its crosswalks in the URI join.
    """
    keys = [c for c in attributes.columns if c != "value"]
    # a small file of documents is read by one task, which would hold all its attributes in a partial maximum
    spread = attributes.where(F.col("uri").isNotNull()).hint("rebalance", "uri", "value")
    return spread.groupBy(*keys).agg(F.max("value").alias("value"))


def reference_id_join(
    entities: DataFrame,
    ids: DataFrame,
    name: str = "ReferenceId",
    columns: Sequence[str] | None = None,
    how: str = "inner",
    **stamps: str,
) -> DataFrame:
    """Wide entity rows with their surviving reference ids.

    An entity with several ids gives several rows; one without any is left out unless ``how`` is
    ``left``.  ``columns`` is the declared output list, checked strictly.
    """
    values = ids.select("EntityID", F.col("value").alias(name))
    joined = even_join(entities.drop(name), values, ["EntityID"], how)
    if columns is not None:
        joined = conform_columns(joined, columns)
    return stamp_columns(joined, **stamps) if stamps else joined


def nested_entity_join(
    entities: DataFrame,
    nested: DataFrame,
    names: Sequence[str],
    unique_id: str = "UniqueId",
    **stamps: str,
) -> DataFrame:
    """Nested wide rows with the unique id of their entity; the join keys are left out."""
    keys = ["EntityID", "cross_value"]
    owners = entities.select(*keys, unique_id)
    columns = require_unique([unique_id, "cross_source", *names], "output columns")
    rows = even_join(nested.drop("cross_uri"), owners, keys).drop(*keys)
    rows = conform_columns(rows, columns)
    return stamp_columns(rows, **stamps) if stamps else rows


# --- substring links ---------------------------------------------------------------------------


@dataclass(frozen=True)
class NeedleStats:
    """What the choice of a strategy needs to know; three numbers and a set of small integers."""

    rows: int
    bytes: int
    lengths: tuple[int, ...]
    #: patterns, one of which every needle matches as a whole; ``None`` where a few are not enough
    shapes: tuple[str, ...] | None = field(default=None, compare=False)

    @property
    def broadcast_size(self) -> int:
        return self.bytes + ROW_OVERHEAD * self.rows


def _shaped_alike(text: Column) -> list[tuple[Column, dict[str, str]]]:
    """Shapes of a text, the closest first, and the classes that characters of a shape stand for."""
    numbers = F.translate(text, digits, "0" * 10)
    letters = F.translate(numbers, ascii_lowercase + ascii_uppercase, "a" * 26 + "A" * 26)
    classes = {"0": "[0-9]"}
    return [(numbers, classes), (letters, classes | {"a": "[a-z]", "A": "[A-Z]"})]


def needle_stats(needles: DataFrame, column: str) -> NeedleStats:
    """Row count, text size, distinct lengths and shapes, in aggregations without a wide shuffle.

    Identifiers have a few shapes however many they are: ``ORD-`` and eight digits.  Shapes are estimated
    first, and only a few are collected.
    """
    text = F.col(column)
    known = needles.where(text.isNotNull())
    alike = _shaped_alike(text)
    row = known.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes"),
        F.collect_set(F.length(text)).alias("lengths"),
        *[F.approx_count_distinct(shape).alias(f"shapes{i}") for i, (shape, _) in enumerate(alike)],
    ).first()
    lengths = tuple(sorted(row["lengths"]))
    shapes = None
    for i, (shape, classes) in enumerate(alike):
        if lengths and lengths[-1] <= SHAPED and row[f"shapes{i}"] <= 2 * SHAPES:
            found = [r[0] for r in known.select(shape).distinct().limit(SHAPES + 1).collect()]
            # other texts than ASCII could be cut differently as Java strings than as bytes
            if len(found) <= SHAPES and all(f.isascii() for f in found):
                shapes = tuple(sorted("".join(classes.get(c) or re.escape(c) for c in f) for f in found))
                break
    return NeedleStats(row["rows"], row["bytes"], lengths, shapes)


def _shaped_grams(haystack: str, shapes: Sequence[str]) -> Column:
    """The distinct substrings of a text that match one of ``shapes``, overlapping ones too."""
    found = [F.regexp_extract_all(haystack, F.lit(f"(?=({s}))"), F.lit(1)) for s in shapes]
    return F.array_distinct(F.concat(*found))


def _with_shaped_grams(rows: DataFrame, haystack: str, shapes: Sequence[str]) -> DataFrame:
    return rows.withColumn("gram", F.explode(_shaped_grams(haystack, shapes)))


def _few_shaped(rows: DataFrame, haystack: str, stats: NeedleStats) -> bool:
    """Whether so few substrings have the shape of a needle that rows may be shuffled once for each.
    Starts a job, which reads the texts alone."""
    if stats.shapes is None:
        return False
    texts = rows.where(F.col(haystack).isNotNull())
    found = texts.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.size(_shaped_grams(haystack, stats.shapes))).alias("grams")
    ).first()
    return (found["grams"] or 0) <= FEW * found["rows"]


def _placed_grams(rows: DataFrame, haystack: str, lengths: Iterable[int]) -> DataFrame:
    """A row per length and position: the substring as ``gram``, its position as ``_at``."""
    sizes = sorted(set(lengths))
    text, size = F.col(haystack), F.col("_size")
    if not sizes:
        nothing = rows.withColumns(
            {"gram": F.lit(None).cast("string"), "_at": F.lit(None).cast("int")}
        )
        return nothing.where(F.lit(False))
    fitting = F.filter(F.array(*[F.lit(n) for n in sizes]), lambda n: n <= F.length(text))
    sized = rows.where(text.isNotNull()).withColumn("_size", F.explode(fitting))
    starts = F.sequence(F.lit(1), F.length(text) - size + 1, F.lit(PIECE))
    cut = sized.withColumn("_from", F.explode(starts)).withColumn(
        "_piece", F.substring(text, F.col("_from"), size + (PIECE - 1))
    )
    last = F.greatest(F.length("_piece") - size + 1, F.lit(1))
    placed = cut.withColumn("_start", F.explode(F.sequence(F.lit(1), last)))
    return placed.withColumns(
        {
            "gram": F.substring("_piece", F.col("_start"), size),
            "_at": F.col("_from") + F.col("_start") - 1,
        }
    ).drop("_size", "_from", "_piece", "_start")


def with_grams(
    rows: DataFrame, haystack: str, lengths: Iterable[int], gram: str = "gram"
) -> DataFrame:
    """A row per position of ``haystack`` and per length: the substring of that length found there.

    A position in a string is found by counting characters from its start.  Long texts are therefore
    cut into overlapping pieces first, so that the count starts near the substring.  Lengths, pieces
    and positions are generated one after another: no row holds more than one text.
    """
    return _placed_grams(rows, haystack, lengths).drop("_at").withColumnRenamed("gram", gram)


def _needle_filter(known: DataFrame, stats: NeedleStats) -> Callable[[Column], Column] | None:
    """A test of substrings before they are shuffled; none where Spark will broadcast the needles."""
    if stats.broadcast_size < FILTER_FROM:
        return None
    hashes = known.select(F.xxhash64("gram").alias("_gram_hash"))
    return membership(hashes, "_gram_hash", stats.rows)


def _needle_set(needles: DataFrame, needle: str) -> DataFrame:
    return needles.select(F.col(needle).alias("gram")).where(F.col("gram").isNotNull()).distinct()


def choose_strategy(stats: NeedleStats, limit: int = BROADCAST_LIMIT) -> str:
    return "broadcast" if stats.broadcast_size <= limit else "shuffle"


def _strategy(strategy: str, stats: NeedleStats, limit: int) -> str:
    """The strategy to use; needles above ``limit`` or ``BROADCAST_LIMIT`` are never broadcast."""
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"strategy must be 'auto', 'broadcast' or 'shuffle', not '{strategy}'")
    fitting = choose_strategy(stats, min(limit, BROADCAST_LIMIT))
    if strategy == "broadcast" and fitting != "broadcast":
        raise ValueError(f"needles of {stats.broadcast_size} bytes are too many to broadcast")
    return fitting if strategy == "auto" else strategy


def _broadcast_links(
    rows: DataFrame, needles: DataFrame, haystack: str, needle: str, stats: NeedleStats
) -> DataFrame:
    """Rows with each needle they contain: a needle counts where it stands first in the text."""
    known = F.broadcast(_needle_set(needles, needle))
    if stats.shapes is not None:
        hits = _with_shaped_grams(rows, haystack, stats.shapes).join(known, "gram", "left_semi")
        return hits.select(*rows.columns, "gram")
    hits = _placed_grams(rows, haystack, stats.lengths).join(known, "gram", "left_semi")
    first = F.instr(F.col(haystack), F.col("gram")) == F.col("_at")
    return hits.where(first).select(*rows.columns, "gram")


def _shuffled_links(
    rows: DataFrame, needles: DataFrame, haystack: str, needle: str, stats: NeedleStats
) -> DataFrame:
    """Rows with each needle they contain, for any number of needles.

    Substrings and texts go through the matching shuffle as 64-bit hashes, and only those that pass the
    needle filter; texts and needles follow for the hits alone, and ``contains`` confirms them.  ``rows``
    is read twice: pass a written table.
    """
    known = _needle_set(needles, needle)
    keep = _needle_filter(known, stats)
    known = known.withColumn("_gram_hash", F.xxhash64("gram"))
    hashed = rows.withColumn("_text_hash", F.xxhash64(haystack))
    grams = _placed_grams(hashed.select("_text_hash", haystack), haystack, stats.lengths)
    ids = grams.select("_text_hash", F.xxhash64("gram").alias("_gram_hash"))
    if keep is not None:
        ids = ids.where(keep(F.col("_gram_hash")))
    hits = even_join(ids, known, ["_gram_hash"]).select("_text_hash", "gram").distinct()
    candidates = even_join(hashed, hits, ["_text_hash"])
    found = candidates.where(F.col(haystack).contains(F.col("gram")))
    return found.select(*rows.columns, "gram")


def _distinct_texts(haystacks: DataFrame, haystack: str) -> DataFrame:
    return haystacks.select(haystack).where(F.col(haystack).isNotNull()).distinct()


def substring_pairs(
    haystacks: DataFrame,
    needles: DataFrame,
    haystack: str,
    needle: str,
    strategy: str = "auto",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Distinct ``(haystack, gram)`` where ``gram`` is a needle that ``haystack`` contains.

    Exact: a needle is contained iff it equals a substring of its own length, so the containment
    test becomes an equality join of substrings with the set of needles.  An empty needle is in every
    haystack; NULL matches nothing.

    ``broadcast`` ships the needle set to the haystacks and moves no substring at all; needles above
    the limit are an error there.  ``shuffle`` takes any number of needles and moves 16 bytes per
    substring; it writes the distinct texts while the plan is built.  Cost per haystack is its length
    times the number of distinct needle lengths: made for identifiers.
    """
    texts = _distinct_texts(haystacks, haystack)
    stats = needle_stats(needles, needle)
    if _strategy(strategy, stats, limit) == "broadcast":
        return _broadcast_links(texts, needles, haystack, needle, stats)
    return _shuffled_links(staged(texts, "texts"), needles, haystack, needle, stats)


def substring_links(
    haystacks: DataFrame,
    needles: DataFrame,
    haystack: str,
    needle: str,
    strategy: str = "auto",
    limit: int = BROADCAST_LIMIT,
    exact: bool = True,
) -> DataFrame:
    """Haystack rows with each distinct needle they contain as ``gram``, once per row and needle.

    Too many needles to broadcast have the rows written.  Where their substrings of a needle's shape are few,
    rows are shuffled with these, and an equality join confirms them; a caller that joins ``gram`` with the
    needles anyway leaves that out by ``exact=False``, and other substrings may be among the rows then.
    """
    stats = needle_stats(needles, needle)
    if _strategy(strategy, stats, limit) == "broadcast":
        return _broadcast_links(haystacks, needles, haystack, needle, stats)
    if stats.shapes is not None:
        haystacks = staged(haystacks.where(F.col(haystack).isNotNull()), "rows")
    if _few_shaped(haystacks, haystack, stats):
        found = _with_shaped_grams(haystacks, haystack, stats.shapes)
        if exact:
            found = even_join(found, _needle_set(needles, needle), ["gram"], "left_semi")
        return found.select(*haystacks.columns, "gram")
    # rows with one text share its substrings, so these are made of distinct texts
    pairs = _shuffled_links(
        staged(_distinct_texts(haystacks, haystack), "texts"), needles, haystack, needle, stats
    )
    return even_join(pairs, haystacks, [haystack]).select(*haystacks.columns, "gram")


def substring_join(
    needles: DataFrame,
    haystacks: DataFrame,
    needle: str = "crosswalks_value",
    haystack: str = "haystack",
    strategy: str = "auto",
    limit: int = BROADCAST_LIMIT,
    same: tuple[str, str] | None = None,
) -> DataFrame:
    """Every pair of rows in which ``haystack`` contains ``needle`` (inner, duplicates kept).

    ``same`` names a column of ``needles`` and one of ``haystacks`` that must be equal as well, such as
    the entity; then distinct texts are matched per value of it, and NULL equals nothing.  ``haystacks`` is
    read twice.
    """
    clash = {c.lower() for c in needles.columns} & {c.lower() for c in haystacks.columns}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    keyed, rows, keys = needles.withColumn("gram", F.col(needle)), haystacks, ["gram"]
    if same is not None:
        mine, theirs = same
        keyed, rows = keyed.withColumn("_same", F.col(mine)), rows.withColumn("_same", F.col(theirs))
        keys.append("_same")
    columns = [*needles.columns, *haystacks.columns]
    stats = needle_stats(needles, needle)
    strategy = _strategy(strategy, stats, limit)
    if _few_shaped(haystacks, haystack, stats):
        # the join with the needles decides; a broadcast spares the shuffle of other substrings
        if strategy == "broadcast":
            found = _broadcast_links(rows, needles, haystack, needle, stats)
        else:
            found = _with_shaped_grams(rows, haystack, stats.shapes)
        return even_join(found, keyed.drop(needle), keys).withColumn(needle, F.col("gram")).select(*columns)
    if same is not None:
        texts = rows.select(haystack, "_same").distinct()
        links = substring_links(texts, needles, haystack, needle, strategy, limit, exact=False)
        pairs = even_join(links, keyed, keys)
        return even_join(pairs, rows, [haystack, "_same"]).select(*columns)
    pairs = substring_pairs(haystacks, needles, haystack, needle, strategy, limit)
    return even_join(even_join(pairs, keyed, keys), haystacks, [haystack]).select(*columns)


def substring_maxima(
    haystacks: DataFrame,
    needles: DataFrame,
    haystack: str,
    needle: str,
    strategy: str = "auto",
    limit: int = BROADCAST_LIMIT,
    by: Sequence[str] = (),
    exact: bool = True,
) -> DataFrame:
    """Per distinct needle, as ``gram``, the largest value of each other column over its haystacks; per needle
    and values of ``by``, if given.

    Pairs of rows are never formed: haystack rows that have to be shuffled are written once, then reduced
    per needle, with partial maxima before the shuffle; per text first, where a text has many substrings of
    a needle's shape.  ``exact`` is that of :func:`substring_links`.
    """
    stats = needle_stats(needles, needle)
    largest = [
        F.max(F.col(f"`{c}`")).alias(c) for c in haystacks.columns if c != haystack and c not in by
    ]
    if _strategy(strategy, stats, limit) == "broadcast":
        links = _broadcast_links(haystacks, needles, haystack, needle, stats)
        return links.groupBy("gram", *by).agg(*largest)
    known = haystacks.where(F.col(haystack).isNotNull())
    if stats.shapes is not None:
        known = staged(known, "rows")
    if _few_shaped(known, haystack, stats):
        found = _with_shaped_grams(known, haystack, stats.shapes).groupBy("gram", *by).agg(*largest)
        return even_join(found, _needle_set(needles, needle), ["gram"], "left_semi") if exact else found
    reduced = staged(known.groupBy(*by, haystack).agg(*largest), "texts")
    links = _shuffled_links(reduced, needles, haystack, needle, stats)
    return links.groupBy("gram", *by).agg(*largest)
