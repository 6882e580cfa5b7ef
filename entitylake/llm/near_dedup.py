"""Near-duplicate documents by MinHash bands, odd sketches and a confirmation on full sets.

A document's set are its distinct shingles of some words, as 64-bit hashes.  512 MinHash samples are
taken of it; the first 200 make 40 bands of 5 rows.  A sketch has 1,024 bits.  That of a set of up to
``PARITY_KEPT`` shingles is its parity: each shingle flips one bit, so that two sets differ in at least
as many shingles as their sketches in bits, and a pair refused by that is certainly no link.  Of larger
sets the samples are folded into an odd sketch, each flipping one bit, which estimates the similarity.
Candidates share a band; those whose sketches are clearly apart are dropped, and the others are
confirmed on their full sets, exactly.

Copies meet first: documents with equal sets are one class, and only classes are compared.  Within a
band no pairs are formed at the start: each class is compared with the most connected class of its
band (the hub).  Only classes that this leaves in another component than their band's hub are then
compared with the rest of the band, block by block on their sketches, inside tasks of bounded
size.  Every link that could join two components is looked at, so components are those of all links.

A pair at a threshold of 0.85 shares no band with a probability of 7e-11, at 0.8 of 1.2e-7; odd sketches
of large sets are taken for too far apart (by more than ``DEVIATIONS`` standard deviations) with one of about 8e-8
and 6e-8, by the binomial law of the samples and a normal one of the bits.

Defined results: a text with fewer words than a shingle is one shingle; an empty or NULL text has
none and links with nothing.  Rows that share an id are one vertex.  A row without id takes the
smallest id linked to its class's other copies, NULL if there is none.  Other columns play no part.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.functions.membership import membership
from entitylake.llm.common import portions, resident
from entitylake.llm.components import components
from entitylake.operators.linkage import even_join
from entitylake.sources.scratch import staged

BANDS, ROWS = 40, 5
SAMPLES = 512  # two from each of half as many products
SKETCH_BITS = 1024
PARITY_KEPT = 1024  # larger sets flip each bit so often that their parity says little
PARITY_MADE = PARITY_KEPT * 5 // 4  # the sets that one of that size could be linked with at 0.8
FILTER_BITS = 1 << 25  # 4 MB, for eight million documents with candidates
DEVIATIONS = 5.5
BLOCK = 256
SEED = 7_919

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_WORDS_KEPT = 200_000


def _mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    values = (values ^ (values >> np.uint64(30))) * _MIX
    return values ^ (values >> np.uint64(29))


class Shingler:
    """Distinct shingle hashes of texts; remembers the hashes of words."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > _WORDS_KEPT:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word, SEED)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes.  A-Z count as a-z; words are parted by ASCII white space."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        hashes = self._hashes(words)
        width = min(self.words, len(hashes))
        size = len(hashes) - width + 1
        total = np.full(size, width, np.uint64) * _ODD
        for i in range(width):
            total = _mixed(total * _ODD + hashes[i : i + size])
        return np.unique(total)


def _shingler(words: int) -> Shingler:
    return resident(("shingles", words), lambda: Shingler(words))


@functools.cache
def _multipliers() -> np.ndarray:
    random = np.random.default_rng(SEED)
    return random.integers(0, 1 << 63, SAMPLES // 2, np.uint64) * np.uint64(2) + np.uint64(1)


def minhashes(hashes: np.ndarray) -> np.ndarray:
    """``SAMPLES`` 32-bit minima of a set that is not empty."""
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), 512):
        products = hashes[at : at + 512, None] * _multipliers()[None, :]
        least = np.minimum(least, products.view(np.uint32).min(0))
    return least


def band_hashes(least: np.ndarray) -> np.ndarray:
    rows = least[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    total = np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD
    for i in range(ROWS):
        total = _mixed(total * _ODD + rows[:, i])
    return total.view(np.int64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """The parity, per bit, of the samples that fall on it; as 64-bit integers."""
    place = _mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * _ODD + least)
    flips = np.bincount((place % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((flips & 1).astype(np.uint8)).view(np.int64)


def set_parity(hashes: np.ndarray) -> np.ndarray:
    """The parity, per bit, of the set's hashes that fall on it; as 64-bit integers."""
    place = (hashes % np.uint64(SKETCH_BITS)).astype(np.int64)
    flips = np.bincount(place, minlength=SKETCH_BITS)
    return np.packbits((flips & 1).astype(np.uint8)).view(np.int64)


def most_apart(threshold: float) -> int:
    """The largest number of differing sketch bits that a pair worth confirming may have.

    ``DEVIATIONS`` above the mean at the threshold.  A similarity of ``j`` lets a binomial number of
    samples differ, ``SAMPLES * (1 - j)`` on average, and two flips for each fall on the sketch: the
    expected number of odd bits is ``n / 2 * (1 - exp(-2 * flips / n))``.
    """
    flips = 2 * SAMPLES * (1 - threshold)
    even = np.exp(-2 * flips / SKETCH_BITS)
    of_samples = SAMPLES * threshold * (1 - threshold) * (2 * even) ** 2
    of_bits = SKETCH_BITS / 4 * (1 - even**2) - flips * even**2
    mean = SKETCH_BITS / 2 * (1 - even)
    return int(mean + DEVIATIONS * np.sqrt(of_samples + of_bits))


def signatures(documents: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """A row per row: ``id``, ``n`` (size of the set), ``class`` (16 bytes), ``bands``, ``sketch``, ``parity``.

    ``sketch`` is that of the samples, NULL up to ``PARITY_KEPT``; ``parity`` is NULL above ``PARITY_MADE``.
    Sets that could be linked have one of the two in common.
    """
    named = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    schema = pa.schema(
        [
            ("id", pa.int64()), ("n", pa.int64()), ("class", pa.binary()),
            ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())),
            ("parity", pa.list_(pa.int64())),
        ]
    )

    def signed(batches):
        shingler = _shingler(words)
        for part in portions(batches, 1):
            rows = []
            for text_ in part.columns[1].to_pylist():
                found = shingler.shingles(text_)
                if len(found):
                    least = minhashes(found)
                    name = xxhash.xxh3_128_digest(found.tobytes(), SEED)
                    sketch = odd_sketch(least) if len(found) > PARITY_KEPT else None
                    parity = set_parity(found) if len(found) <= PARITY_MADE else None
                    rows.append((len(found), name, band_hashes(least), sketch, parity))
                else:
                    rows.append((0, None, None, None, None))
            columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), list(schema)[1:])]
            yield pa.RecordBatch.from_arrays([part.columns[0], *columns], schema=schema)

    return named.mapInArrow(
        signed,
        "id long, n long, class binary, bands array<long>, sketch array<long>, parity array<long>",
    )


def shingle_sets(documents: DataFrame, words: int) -> DataFrame:
    """``id, text`` as ``id, shingles``."""
    schema = pa.schema([("id", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def sets(batches):
        shingler = _shingler(words)
        for part in portions(batches, 1):
            found = [shingler.shingles(t).view(np.int64) for t in part.columns[1].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.columns[0], pa.array(found, schema[1].type)], schema=schema
            )

    return documents.mapInArrow(sets, "id long, shingles array<long>")


def _apart(left: Column, right: Column) -> Column:
    """Differing bits of two sketches."""
    words = SKETCH_BITS // 64
    return functools.reduce(
        Column.__add__, [F.bit_count(left[i].bitwiseXOR(right[i])) for i in range(words)]
    )


def _near(pairs: DataFrame, classes: DataFrame, limit: int, percent: int) -> DataFrame:
    """Those of ``a, b`` that their sizes and sketches do not tell apart; ``limit`` is for sketches of samples."""

    def side(end: str) -> DataFrame:
        return classes.select(F.col("id").alias(end), F.struct("n", "sketch", "parity").alias(f"of_{end}"))

    both = even_join(even_join(pairs, side("a"), ["a"]), side("b"), ["b"])
    a, b = F.col("of_a"), F.col("of_b")
    sizes = 100 * F.least(a["n"], b["n"]) >= percent * F.greatest(a["n"], b["n"])
    differing = _apart(a["parity"], b["parity"])
    # shared / union, of sets that differ in so many elements at least
    possible = (100 + percent) * differing <= (100 - percent) * (a["n"] + b["n"])
    estimated = _apart(a["sketch"], b["sketch"]) <= limit
    return both.where(sizes & F.coalesce(possible, estimated)).select("a", "b")


def _with_ids(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Those of ``id, text`` whose id is in ``ids`` (a written table of distinct ids).

    Most rows are not, and are left out before the join would shuffle their texts; up to ``FILTER_BITS``.
    """
    listed = membership(ids.select(F.xxhash64("id").alias("_hash")), "_hash", ids.count(), FILTER_BITS)
    if listed is not None:
        texts = texts.where(listed(F.xxhash64("id")))
    return even_join(texts, ids, ["id"], "left_semi")


def _confirmed(
    pairs: DataFrame, documents: DataFrame, key: str, text: str, words: int, percent: int
) -> DataFrame:
    """Those of ``a, b`` whose full sets reach the threshold; staged."""
    pairs = staged(pairs, "near-candidates")
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "near-ids")
    texts = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    sets = staged(shingle_sets(_with_ids(texts, ids), words), "near-sets")
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    both = even_join(even_join(pairs, a, ["a"]), b, ["b"])
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    linked = both.where(100 * shared >= percent * union).select("a", "b").distinct()
    return staged(linked, "near-links")


def _rest_of_bands(members: DataFrame, limit: int, percent: int) -> DataFrame:
    """Candidate pairs ``a, b`` from different components of one band.

    ``members``: ``band, id, component, main`` (whether in the hub's component), ``n, bands, sketch,
    parity`` and ``size``, the number of the band's classes.  Blocks of at most about ``BLOCK`` members meet
    in pairs, never two blocks of the hub's component.  A pair is given by the first band it shares.
    """
    parts = F.ceil(F.col("size") / BLOCK)
    blocks = (
        members.withColumn("block", F.pmod(F.xxhash64("id"), parts).cast("int"))
        .groupBy("band", "main", "block")
        .agg(F.collect_list(F.struct("id", "component", "n", "bands", "sketch", "parity")).alias("rows"))
    )
    left = blocks.where(~F.col("main")).select("band", F.col("block").alias("at"), "rows")
    right = blocks.select(
        "band", "main", "block", F.col("rows").alias("others")
    )
    met = even_join(left, right, ["band"]).where(F.col("main") | (F.col("at") <= F.col("block")))

    def compared(batches):
        for batch in batches:
            found = [
                _compare(band, rows, others, limit, percent)
                for band, rows, others in zip(*(c.to_pylist() for c in batch.columns))
            ]
            pairs = np.concatenate([*found, np.empty((0, 2), np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"]
            )

    return met.select("band", "rows", "others").mapInArrow(compared, "a long, b long").distinct()


def _compare(band: int, rows: list[dict], others: list[dict], limit: int, percent: int) -> np.ndarray:
    ids, components_, sizes, bands = (
        [np.array([r[c] for r in side], np.int64) for side in (rows, others)]
        for c in ("id", "component", "n", "bands")
    )

    def apart(column: str) -> np.ndarray:
        missing = [0] * (SKETCH_BITS // 64)
        # as unsigned numbers: of signed ones the bits of the absolute value would be counted
        left, right = (
            np.array([r[column] or missing for r in side], np.int64).view(np.uint64) for side in (rows, others)
        )
        total = np.zeros((len(rows), len(others)), np.int64)
        for i in range(left.shape[1]):
            total += np.bitwise_count(left[:, None, i] ^ right[None, :, i])
        return total

    small = np.minimum(sizes[0][:, None], sizes[1][None, :])
    large = np.maximum(sizes[0][:, None], sizes[1][None, :])
    keep = (100 + percent) * apart("parity") <= (100 - percent) * (small + large)
    if large.max() > PARITY_MADE:
        keep = np.where(large > PARITY_MADE, (small > PARITY_KEPT) & (apart("sketch") <= limit), keep)
    keep &= 100 * small >= percent * large
    keep &= components_[0][:, None] != components_[1][None, :]
    i, j = np.nonzero(keep)
    first = (bands[0][i] == bands[1][j]).argmax(1)
    own = bands[0][i, first] == band
    a, b = ids[0][i[own]], ids[1][j[own]]
    return np.stack([np.minimum(a, b), np.maximum(a, b)], 1)


def near_duplicates(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """A row per row of ``documents``: the id as ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Linked are sets with ``100 * shared >= percent * union``.  ``percent`` of 80 or more: the bands
    are made for that.  ``component_id`` is the smallest id that links lead to.  Starts jobs.
    """
    limit = most_apart(percent / 100)
    signed = staged(signatures(documents, key, text, words), "near-signatures")
    classes = staged(
        signed.where(F.col("n") > 0).groupBy("class").agg(
            F.min("id").alias("id"), F.first("n").alias("n"),
            F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
            F.first("parity").alias("parity"),
        ).where(F.col("id").isNotNull()),
        "near-classes",
    )
    banded = classes.select("id", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = even_join(banded, shared, ["band"])
    rank = members.groupBy("id").agg(F.sum("size").alias("rank"))
    members = staged(even_join(members, rank, ["id"]), "near-members")
    hubs = members.groupBy("band").agg(F.max(F.struct("rank", "id"))["id"].alias("hub"))
    spokes = even_join(members, hubs, ["band"]).where("id != hub").select(
        F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")
    )
    stars = _confirmed(
        _near(spokes.distinct(), classes, limit, percent), documents, key, text, words, percent
    )
    labels = components(stars)

    def labelled(df: DataFrame, column: str, name: str) -> DataFrame:
        known = labels.select(F.col("id").alias(column), F.col("component").alias(name))
        joined = even_join(df, known, [column], "left")
        return joined.withColumn(name, F.coalesce(name, column))

    placed = even_join(
        labelled(members.select("band", "id", "size"), "id", "component"),
        labelled(hubs, "hub", "center").select("band", "center"),
        ["band"],
    ).withColumn("main", F.col("component") == F.col("center"))
    mixed = placed.where(~F.col("main")).select("band").distinct()
    rest = even_join(placed.drop("center"), mixed, ["band"], "left_semi")
    rest = even_join(rest, classes, ["id"])
    more = _confirmed(
        _rest_of_bands(rest, limit, percent), documents, key, text, words, percent
    )
    final = components(stars.unionByName(more))
    known = final.select("id", F.col("component").alias("label"))
    of_class = even_join(classes.select("class", "id"), known, ["id"], "left").select(
        "class", F.coalesce("label", "id").alias("of_class")
    )
    rows = even_join(signed.select("id", "n", "class"), of_class, ["class"], "left")
    component = F.coalesce("of_class", "id")
    return rows.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )
