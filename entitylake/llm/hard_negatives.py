"""Hard negatives: rows of other labels that score almost as high as an anchor's positives.

Scores are inner products of integer vectors ``floor(scale * entry)``, exact.  A threshold join after
L2AP finds them.  Rows are dealt to cells and anchors to groups; each cell meets each group in a task of its
own, a batch of anchors at a time, and no pair of rows is ever written.  How many of either there are follows
from the work and from the index's size, so that copies of rows and of anchors are about as many.  A cell
indexes its rows by
dimension, the weightiest dimensions first, and leaves out the trailing ones: where the norms of the
suffixes of row and anchor say that these add too little to matter, they are not accumulated.  For
each anchor the index gives partial scores; partial score plus the product of the remaining norms
bounds the score, and only rows whose bound reaches the threshold are scored in full.  The threshold
starts high and is lowered until the anchor's windows are full with rows above it, or the windows'
lower ends are passed: what lies below cannot be among the first any more.

Two joins: the first window is the best rows of the anchor's own label (its positives); the others
reach from ``low`` percent of a positive's score up to that score, over rows of other labels.  A cell
returns its best few rows per window; the best of all cells are the answer.  Thresholds only spare
work: any threshold gives the same rows.

Defined results: rows without a key or label, without a usable vector (missing, or with missing or
non-finite entries) take no part.  Shorter vectors count as filled up with zeros.  Equal scores are
ordered by the smaller key, then by row.  Rows may share a key; each is a row of its own.  Anchors equal
in key, label and vector are searched once and answered as often as they occur; each sees the others.
A window whose upper end lies below its lower end (a negative positive score) is empty.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.llm.integer_vectors import IntegerVectors, integer_vectors, matrix
from entitylake.sources.scratch import staged

CELL_BYTES = 128 << 20  # of a cell's index
ANCHORS_AT_ONCE = 128
PAIRS = 1 << 20  # of row and anchor, at least, that are worth a task
FIRST_CANDIDATES = 64  # so many rows reach the first threshold; eight times as many each further one
_STEP = 8  # dimensions that are put in or left out together


def mined(
    rows: DataFrame,
    key: str,
    vector: str,
    label: str | Column,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
    cell_bytes: int = CELL_BYTES,
    tasks: int | None = None,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on ``rows``; ``key`` and ``label`` are integers.  Starts jobs: the vectors
    and the positives are written once.  ``low`` and ``high`` bound a negative's score in percent of the
    positive's.  ``tasks`` is the number wanted, by default twice the cores, or fewer for little work; all
    numbers give the same rows.
    """
    labels = F.col(label) if isinstance(label, str) else label
    wanted = {
        "key": F.col(key).cast("long"), "label": labels.cast("long"),
        "anchor": F.coalesce(anchors, F.lit(False)),
    }
    known = rows.where(F.col(key).isNotNull() & labels.isNotNull())
    data = integer_vectors(known, vector, scale, wanted, same_length=False)
    asked = staged(
        data.table.where("anchor")
        .groupBy("key", "label", "numbers")
        .agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("copies")),
        "anchors",
    )
    sought = asked.count()
    if tasks is None:
        tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
        tasks = min(tasks, math.ceil(data.rows * sought / PAIRS))
    grid = _grid(data.rows, sought, max(tasks, 1), data.rows * data.dims * 4 / cell_bytes)
    nothing = F.array().cast("array<long>")
    first = asked.withColumns({"lows": nothing, "highs": nothing})
    best = Window.partitionBy("row").orderBy(F.desc("score"), "found_key", "found_row")
    found = _searched(data, first, grid, positives).withColumn("rank", F.row_number().over(best))
    found = found.where(F.col("rank") <= positives)
    found = staged(found.select("row", "rank", "found_key", "score"), "positives")
    listed = found.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("own")  # ``positives`` at most
    )
    # integers s with low * p <= 100 * s <= high * p
    windows = asked.join(listed, "row").select(
        *asked.columns,
        F.transform("own", lambda p: _up(low * p["score"])).alias("lows"),
        F.transform("own", lambda p: _down(high * p["score"])).alias("highs"),
    )
    best = Window.partitionBy("row", "window").orderBy(F.desc("score"), "found_key", "found_row")
    other = _searched(data, windows, grid, negatives).withColumn("rank", F.row_number().over(best))
    other = other.where(F.col("rank") <= negatives).select(
        "row", F.col("window").alias("at"), "rank", F.col("found_key").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    own = found.select(
        "row", F.col("rank").alias("at"), F.col("found_key").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    pairs = other.join(own, ["row", "at"]).join(asked.select("row", "key", "copies"), "row")
    each = pairs.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select(
        F.col("key").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score",
        "negative_score",
    )


def _grid(rows: int, anchors: int, tasks: int, least: float) -> tuple[int, int]:
    """Numbers of cells, ``least`` at least, and of groups of anchors: about ``tasks`` pairs of them, with as
    few copies of rows (one per group) and of anchors (one per cell) as that allows."""
    groups = max(1, round(math.sqrt(tasks * anchors / rows))) if rows else 1
    return max(1, math.ceil(least), math.ceil(tasks / groups)), groups


def _down(hundredths: Column) -> Column:
    return F.floor(hundredths.cast("decimal(30,0)") / 100).cast("long")


def _up(hundredths: Column) -> Column:
    return F.ceil(hundredths.cast("decimal(30,0)") / 100).cast("long")


def _searched(
    data: IntegerVectors, asked: DataFrame, grid: tuple[int, int], most: int
) -> DataFrame:
    """``row`` of the anchor, ``window`` from 1, ``found_key``, ``found_row``, ``score``: the best ``most``
    rows of every cell in every window.  Without windows that is one over the anchor's own label."""
    columns = ["row", "key", "label", "numbers"]
    none = F.lit(None).cast("array<long>")
    cells, groups = grid

    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    def placed(rows: DataFrame, role: int, cell: Column, group: Column, *rest: Column | str) -> DataFrame:
        at = rows.select("*", cell.alias("_cell")).select("*", group.alias("_group"))
        number = F.col("_cell") * groups + F.col("_group")
        return at.select(number.alias("cell"), F.lit(role).alias("role"), *columns, *rest)

    rows = placed(data.table, 0, dealt(cells), every(groups), none.alias("lows"), none.alias("highs"))
    asking = placed(asked, 1, every(cells), dealt(groups), "lows", "highs")
    met = rows.unionByName(asking).repartition(cells * groups, "cell")
    met = met.sortWithinPartitions("cell", "role")
    dims, kind = data.dims, data.kind

    def search(batches):
        cell, parts, index = None, [], None
        for batch in batches:
            for part in _runs(batch):
                here, role = part.column("cell")[0].as_py(), part.column("role")[0].as_py()
                if here != cell:
                    cell, parts, index = here, [], None
                if role == 0:
                    parts.append(part)
                    continue
                if index is None:
                    index, parts = Index(parts, dims, kind), []
                for at in range(0, part.num_rows, ANCHORS_AT_ONCE):
                    yield index.search(part.slice(at, ANCHORS_AT_ONCE), most)

    result = "row long, window int, found_key long, found_row long, score long"
    return met.mapInArrow(search, T.StructType.fromDDL(result))


def _runs(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    """A batch sorted by cell and role, cut where either changes."""
    both = np.stack([batch.column(n).to_numpy() for n in ("cell", "role")])
    cuts = [0, *(np.flatnonzero((both[:, 1:] != both[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a]


class Index:
    """The rows of a cell by dimension, and searches in them."""

    def __init__(self, parts: list[pa.RecordBatch], dims: int, kind: str):
        self.dims, self.kind = dims, kind

        def joined(name: str) -> np.ndarray:
            pieces = [p.column(name).to_numpy() for p in parts]
            return np.concatenate(pieces) if pieces else np.zeros(0, np.int64)

        keys, rows = joined("key"), joined("row")
        order = np.lexsort((rows, keys))  # rows of equal score are then in their order of rank
        self.keys, self.rows, self.labels = keys[order], rows[order], joined("label")[order]
        pieces = [matrix(p.column("numbers"), dims, kind) for p in parts]
        numbers = np.concatenate(pieces)[order] if pieces else np.zeros((0, dims), kind)
        energy = (numbers.astype(np.float64) ** 2).sum(0)
        self.by_weight = np.argsort(-energy, kind="stable")
        numbers = numbers[:, self.by_weight]
        self.cuts = [*range(0, dims, _STEP), dims]
        self.rest = _suffix_norms(numbers, self.cuts)
        self.longest = self.rest.max(1) if len(numbers) else np.zeros(len(self.cuts))
        self.numbers = np.ascontiguousarray(numbers.T)  # a posting list per dimension
        self.exact = {}

    def _postings(self, reach: float) -> np.ndarray:
        """The numbers in a type that holds every sum of products up to ``reach`` exactly."""
        kind = np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64
        if kind not in self.exact:
            if kind is np.int64 and reach >= 1 << 62:
                raise ValueError("scores do not fit in 64 bits")
            self.exact = {kind: self.numbers.astype(kind)}
        return self.exact[kind]

    def search(self, asked: pa.RecordBatch, most: int) -> pa.RecordBatch:
        anchors = matrix(asked.column("numbers"), self.dims, self.kind)[:, self.by_weight]
        rest = _suffix_norms(anchors, self.cuts)
        lengths = rest[0] if self.dims else np.zeros(len(anchors))
        postings = self._postings(float(lengths.max(initial=0.0) * self.longest.max(initial=0.0)) + 1)
        anchors = anchors.astype(postings.dtype)
        lows, highs = asked.column("lows").to_pylist(), asked.column("highs").to_pylist()
        floors = [min(x, default=None) for x in lows]
        cut = self._indexed(rest, floors)
        head = self.cuts[cut]
        partial = anchors[:, :head] @ postings[:head]
        out = []
        for i, anchor in enumerate(anchors):
            row, label = asked.column("row")[i].as_py(), asked.column("label")[i].as_py()
            same = self.labels == label
            if lows[i]:
                windows = [(~same, low, high) for low, high in zip(lows[i], highs[i]) if low <= high]
                places = [n for n, (a, b) in enumerate(zip(lows[i], highs[i]), 1) if a <= b]
            else:
                windows, places = [(same & (self.rows != row), None, None)], [1]
            bound = partial[i] + rest[cut, i] * self.rest[cut] * (1 + 1e-5) + 1e-3
            taken = self._taken(windows, anchor, partial[i], head, bound, postings, most)
            for place, (at, scores) in zip(places, taken):
                out.append((np.full(len(at), row), np.full(len(at), place, np.int32),
                            self.keys[at], self.rows[at], scores))
        names = ["row", "window", "found_key", "found_row", "score"]
        kinds = [np.int64, np.int32, np.int64, np.int64, np.int64]
        columns = [
            pa.array(np.concatenate([o[k] for o in out]).astype(kind) if out else np.zeros(0, kind))
            for k, kind in enumerate(kinds)
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def _indexed(self, rest: np.ndarray, floors: list[int | None]) -> int:
        """How many blocks of dimensions are accumulated for all rows: those left out add at most half
        of the lowest threshold, or of what the longest row could reach where there is none."""
        reach = rest[:, :].max(1, initial=0.0) * self.longest
        known = [f for f in floors if f is not None]
        enough = (max(min(known), 0) if known and len(known) == len(floors) else reach[0] / 2) / 2
        return int(np.argmax(reach <= enough)) if (reach <= enough).any() else len(reach) - 1

    def _taken(self, windows, anchor, partial, head, bound, postings, most):
        """Places and scores of the best ``most`` rows of each window: (rows, low, high)."""
        if not windows or not len(bound):
            return [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(windows)
        floor = None if windows[0][1] is None else min(low for _, low, _ in windows)
        fits = np.logical_or.reduce([w[0] for w in windows])
        if floor is not None:
            fits &= bound >= floor
        place = np.flatnonzero(fits)
        upper = bound[place]
        scored, scores, wanted = np.zeros(0, np.int64), np.zeros(0, np.int64), FIRST_CANDIDATES
        while True:
            threshold = -np.inf
            if wanted < len(place):
                threshold = np.partition(upper, len(upper) - wanted)[len(upper) - wanted]
            now = upper >= threshold
            fresh = place[now]
            place, upper = place[~now], upper[~now]
            whole = partial[fresh] + anchor[head:] @ postings[head:][:, fresh]
            scored = np.concatenate([scored, fresh])
            scores = np.concatenate([scores, whole.astype(np.int64)])
            taken, full = [], True
            for rows, low, high in windows:
                inside = rows[scored]
                if low is not None:
                    inside &= (scores >= low) & (scores <= high)
                at, score = _best(scored[inside], scores[inside], most)
                taken.append((at, score))
                full &= (score >= threshold).sum() >= most or low is not None and threshold <= low
            if full or not len(place):
                return taken
            wanted *= 8


def _suffix_norms(numbers: np.ndarray, cuts: list[int]) -> np.ndarray:
    """A row per cut: the norm of every vector from there on, in double precision."""
    squares = np.zeros((len(cuts), len(numbers)))
    for k in range(len(cuts) - 2, -1, -1):
        part = numbers[:, cuts[k] : cuts[k + 1]].astype(np.float64)
        squares[k] = squares[k + 1] + (part * part).sum(1)
    return np.sqrt(squares)


def _best(places: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest scores, of equal ones the first places."""
    if len(scores) > most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        above = scores > least
        ties = np.flatnonzero(scores == least)
        spare = ties[np.argsort(places[ties], kind="stable")][: most - int(above.sum())]
        keep = np.concatenate([np.flatnonzero(above), spare])
        places, scores = places[keep], scores[keep]
    order = np.lexsort((places, -scores))
    return places[order], scores[order]
