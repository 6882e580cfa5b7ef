"""A conditional-max pivot kept up to date from changes, withdrawals included.

A maximum grows with every new value but cannot be taken back.  So two tables are kept: the values themselves, as
changes of their counts, and a row per key with a cell per name, in folders by a hash of the key.  Changes are stored
as they come, which needs neither a shuffle nor a sort, and in the order of that hash once they are compacted.
A cell is exact while at most one value counts there (the value and its count); otherwise it is the largest value
alone.  A batch meets the stored rows in one shuffle by key.  Where a cell is exact, and the batch adds and withdraws one
value each at most, counts are added up; where it only adds, two maxima are merged.  Where neither holds, the cell
is computed anew from the stored changes, and so it is later on as long as more of some value was withdrawn than
added.  A batch that is small beside the stored rows writes the keys that it touches; another replaces them
all, so that readers find every key once.

A value counts while it was added more often than withdrawn; order does not matter, so a correction may
come before what it corrects.  A key is there while any of its rows is, whatever their names, as in
:func:`~entitylake.operators.pivot.pivot_max`.  Each batch is one commit (:mod:`entitylake.sources.manifest`): readers
see all of it or none, and one that runs again is stored once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from entitylake.functions.membership import membership
from entitylake.functions.paths import require_unique
from entitylake.operators.linkage import even_join
from entitylake.operators.pivot import pivot_max
from entitylake.sources.manifest import Commit, Manifest

LAYOUT = 2  # of the stored tables, kept in the notes of every commit
PLACES = 4096  # parts of the keys, by hash, whose rows are counted
CROWDED = 1 << 20  # rows; a part with fewer is no burden for one task
SMALL = 4  # a batch is small when this many times its rows are fewer than the stored ones

#: ``name`` is a position among the names, 0 for all others.  Without a count several values count, and ``value`` is
#: the largest; ``owed``: more of some value was withdrawn than added.  Without both the cell has to be computed anew.
CELL = StructType(
    [
        StructField("name", IntegerType()), StructField("value", StringType()),
        StructField("count", LongType()), StructField("owed", BooleanType()),
    ]
)
_ANEW = "count IS NULL AND owed IS NULL"


def _present(value: Column) -> Column:
    """A text for every value, the least for a missing one; the order of the others stays."""
    return F.coalesce(F.concat(F.lit("="), value), F.lit(""))


def _original(present: Column) -> Column:
    return F.when(present != "", F.substring(present, 2, 2**31 - 1))


def _live(cell: Column) -> Column:
    """Does anything count?  Never missing, also for a cell that is not there."""
    return F.coalesce(cell["count"] > 0, cell["value"].isNotNull())


@dataclass(frozen=True)
class PivotState:
    """The pivot by ``keys`` of rows ``(*keys, name, value)`` below ``base``.

    Keys are texts; a missing key is a key of its own.
    """

    base: str
    keys: Sequence[str]
    names: Sequence[str]
    buckets: int = 64
    compact_every: int = 16

    def __post_init__(self):
        own = (
            "cell", "cells", "name", "value", "change", "count", "owed", "version", "pending", "bucket", "touched",
            "stored", "last", "added", "least_added", "adds", "taken", "least_taken", "takes", "least", "rank", "step",
            "c0", "c1", "c2",
        )
        require_unique([*self.keys, *own], "columns of the state")

    def _schema(self, *rest: StructField) -> StructType:
        texts = [StructField(n, StringType()) for n in self.keys]
        return StructType([*texts, *rest, StructField("bucket", IntegerType())])

    @property
    def changes(self) -> StructType:
        texts = [StructField(n, StringType()) for n in ("name", "value")]
        return self._schema(*texts, StructField("change", LongType()))

    @property
    def maxima(self) -> StructType:
        """``pending``: a cell of the row has to be computed anew, and the row stands in another folder."""
        return self._schema(
            StructField("cells", ArrayType(CELL)), StructField("version", LongType()),
            StructField("pending", BooleanType()),
        )

    @property
    def _labels(self) -> list[str]:
        return list(dict.fromkeys(n.strip().lower() for n in self.names))

    def _said(self, rows: DataFrame) -> DataFrame:
        """Changes as they are stored.  Names that the pivot does not have are one, without a value."""
        label = F.lower(F.trim("name"))
        wanted = F.coalesce(label.isin(self._labels), F.lit(False))
        named = rows.where("change != 0").select(
            *[F.col(k).cast("string").alias(k) for k in self.keys],
            F.when(wanted, label).otherwise(F.lit("")).alias("name"),
            F.when(wanted, F.col("value").cast("string")).alias("value"),
            F.col("change").cast("long").alias("change"),
        )
        return named.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _placed(self, changes: DataFrame) -> DataFrame:
        """Stored changes with their name as a position."""
        position = F.array_position(F.array(*[F.lit(n) for n in self._labels]), F.col("name"))
        return changes.select(
            *self.keys, position.cast("int").alias("name"), _present(F.col("value")).alias("value"), "change"
        )

    def store(self, changes: DataFrame, number: int) -> Commit:
        """Take in batch ``number``: rows ``(*keys, name, value, change)``, where ``change`` is 1 for a new
        value and -1 for a withdrawn one."""
        spark = changes.sparkSession
        manifest = Manifest(spark, self.base)
        known = manifest.read(number)
        if known is not None:
            return known
        latest = self._latest(manifest)
        folders = {n: list(latest.datasets[n]) if latest else [] for n in ("changes", "maxima")}
        notes = {"layout": LAYOUT, "plain": latest is None or latest.notes["plain"]}

        def write(name: str, rows: DataFrame) -> str:
            folder = manifest.folder(name)
            ordered = rows.select(*getattr(self, name).names)
            by = ["bucket"] if name == "maxima" else []
            ordered.write.option("compression", "zstd").partitionBy(*by).parquet(manifest.absolute(folder))
            return folder

        folders["changes"].append(write("changes", self._said(changes)))
        draft = Commit(number, folders, {})
        own = Commit(number, {"changes": folders["changes"][-1:]}, {})
        fresh = manifest.dataset("changes", self.changes, own)
        buckets = [r.bucket for r in fresh.select("bucket").distinct().collect()]
        if not buckets:
            return manifest.commit(number, folders, notes)
        where = F.col("bucket").isin(buckets)
        stored = self._stored(manifest, latest)
        rows, thinned = self._thinned(self._placed(fresh))
        whole = rows * SMALL >= stored.count()
        merged = self._merged(stored if whole else stored.where(where), thinned)
        settled = write("maxima", self._rows(merged, number, whole))
        folders["maxima"] = [settled] if whole else [*folders["maxima"], settled]
        notes["plain"] = whole
        pending = manifest.dataset("maxima", self.maxima, Commit(number, {"maxima": [settled]}, {})).where("pending")
        if not pending.isEmpty():
            history = self._placed(manifest.dataset("changes", self.changes, draft).where(where))
            anew = self._anew(pending, history)
            folders["maxima"].append(write("maxima", self._rows(anew, number, whole)))
        if len(folders["changes"]) >= self.compact_every:
            every = self._merged(self._stored(manifest, draft))
            folders = {
                "changes": [write("changes", self._compacted(manifest, draft))],
                "maxima": [write("maxima", self._rows(every, number, True))],
            }
            notes["plain"] = True
        return manifest.commit(number, folders, notes)

    @staticmethod
    def _latest(manifest: Manifest) -> Commit | None:
        latest = manifest.read()
        if latest is not None and latest.notes.get("layout") != LAYOUT:
            raise ValueError(f"'{manifest.base}' holds a pivot in an earlier layout; build it anew from its changes")
        return latest

    def _stored(self, manifest: Manifest, commit: Commit | None) -> DataFrame:
        return manifest.dataset("maxima", self.maxima, commit or Commit(0, {}, {})).where("not pending")

    def _thinned(self, rows: DataFrame) -> tuple[int, DataFrame]:
        """How many ``rows`` there are, and rows that tell as much of each cell.

        Rows are placed by key as they are, which needs no memory before the shuffle.  Only where a part of the
        keys has far more rows than the others, so that some key may be hot, are a cell's rows first reduced to four
        at most: the largest and the least value that is added, and that is withdrawn.
        """
        place = F.pmod(F.xxhash64(*self.keys), F.lit(PLACES))
        found = rows.groupBy(place.alias("place")).count().collect()
        total = sum(r["count"] for r in found)
        crowded = [r.place for r in found if r["count"] > max(CROWDED, SMALL * total / PLACES)]
        if not crowded:
            return total, rows
        adds, takes = (self._ends(rows.where(place.isin(crowded)), sign) for sign in ("> 0", "< 0"))
        return total, rows.where(~place.isin(crowded)).unionByName(adds).unionByName(takes)

    def _ends(self, rows: DataFrame, sign: str) -> DataFrame:
        ends = rows.where(f"change {sign}").groupBy(*self.keys, "name").agg(
            F.max("value").alias("last"), F.min("value").alias("least"), F.sum("change").alias("change")
        )
        return ends.select(
            *self.keys, "name", F.explode(F.array_distinct(F.array("last", "least"))).alias("value"), "change"
        )

    def _merged(self, stored: DataFrame, fresh: DataFrame | None = None) -> DataFrame:
        """The cells that follow from stored rows and a batch, each with ``touched``: does the batch say
        anything about it?  One shuffle by key, of which the aggregations make use."""
        rows = stored.select(*self.keys, "cells", "version")
        if fresh is not None:
            rows = fresh.unionByName(rows, allowMissingColumns=True)
        else:
            none = {n: F.lit(None).cast(t) for n, t in (("name", "int"), ("value", "string"), ("change", "long"))}
            rows = rows.withColumns(none)
        said = F.struct("name", "value", F.col("change").alias("count"), F.lit(None).cast("boolean").alias("owed"))
        cells = rows.repartition(*self.keys).select(
            *self.keys, "version", F.col("cells").isNotNull().alias("stored"),
            F.explode(F.coalesce("cells", F.array(said))).alias("cell"),
        ).where("cell IS NOT NULL").select(*self.keys, "version", "stored", "cell.*")
        add, take = F.expr("NOT stored AND count > 0"), F.expr("NOT stored AND count < 0")
        met = cells.groupBy(*self.keys, "name").agg(
            F.max(F.when(F.col("stored"), F.struct("version", "value", "count", "owed"))).alias("last"),
            F.max(F.when(add, F.col("value"))).alias("added"),
            F.min(F.when(add, F.col("value"))).alias("least_added"),
            F.sum(F.when(add, F.col("count"))).alias("adds"),
            F.max(F.when(take, F.col("value"))).alias("taken"),
            F.min(F.when(take, F.col("value"))).alias("least_taken"),
            F.sum(F.when(take, F.col("count"))).alias("takes"),
        )
        return self._after(met)

    def _after(self, met: DataFrame) -> DataFrame:
        """The cells after the batch."""
        # up to three values; the count of one that was seen already goes to its first place
        counts = met.withColumns({
            "c0": F.expr("""coalesce(last.count, 0L) + if(added <=> last.value, coalesce(adds, 0L), 0L)
                + if(taken <=> last.value, coalesce(takes, 0L), 0L)"""),
            "c1": F.expr("""if(added <=> last.value, 0L, coalesce(adds, 0L)
                + if(taken <=> added, coalesce(takes, 0L), 0L))"""),
            "c2": F.expr("if(taken <=> last.value OR taken <=> added, 0L, coalesce(takes, 0L))"),
            "step": F.expr("""CASE
                WHEN added IS NULL AND taken IS NULL THEN 'untouched'
                WHEN (last IS NULL OR last.count IS NOT NULL)
                    AND added <=> least_added AND taken <=> least_taken THEN 'counted'
                WHEN taken IS NULL AND NOT coalesce(last.owed OR last.count < 0, false) THEN 'grown'
                END"""),
        })
        several = "int(c0 != 0) + int(c1 != 0) + int(c2 != 0) > 1"
        value = f"""CASE step WHEN 'untouched' THEN last.value
            WHEN 'grown' THEN greatest(if(last.count IS NULL OR last.count > 0, last.value, NULL), added)
            WHEN 'counted' THEN if({several},
                greatest(if(c0 > 0, last.value, NULL), if(c1 > 0, added, NULL), if(c2 > 0, taken, NULL)),
                coalesce(if(c0 != 0, last.value, NULL), if(c1 != 0, added, NULL), if(c2 != 0, taken, NULL)))
            END"""
        count = f"""CASE step WHEN 'untouched' THEN last.count
            WHEN 'counted' THEN if({several}, NULL, c0 + c1 + c2) END"""
        owed = f"""CASE step WHEN 'untouched' THEN last.owed WHEN 'grown' THEN false
            WHEN 'counted' THEN {several} AND (c0 < 0 OR c1 < 0 OR c2 < 0) END"""
        named = {"value": value, "count": count, "owed": owed}
        return counts.select(
            *self.keys, "name", F.struct(*[F.expr(e).alias(n) for n, e in named.items()]).alias("cell"),
            F.expr("step IS NULL OR step != 'untouched'").alias("touched"),
        )

    def _rows(self, cells: DataFrame, number: int, whole: bool) -> DataFrame:
        """Cells side by side, a row per key: with ``whole`` all keys where anything counts, else those touched."""
        columns = [f"cell {i}" for i in range(len(self._labels) + 1)]
        named = cells.select(
            *self.keys, F.concat(F.lit("cell "), F.col("name").cast("string")).alias("name"),
            F.struct(F.struct("name", "cell.*").alias("cell"), "touched").alias("value"),
        )
        wide = pivot_max(named, self.keys, columns, "exact", "name", "value")
        found = [F.col(f"`{c}`") for c in columns]
        kept = [c["cell"] for c in found]
        if whole:
            kept = [F.when(F.coalesce(c["count"] != 0, c.isNotNull()), c) for c in kept]
        there = [k.isNotNull() if whole else F.coalesce(c["touched"], F.lit(False)) for k, c in zip(kept, found)]
        pending = [c.isNotNull() & c["count"].isNull() & c["owed"].isNull() for c in kept]
        return wide.where(reduce(or_, there)).select(
            *self.keys, F.array(*kept).cast(ArrayType(CELL)).alias("cells"),
            F.lit(number).cast("long").alias("version"), reduce(or_, pending).alias("pending"),
            F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket"),
        )

    def _anew(self, pending: DataFrame, history: DataFrame) -> DataFrame:
        """The cells of pending rows, of which the open ones are computed from all changes."""
        cells = pending.select(*self.keys, F.explode("cells").alias("cell")).where("cell IS NOT NULL")
        cells = cells.select(*self.keys, "cell.*")
        # a struct equals another whose missing fields are missing too
        id_ = F.struct(*self.keys, "name")
        again = cells.where(_ANEW).select(id_.alias("cell"))
        values = history.select(id_.alias("cell"), "value", "change")
        may = membership(again.select(F.xxhash64("cell").alias("hash")), "hash", again.count())
        if may is not None:
            values = values.where(may(F.xxhash64("cell")))
        values = even_join(values, again, ["cell"], "left_semi")
        counts = values.groupBy("cell", "value").agg(F.sum("change").alias("count")).where("count != 0")
        found = counts.groupBy("cell").agg(
            F.max(F.when(F.col("count") > 0, F.col("value"))).alias("largest"), F.max("value").alias("only"),
            F.count(F.lit(1)).alias("values"), F.sum("count").alias("count"), F.min("count").alias("least"),
        )
        one = F.col("values") == 1
        known = found.select(
            "cell.*", F.when(one, F.col("only")).otherwise(F.col("largest")).alias("value"),
            F.when(one, F.col("count")).alias("count"), (~one & (F.col("least") < 0)).alias("owed"),
        )
        # a cell of which nothing counts any more has no values left, but is told from one that is not known
        empty = again.select("cell.*", F.lit(None).cast("string").alias("value"),
                             F.lit(0).cast("long").alias("count"), F.lit(False).alias("owed"))
        rows = cells.where(f"NOT ({_ANEW})").unionByName(known)
        marked = rows.withColumn("rank", F.lit(1)).unionByName(empty.withColumn("rank", F.lit(0)))
        state = ["rank", "value", "count", "owed"]
        last = marked.repartition(*self.keys).groupBy(*self.keys, "name").agg(F.max(F.struct(*state)).alias("cell"))
        return last.select(
            *self.keys, "name", F.struct("cell.value", "cell.count", "cell.owed").alias("cell"),
            F.lit(True).alias("touched"),
        )

    def _compacted(self, manifest: Manifest, commit: Commit) -> DataFrame:
        rows = manifest.dataset("changes", self.changes, commit)
        summed = rows.groupBy(*self.keys, "name", "bucket", "value")
        left = summed.agg(F.sum("change").alias("change")).where("change != 0")
        return left.sortWithinPartitions("bucket")  # so that a reader passes over groups of rows

    def current(self, spark: SparkSession) -> DataFrame:
        """``keys`` and ``names``, as of the latest batch."""
        manifest = Manifest(spark, self.base)
        require_unique([*self.keys, *self.names], "pivot columns")
        latest = self._latest(manifest)
        rows = self._stored(manifest, latest)
        if latest is not None and not latest.notes["plain"]:
            rows = self._rows(self._merged(rows), latest.version, True)
        labels = self._labels
        live = reduce(or_, [_live(F.get("cells", F.lit(i))) for i in range(len(labels) + 1)])

        def value(name: str) -> Column:
            cell = F.get("cells", F.lit(labels.index(name.strip().lower()) + 1))
            return _original(F.when(_live(cell), cell["value"])).alias(name)

        return rows.where(live).select(*self.keys, *[value(n) for n in self.names])
