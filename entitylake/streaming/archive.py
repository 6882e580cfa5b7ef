"""Moving consumed landing files to an archive, with proof.

What a stream has consumed is read from its checkpoint: the source log names the files, the offsets say up
to which of them each batch went, and the commits say which batches are done.  Only files of committed
batches are moved, those of the last one included, and a file that is already in the archive is left
alone: the archiver may stop anywhere and be run again.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOVES_AT_ONCE = 32
PAGE = 10_000  # files that the driver holds at a time

ARCHIVED, WAITING, MISSING = "archived", "waiting", "missing"


def _numbered() -> Column:
    """The number in the name of the file that a line comes from."""
    return F.regexp_extract(F.input_file_name(), r"/(\d+)(?:\.compact)?$", 1).cast("long")


def committed_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``file`` and ``batch`` of all that committed batches of a stream with one file source consumed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
    done = max((int(n) for n in names if n.isdigit()), default=None)
    if done is None:
        return spark.createDataFrame([], "file string, batch long")
    offsets = spark.read.text(f"{checkpoint}/offsets")
    offsets = offsets.withColumn("batch", _numbered()).where(F.col("batch") <= done)
    reached = F.get_json_object("value", "$.logOffset").cast("long")
    steps = offsets.select("batch", reached.alias("step")).where("step is not null")
    first = steps.groupBy("step").agg(F.min("batch").alias("batch"))
    log = spark.read.text(f"{checkpoint}/sources/0").where("value like '{%'")
    entries = log.select(
        F.get_json_object("value", "$.path").alias("file"),
        F.get_json_object("value", "$.batchId").cast("long").alias("step"),
    ).distinct()  # entries come again in compacted logs
    return entries.join(first, "step").select("file", "batch")


def _plain(path: str) -> str:
    """Without scheme: the log writes full URIs whatever the stream was given."""
    return path.split("://", 1)[-1].removeprefix("file:").rstrip("/")


def _located(spark: SparkSession, folder: str) -> DataFrame:
    """The files below a folder, without reading them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "path string")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return found.select("path")


def _below(folder: str, path: str) -> Column:
    plain = _plain(folder)
    at = F.instr(F.col(path), F.lit(plain))
    return F.substring(F.col(path), at + len(plain) + 1, F.length(path))


def archive_state(spark: SparkSession, landing: str, archive: str, checkpoint: str) -> DataFrame:
    """``file`` (below ``landing``), ``batch``, ``state`` of every consumed file: archived, still waiting in
    the landing folder, or in neither."""
    consumed = committed_files(spark, checkpoint).select(_below(landing, "file").alias("file"), "batch")
    there = _located(spark, archive).select(_below(archive, "path").alias("file"), F.lit(True).alias("there"))
    here = _located(spark, landing).select(_below(landing, "path").alias("file"), F.lit(True).alias("here"))
    known = consumed.join(there, "file", "left").join(here, "file", "left")
    state = F.when(F.col("there"), ARCHIVED).when(F.col("here"), WAITING).otherwise(MISSING)
    return known.select("file", "batch", state.alias("state"))


def archive_consumed(spark: SparkSession, landing: str, archive: str, checkpoint: str) -> int:
    """Move all consumed files that still wait; returns how many were moved.

    Moves are renames, ``MOVES_AT_ONCE`` at a time, of pages of the list: the driver never holds it whole.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    files = path(landing).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def move(name: str) -> int:
        target = path(f"{archive.rstrip('/')}/{name}")
        files.mkdirs(target.getParent())
        if files.rename(path(f"{landing.rstrip('/')}/{name}"), target):
            return 1
        if files.exists(target):  # another archiver was faster
            return 0
        raise OSError(f"{name} could not be moved to {archive}")

    state = archive_state(spark, landing, archive, checkpoint).where(F.col("state") == WAITING)
    names = (r["file"] for r in state.select("file").toLocalIterator())
    moved = 0
    with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
        while page := list(islice(names, PAGE)):
            moved += sum(pool.map(move, page))
    return moved
