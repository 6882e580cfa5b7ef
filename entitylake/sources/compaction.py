"""Many small landing files to few large ones.

A manifest records which landing files have been taken and what they became.  A run lists the folder, takes
the files that are new, at most ``page`` of them at a time, and copies their lines in one pass without a
shuffle: small files are packed into read tasks of the target size, and every task writes one file.
A run that dies leaves the earlier state; a file is taken once however often the run is repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from entitylake.sources.manifest import Commit, Manifest

SOURCES = StructType(
    [
        StructField("file", StringType()), StructField("bytes", LongType()),
        StructField("modified", TimestampType()), StructField("version", LongType()),
    ]
)
DOCUMENTS, TAKEN = "documents", "sources"


def landing_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file``, ``bytes``, ``modified`` of the files below ``folder``; their contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return found.select(
        F.col("path").alias("file"), F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def _packing(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A session that reads ``target_bytes`` per task: whole small files together, large ones in parts."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    return session


def compact_landing(
    spark: SparkSession, landing: str, base: str, target_bytes: int = 128 << 20, page: int = 10_000
) -> Commit | None:
    """Take all new files of JSON Lines below ``landing`` into the manifest ``base``.

    One commit per ``page`` files; its notes tell the numbers of files and bytes taken and of files written.
    Returns the latest commit.  Lines are copied as they are, broken ones too.
    """
    manifest = Manifest(spark, base)
    while True:
        latest = manifest.read()
        known = manifest.dataset(TAKEN, SOURCES, latest)
        fresh = landing_files(spark, landing).join(known.select("file"), "file", "left_anti")
        taken = fresh.where("bytes > 0").orderBy("modified", "file").limit(page).collect()
        if not taken:
            return latest
        version = latest.version + 1 if latest else 0
        folders = {n: list(latest.datasets[n]) if latest else [] for n in (DOCUMENTS, TAKEN)}
        lines = _packing(spark, target_bytes).read.text([r["file"] for r in taken])
        written = lines.rdd.getNumPartitions()
        documents, sources = manifest.folder(DOCUMENTS), manifest.folder(TAKEN)
        lines.write.text(manifest.absolute(documents))
        rows = spark.createDataFrame([(*r, version) for r in taken], SOURCES)
        rows.coalesce(1).write.parquet(manifest.absolute(sources))
        folders[DOCUMENTS].append(documents)
        folders[TAKEN].append(sources)
        size = sum(r["bytes"] for r in taken)
        notes = {"taken": len(taken), "bytes": size, "written": written}
        manifest.commit(version, folders, notes)


def compacted_folders(spark: SparkSession, base: str) -> list[str]:
    """The folders to read, with :func:`~entitylake.sources.documents.read_documents` for one."""
    manifest = Manifest(spark, base)
    commit = manifest.read()
    return [manifest.absolute(f) for f in commit.datasets[DOCUMENTS]] if commit else []
