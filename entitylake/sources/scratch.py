"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED = "spark.checkpoint.dir"
_RUN = f"run-{uuid.uuid4().hex}"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a session known to be local gets a temporary folder; anywhere else that is an
    error, since a folder of one machine would be lost with it.  A path without a remote scheme is
    taken as given: it may be a mount that all machines share.
    """
    folder = spark.conf.get(SHARED, None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", None) or ""
    if master.split("[")[0] != "local":
        raise ValueError(f"{SHARED} must name a folder shared by the cluster")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="entitylake-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in this run's part of the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{_RUN}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that this driver process has staged, when no frame made of it is needed any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{_RUN}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, label: str, **options: str | int) -> DataFrame:
    """Write ``df`` once as a table and read it back: a cut in the lineage that outlives executors.

    For frames that feed several outputs.  Unlike a cached frame it is columnar, so each reader takes
    only the columns it needs.  ``options`` are those of the Parquet writer.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that :func:`staged` returned, when no frame made of it is needed any more."""
    spark = table.sparkSession
    jvm, run = spark.sparkContext._jvm, f"/{_RUN}/"
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        if run not in folder:
            raise ValueError(f"'{folder}' was not staged by this run")
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
