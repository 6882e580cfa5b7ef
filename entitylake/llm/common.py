"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import shutil
import sys
import tempfile
import threading
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import entitylake


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Spark distributes the archive; workers need no installed copy and no shared source folder.
    """
    _shipped(spark.sparkContext.applicationId)


@functools.cache
def _shipped(application: str) -> None:
    package = os.path.dirname(os.path.abspath(entitylake.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "entitylake")
    shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package))
    SparkSession.active().sparkContext.addPyFile(f"{archive}.zip")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


IDLE_SECONDS = 8.0

_held: dict = {}
_used = 0.0
_watcher: threading.Thread | None = None


def resident(name: tuple, make: Callable):
    """What an operator keeps between the tasks of a Python worker, made when first asked for.

    Only the latest operator's is kept, and only while it is in use: workers outlive stages, and other
    workers of the executor need the memory.
    """
    global _watcher
    in_use()
    if name not in _held:
        _give_back()
        _held[name] = make()
    if _watcher is None:
        _watcher = threading.Thread(target=_watch, daemon=True)
        _watcher.start()
    return _held[name]


def in_use() -> None:
    global _used
    _used = time.monotonic()


def _watch() -> None:
    while True:
        time.sleep(IDLE_SECONDS / 4)
        if _held and time.monotonic() - _used > IDLE_SECONDS:
            _give_back()


def _give_back() -> None:
    """Forget what is held (a task that works with it has its own reference) and return the memory."""
    _held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def slices(texts: Sequence[str], chars: int, rows: int) -> Iterator[tuple[int, int]]:
    """Cut a batch into ranges of at most ``rows`` texts and about ``chars`` characters."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and (size + len(text) > chars or i - start >= rows):
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def field(df: DataFrame, column: str, name: str | None = None) -> T.StructField:
    """The schema entry of a column, nullable, under another name if one is given."""
    return T.StructField(name or column, df.schema[column].dataType, True)


def sample_bound(total: int, wanted: int) -> int | None:
    """Rows whose 64-bit hash is below are about ``wanted`` of ``total``; ``None`` where all are wanted."""
    return -(1 << 63) + (wanted << 64) // total if total > wanted else None


def sampled(rows: DataFrame, columns: Sequence[str], total: int, wanted: int) -> DataFrame:
    """About ``wanted`` of ``total`` rows, chosen by a 64-bit hash of ``columns``; rows that are equal in
    them count once.  All distinct rows where there are no more than wanted."""
    below = sample_bound(total, wanted)
    if below is not None:
        rows = rows.where(F.xxhash64(*columns) < F.lit(below).cast("long"))
    return rows.dropDuplicates(list(columns))


def as_text(values) -> list[str]:
    """A pandas column of texts as a list; missing values are empty texts."""
    return [v if isinstance(v, str) else "" for v in values]


def portions(
    batches: Iterator[pa.RecordBatch], text: int, size: int = 1 << 20, rows: int = 2_000
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that column ``text`` has about ``size`` bytes in each part: only so much of it
    is held as Python strings at a time."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.columns[text]), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
        low = 0
        while low < batch.num_rows:
            before = int(ends[low - 1]) if low else 0
            high = int(np.searchsorted(ends, before + size, side="right"))
            high = min(max(high, low + 1), low + rows, batch.num_rows)
            in_use()
            yield batch.slice(low, high - low)
            low = high
