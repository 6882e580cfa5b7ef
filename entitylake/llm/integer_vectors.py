"""Vectors as rows of small integers: what the operators on embeddings share."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entitylake.llm.common import field
from entitylake.sources.scratch import staged

_LIMIT = 1 << 52  # larger numbers are not integers of their own in double precision


@dataclass(frozen=True)
class IntegerVectors:
    """``table`` has ``row`` (a number of its own), the asked columns and ``numbers``.

    ``numbers`` holds ``dims`` little-endian integers of type ``kind``.
    """

    table: DataFrame
    rows: int
    dims: int
    kind: str

    @property
    def read(self) -> Callable[[pa.Array], np.ndarray]:
        """Makes a matrix of a column of ``numbers``; can be sent to the executors."""
        return functools.partial(matrix, dims=self.dims, kind=self.kind)


def usable(vector: Column) -> Column:
    """True where a vector is there and all its entries are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def integer_vectors(
    rows: DataFrame, vector: str, scale: int, columns: dict[str, Column], same_length: bool
) -> IntegerVectors:
    """Entry ``x`` of each usable vector as ``floor(scale * x)``, with ``columns`` beside it.

    Vectors of another length than most are left out with ``same_length`` (of equally frequent lengths
    the largest counts), else filled up with zeros.  Starts a job, which finds lengths and the largest
    entry, and writes the table once; both read no more than the vector and ``columns``.  An entry that
    is no exact integer in double precision after scaling is an error.
    """
    values = F.col(vector).cast("array<double>")
    found = rows.select(values.alias("_vector"), *[c.alias(n) for n, c in columns.items()])
    found = found.where(usable(F.col("_vector")))
    sizes = found.groupBy(F.size("_vector").alias("size")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.greatest(F.array_max("_vector"), -F.array_min("_vector"))).alias("largest"),
    )
    best = F.struct("rows", "size") if same_length else F.struct("size")
    total = sizes.agg(
        F.max_by(F.struct("size", "rows", "largest"), best).alias("chosen"),
        F.sum("rows").alias("rows"), F.max("largest").alias("largest"),
    ).first()
    count, dims, largest = 0, 0, 0.0
    if total["chosen"] is not None:
        chosen = total["chosen"] if same_length else total
        count, dims, largest = chosen["rows"], total["chosen"]["size"], chosen["largest"] or 0.0
    if largest * scale >= _LIMIT:
        raise ValueError(f"an entry of {largest} is too large to be scaled by {scale}")
    if same_length:
        found = found.where(F.size("_vector") == dims)
    kind = next(k for k in ("<i2", "<i4", "<i8") if largest * scale + 1 <= np.iinfo(k).max)

    names = [*columns, "numbers"]

    def rounded(batches):
        for batch in batches:
            lists = batch.columns[0]
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            numbers = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
            whole = np.zeros((len(sizes), dims), kind)
            whole[np.arange(dims) < sizes[:, None]] = np.floor(scale * numbers)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], _as_binary(whole)], names=names
            )

    schema = T.StructType(
        [*[field(found, n) for n in columns], T.StructField("numbers", T.BinaryType())]
    )
    table = found.mapInArrow(rounded, schema)
    table = staged(table.withColumn("row", F.monotonically_increasing_id()), "vectors")
    return IntegerVectors(table, count, dims, kind)


def _as_binary(whole: np.ndarray) -> pa.Array:
    width = whole.shape[1] * whole.itemsize
    if not width:
        return pa.array([b""] * len(whole), pa.binary())
    parts = [None, pa.py_buffer(np.ascontiguousarray(whole))]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(whole), parts).cast(pa.binary())


def matrix(column: pa.Array, dims: int, kind: str) -> np.ndarray:
    """A column of ``numbers`` as a matrix; the numbers are not copied."""
    width = dims * np.dtype(kind).itemsize
    if not width or not len(column):
        return np.zeros((len(column), dims), kind)
    fixed = column.cast(pa.binary(width))
    numbers = np.frombuffer(fixed.buffers()[1], kind, count=(fixed.offset + len(fixed)) * dims)
    return numbers.reshape(-1, dims)[fixed.offset :]
