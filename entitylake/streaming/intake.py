"""Landing-folder intake as a file stream.

The checkpoint remembers which files were consumed, ``maxFilesPerTrigger`` is the chunk size and
``cleanSource`` moves consumed files away.  The transforms are the batch ones.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from entitylake.sources.documents import CORRUPT, reader_mode


def document_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    chunk_size: int | None = None,
    archive: str | None = None,
    layout: str = "multiline",
    malformed: str = "fail",
) -> DataFrame:
    """New files of ``folder`` as a streaming frame, at most ``chunk_size`` files per batch.

    With ``archive`` consumed files are moved there; those of the latest batch follow when a later
    batch has been committed.  The archive must not lie inside ``folder``.  ``malformed`` is as for
    reading in batch: input that is not JSON stops the stream, is left out, or comes as a row with
    its text in ``_corrupt_record``.
    """
    mode, expected = reader_mode(malformed, schema)
    reader = (
        spark.readStream.schema(expected)
        .option("multiLine", layout == "multiline")
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if chunk_size is not None:
        reader = reader.option("maxFilesPerTrigger", chunk_size)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(folder)


def append_available(
    rows: DataFrame, target: str, checkpoint: str, wait: bool = True
) -> StreamingQuery:
    """Append everything that has arrived to a Parquet dataset, exactly once, then stop.

    For transforms without aggregation: flatten, melt, filter, de-identify, join with tables.
    """
    query = (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query


def each_batch(
    docs: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    wait: bool = True,
) -> StreamingQuery:
    """Apply any batch transform to every batch of documents: pivots and joins included.

    Batch ``n`` goes to ``<target>/run=<id>/batch=<n>`` and replaces what an interrupted attempt left
    there, so a batch that runs twice is stored once.  The id is the checkpoint's: streams with
    checkpoints of their own can share a target.  Values are linked within their batch only.
    """

    def store(batch: DataFrame, number: int) -> None:
        (metadata,) = batch.sparkSession.read.text(f"{checkpoint}/metadata").collect()
        run = json.loads(metadata.value)["id"]
        path = f"{target}/run={run}/batch={number}"
        transform(batch).write.mode("overwrite").parquet(path)

    query = (
        docs.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query
