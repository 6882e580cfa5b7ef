"""Run audit: one row per run, in a table."""

from __future__ import annotations

import datetime as dt
import os
import traceback
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from entitylake.sources.sinks import sized

# The fields of an audit record.
AUDIT_SCHEMA = (
    "job_name string, job_id string, job_run_id string, job_start_time string, "
    "src_obj_name string, tgt_obj_name string, src_rec_count bigint, tgt_rec_count bigint, "
    "error_type string, error_message string, error_obj_name string, error_obj_loc string, "
    "flag string"
)


def audit_row(
    spark: SparkSession,
    job_name: str,
    job_id: str,
    started: str,
    source_name: str = "",
    target_name: str = "",
    source_count: int = 0,
    target_count: int = 0,
    error: BaseException | None = None,
    run_id: str = "",
) -> DataFrame:
    """``SUCCESS`` with names and counts, or ``FAIL`` with the error and neither.

    Of an error the function and the file and line that raised it are recorded.
    """
    if error is None:
        row = (source_name, target_name, source_count, target_count, "", "", "", "", "SUCCESS")
    else:
        frames = traceback.extract_tb(error.__traceback__)
        name = frames[-1].name if frames else ""
        place = f"{os.path.basename(frames[-1].filename)}:{frames[-1].lineno}" if frames else ""
        row = ("", "", 0, 0, type(error).__name__, str(error), name, place, "FAIL")
    return spark.createDataFrame([(job_name, job_id, run_id, started, *row)], AUDIT_SCHEMA)


def audited_write(
    source: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    audit_path: str,
    job_name: str,
    job_id: str = "",
    source_name: str = "",
    target_name: str | None = None,
    started: str | None = None,
    mode: str = "append",
    target_files: int | None = None,
    run_id: str = "",
) -> None:
    """Write ``transform(source)`` to ``target`` and append the run's audit row to ``audit_path``.

    A failure is recorded and raised.  Target rows are counted while they are written, behind the
    last shuffle, where a task that runs again is not counted twice.  Source rows pass through
    shuffles, whose tasks may be repeated after a lost executor, so they are counted on their own
    and before: for Parquet that reads file footers only.  Once the target is committed nothing turns
    the run into a failure, so a retry never stores its rows twice.
    """
    spark = source.sparkSession
    started = started or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    counted = Observation()
    try:
        source_count = source.count()
        rows = sized(transform(source), target_files).observe(
            counted, F.count(F.lit(1)).alias("rows")
        )
        rows.write.mode(mode).parquet(target)
    except Exception as error:
        failure = audit_row(spark, job_name, job_id, started, error=error, run_id=run_id)
        failure.write.mode("append").parquet(audit_path)
        raise
    entry = audit_row(
        spark, job_name, job_id, started, source_name,
        target if target_name is None else target_name, source_count, counted.get["rows"],
        run_id=run_id,
    )
    entry.write.mode("append").parquet(audit_path)
