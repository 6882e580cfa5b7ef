"""Writing results: distributed Parquet and CSV, one dataset per attribute group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def sized(df: DataFrame, target_files: int | None = None) -> DataFrame:
    """Even output files without slowing the work before them.

    ``target_files`` spreads the rows over exactly that many files by a shuffle; ``coalesce`` would
    run the whole last stage in that many tasks.  Without it adaptive execution picks the number
    from the data volume and splits oversized partitions.
    """
    if target_files is None:
        return df.hint("rebalance")
    if target_files < 1:
        raise ValueError("target_files must be positive")
    return df.repartition(target_files)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "append",
    target_files: int | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Append (or, to start afresh, ``overwrite``) a Parquet dataset."""
    sized(df, target_files).write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    target_files: int | None = None,
    null_value: str = "",
) -> None:
    """CSV with header, written by the executors, without an index column.

    NULL is written as ``null_value``.  Spark's reader takes blank and empty text both for NULL, so
    another marker, given to the reader as well, is needed where the two have to differ.
    """
    writer = sized(df, target_files).write.mode(mode).option("header", True)
    writer.option("escape", '"').option("nullValue", null_value).csv(path)


def write_groups(
    frames: Mapping[str, DataFrame],
    base: str,
    mode: str = "append",
    target_files: int | None = None,
    probes: Mapping[str, DataFrame] | None = None,
) -> list[str]:
    """One dataset per group below ``base``; empty groups are skipped.  Returns the names written.

    Emptiness is asked of ``probes[group]`` where given: a cheap frame that is empty whenever the
    group is, so that the group itself is computed only to be written.
    """
    written = []
    for group, df in frames.items():
        probe = (probes or {}).get(group, df)
        if probe.isEmpty():
            continue
        write_parquet(df, f"{base}/{group}", mode, target_files)
        written.append(group)
    return written


def write_tagged(
    rows: DataFrame, base: str, groups: Sequence[str], tag: str = "attribute_group", keep: bool = True
) -> dict[str, int]:
    """One dataset per group below ``base``, as ``<tag>=<group>``, in a single job.

    Returns the number of rows written for each of ``groups``, counted in that job; a group without
    rows gets no dataset.  With ``keep`` rows are appended, else the groups that have rows are replaced
    and the others stay.  Rows of other groups, or without one, are an error.
    """
    if len(set(groups)) != len(groups):
        raise ValueError("groups must be distinct")
    column = F.col(tag)
    known = F.coalesce(column.isin(list(groups)), F.lit(False))
    refused = F.raise_error(F.concat(F.lit(f"unknown {tag}: "), F.coalesce(column, F.lit("NULL"))))
    checked = rows.withColumn(tag, F.when(known, column).otherwise(refused.cast("string")))
    counts = Observation()
    counted = checked.hint("rebalance", tag).observe(
        counts, *[F.count_if(column == g).alias(f"n{i}") for i, g in enumerate(groups)]
    )
    writer = counted.write.partitionBy(tag).mode("append" if keep else "overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(base)
    return {g: counts.get[f"n{i}"] or 0 for i, g in enumerate(groups)}
