"""Reading entity documents."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from entitylake.functions.paths import find_field
from entitylake.sources.scratch import staged

CORRUPT = "_corrupt_record"
_MODES = {"fail": "FAILFAST", "drop": "DROPMALFORMED", "quarantine": "PERMISSIVE"}


def narrow_schema(schema: StructType, paths: Iterable[str]) -> StructType:
    """Only the fields the paths lead to, with everything below them.

    Given to the reader it prunes JSON while parsing, and Parquet also where expressions inside
    arrays keep Catalyst from seeing which fields are used.
    """
    wanted = [p.split(".") for p in paths]

    def prune(kind: DataType, tails: list[list[str]]) -> DataType:
        if any(not t for t in tails):
            return kind
        if isinstance(kind, ArrayType):
            return ArrayType(prune(kind.elementType, tails), kind.containsNull)
        if not isinstance(kind, StructType):
            return kind
        return keep(kind, tails)

    def keep(struct: StructType, tails: list[list[str]]) -> StructType:
        fields = []
        for field in struct.fields:
            below = [t[1:] for t in tails if t[0].lower() == field.name.lower()]
            if below:
                fields.append(
                    StructField(field.name, prune(field.dataType, below), field.nullable)
                )
        return StructType(fields)

    for path in wanted:
        if find_field(schema, path[0]) is None:
            raise ValueError(f"no column '{path[0]}'")
    return keep(schema, wanted)


def reader_mode(
    malformed: str, schema: StructType | None
) -> tuple[str, StructType | None]:
    """Spark's mode for ``malformed``, and the schema with a place for broken text if that is kept."""
    if malformed not in _MODES:
        raise ValueError(f"malformed must be one of {sorted(_MODES)}, not '{malformed}'")
    if malformed == "quarantine" and schema is not None and find_field(schema, CORRUPT) is None:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return _MODES[malformed], schema


def read_documents(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str | None = None,
    layout: str = "multiline",
    malformed: str = "fail",
) -> DataFrame:
    """Entity documents from a file, a folder or a list of them, as one frame.

    ``layout``: ``multiline`` (a file holds one JSON document or an array of them), ``lines`` (one
    document per line) or ``parquet``.  Multi-line files cannot be split, so large input is better
    kept as lines or Parquet.

    ``malformed``: ``fail``; ``drop`` (a broken multi-line file is dropped whole); ``quarantine``,
    which keeps the text of broken input in ``_corrupt_record``.

    Without ``schema`` Spark infers one with an extra pass over the input.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    mode, expected = reader_mode(malformed, schema)
    paths = paths if isinstance(paths, str) else list(paths)
    if layout == "parquet":
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(*([paths] if isinstance(paths, str) else paths))
    if layout not in ("multiline", "lines"):
        raise ValueError(f"layout must be 'multiline', 'lines' or 'parquet', not '{layout}'")
    reader = spark.read.option("mode", mode).option("multiLine", layout == "multiline")
    if malformed == "quarantine":
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if expected is not None:
        reader = reader.schema(expected)
    return reader.json(paths)


def split_quarantine(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good documents, and the broken ones with their text and ``source_file``.

    Starts a job: the broken documents, and only they, are written to the shared folder.  The good
    ones are read when they are used; select a column of theirs, since Spark does not read the corrupt
    text of raw files alone.
    """
    if find_field(docs.schema, CORRUPT) is None:
        empty = docs.sparkSession.createDataFrame([], f"{CORRUPT} string, source_file string")
        return docs, empty
    broken = docs.where(F.col(CORRUPT).isNotNull()).withColumn("source_file", F.input_file_name())
    return docs.where(F.col(CORRUPT).isNull()).drop(CORRUPT), staged(broken, "quarantine")
