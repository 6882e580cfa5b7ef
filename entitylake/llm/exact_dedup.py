"""Exact deduplication with a grace hash table.

Every input partition first folds its copies in an open-addressing table that compares complete
contents, so that a text with any number of copies leaves a partition once (or once per full table).
Contents are then shuffled by digest.  A partition that does not fit the table's budget is cut by
further bits of the hash into spill files, and these again, until each piece fits; the files live in
the task's temporary folder and go with it.  Only the decision per text, not its list of members,
leaves the table; rows find their decision by a join on the digest.

Defined results: two texts are equal when they are identical without the characters
``[\\x20\\x09-\\x0D]``; NULL is an empty text.  Of equal texts the row with the most code points in the
original stays, among these the smallest id (a NULL id comes last).  Just one row of a group stays: of
rows that share its id and its number of code points, any one.  Other columns play no part.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import shutil
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from entitylake.llm.common import field, portions
from entitylake.operators.linkage import even_join

SPACE = b" \t\n\x0b\x0c\r"
TABLE_BYTES = 48 << 20
FAN_OUT = 16
MAX_DEPTH = 12
ENTRY_BYTES = 400  # assumed for an entry's objects, beside its content
BATCH_BYTES = 8 << 20


class OpenTable:
    """Contents in slots found by linear probing; equal only if all bytes are equal.

    An entry is ``[digest, content, best, rows]``, ``best`` being the smallest
    ``(-code points, id is missing, id)`` so far.
    """

    def __init__(self) -> None:
        self.slots = np.full(1 << 10, -1, np.int64)
        self.entries: list[list] = []
        self.bytes = 0

    def add(self, digest: bytes, content: bytes, best: tuple, rows: int) -> None:
        slot = self._slot(digest, content)
        at = self.slots[slot]
        if at >= 0:
            entry = self.entries[at]
            entry[2] = min(entry[2], best)
            entry[3] += rows
            return
        self.slots[slot] = len(self.entries)
        self.entries.append([digest, content, best, rows])
        self.bytes += len(content) + ENTRY_BYTES
        if 2 * len(self.entries) > len(self.slots):
            self._grow()

    def _slot(self, digest: bytes, content: bytes) -> int:
        mask = len(self.slots) - 1
        slot = int.from_bytes(digest[8:16], "little") & mask
        while (at := self.slots[slot]) >= 0:
            entry = self.entries[at]
            if entry[0] == digest and entry[1] == content:
                break
            slot = (slot + 1) & mask
        return slot

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for at, entry in enumerate(self.entries):
            slot = int.from_bytes(entry[0][8:16], "little") & mask
            while self.slots[slot] >= 0:
                slot = (slot + 1) & mask
            self.slots[slot] = at


def grace(
    records: Iterator[tuple], table_bytes: int = TABLE_BYTES, folder: str | None = None, depth: int = 0
) -> Iterator[list]:
    """Fold ``(digest, content, best, rows)`` records; memory stays within the budget of one table.

    When the table is full it and all further records go to ``FAN_OUT`` files by the digest's next
    four bits, each of which is folded in turn.  Equal contents meet in one file.  At ``MAX_DEPTH``
    all contents left share 48 bits of a SHA-256, which only copies do.
    """
    table = OpenTable()
    for record in records:
        table.add(*record)
        if table.bytes > table_bytes and len(table.entries) > 1 and depth < MAX_DEPTH:
            break
    else:
        yield from table.entries
        return
    place = tempfile.mkdtemp(prefix="grace-", dir=folder)
    try:
        paths = [os.path.join(place, f"{i:02d}") for i in range(FAN_OUT)]
        files = [open(p, "wb") for p in paths]  # noqa: SIM115
        try:
            for source in (table.entries, records):
                for record in source:
                    pickle.dump(tuple(record), files[_branch(record[0], depth)], protocol=5)
        finally:
            for file in files:
                file.close()
        del table
        for path in paths:
            yield from grace(_read(path), table_bytes, place, depth + 1)
            os.remove(path)
    finally:
        shutil.rmtree(place, ignore_errors=True)


def _branch(digest: bytes, depth: int) -> int:
    return digest[16 + depth // 2] >> (4 * (depth % 2)) & 15


def _read(path: str) -> Iterator[tuple]:
    with open(path, "rb") as file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def text_digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(F.encode(normalised(text), "UTF-8"), 256)


def groups(
    documents: DataFrame, key: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES
) -> DataFrame:
    """One row per distinct text: ``text_sha256``, ``keep_id``, ``keep_chars`` (code points of the row that
    stays), ``group_size``."""
    named = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    entry = T.StructType(
        [
            T.StructField("digest", T.BinaryType()),
            T.StructField("content", T.BinaryType()),
            T.StructField("chars", T.LongType()),
            field(named, "id"),
            T.StructField("members", T.LongType()),
        ]
    )
    result = T.StructType(
        [
            T.StructField("text_sha256", T.StringType()),
            field(named, "id", "keep_id"),
            T.StructField("keep_chars", T.LongType()),
            T.StructField("group_size", T.LongType()),
        ]
    )

    folded_schema, result_schema = to_arrow_schema(entry), to_arrow_schema(result)

    def local(batches):
        table = OpenTable()
        for part in portions(batches, 1):
            for key_, text_ in zip(*(c.to_pylist() for c in part.columns)):
                text_ = text_ or ""
                content = text_.encode("utf-8", "surrogatepass").translate(None, SPACE)
                best = (-len(text_), key_ is None, key_)
                table.add(hashlib.sha256(content).digest(), content, best, 1)
                if table.bytes > table_bytes:
                    yield from _batches(_entry_rows(table.entries), folded_schema)
                    table = OpenTable()
        yield from _batches(_entry_rows(table.entries), folded_schema)

    def final(batches):
        records = (
            (digest, content, (-chars, id_ is None, id_), members)
            for batch in portions(batches, 1)
            for digest, content, chars, id_, members in zip(*(c.to_pylist() for c in batch.columns))
        )
        found = ((d.hex(), best[2], -best[0], n) for d, _, best, n in grace(records, table_bytes))
        yield from _batches(found, result_schema)

    folded = named.mapInArrow(local, entry)
    return folded.repartition("digest").mapInArrow(final, result)


def _entry_rows(entries: list[list]) -> Iterator[tuple]:
    return ((d, content, -best[0], best[2], n) for d, content, best, n in entries)


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, bytes))
        if size > BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def exact_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES
) -> DataFrame:
    """A row per row of ``documents``: the id as ``doc_id``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``."""
    found = groups(documents, key, text, table_bytes)
    rows = documents.select(
        F.col(key).alias("doc_id"), text_digest(F.col(text)).alias("text_sha256"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("chars"),
    )
    joined = even_join(rows, found, ["text_sha256"])
    best = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    # rows that are alike are counted, whatever their number, and one of the best is kept
    columns = ["doc_id", "keep_id", "group_size", "text_sha256", "best"]
    alike = joined.withColumn("best", best).groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    each = alike.select(*columns, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    kept = F.col("best") & (F.col("copy") == 1)
    return each.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
