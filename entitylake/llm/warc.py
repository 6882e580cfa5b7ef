"""WARC archives with revisit records, written and read by Spark's own text source.

Headers (id, digest, size) are shuffled by payload digest; of equal payloads the record with the
largest id stays a response and the others become revisits that refer to it.  Only headers meet there;
a payload moves once, when records join the decision about its digest.  Archives are text files whose lines end
with the two empty lines that part WARC records, so writing is Spark's: it survives lost tasks, any
file system will do, and files that are not compressed can be split for reading.  Every record begins with a mark unique to
its run, which no payload written with it can contain; reading splits at that mark and checks the
declared length of every block.

Defined results: a NULL payload is empty.  Payloads below ``min_bytes`` are always responses.
Records that share the largest id and the payload are all responses.  A record without id refers to others
like any record; where none of the equal payloads has an id, all are responses.  Repeated rows are records of
their own.  Other columns play no part.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.operators.linkage import even_join

MIN_BYTES = 1000
BREAK = "\r\n"
END = BREAK * 2
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def headers(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """``page_id, url, html, payload_bytes, payload_digest``."""
    html = F.coalesce(F.col(payload), F.lit(""))
    return pages.select(
        F.col(key).alias("page_id"), F.col(url).alias("url"), html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha1(F.encode(html, "UTF-8")).alias("payload_digest"),
    )


def originals(known: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The payloads, by digest and size, that several of ``headers`` share, and the id ``refers_to`` of
    their response.  Payloads none of whose records has an id are left out: nothing can refer to them."""
    light = known.select("page_id", "payload_bytes", "payload_digest")
    return (
        light.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_records"))
        .where("_records > 1 and refers_to is not null")
        .drop("_records")
    )


def resolved(known: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``headers`` with ``record_type`` and ``refers_to``, a row per row."""
    keys = ["payload_digest", "payload_bytes"]
    joined = even_join(known, originals(known, min_bytes), keys, "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return joined.select(
        *known.columns, F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("refers_to")).alias("refers_to"),
    )


def _record_id(run: str, key) -> object:
    return F.concat(F.lit(f"<urn:x-run:{run}:"), F.coalesce(key.cast("string"), F.lit("none")), F.lit(">"))


def write_archives(
    records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", run: str | None = None,
    compression: str = "gzip",
) -> str:
    """Write records as WARC 1.1 and return the run's mark, which :func:`read_archives` needs.

    A revisit has no block; a response's block is its payload.  Each partition is a file; compressed
    files are read by one task each, those of ``compression="none"`` by several.
    """
    run = run or uuid.uuid4().hex
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, F.lit("")).otherwise(F.col("html"))

    def line(name: str, value) -> object:
        return F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))

    clean = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    known = F.concat(
        F.lit(f"WARC/1.1{BREAK}"),
        line("WARC-Record-ID", _record_id(run, F.col("page_id"))),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", clean),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Refers-To", _record_id(run, F.col("refers_to"))),
                line("WARC-Profile", F.lit(PROFILE)),
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    text = F.concat(known, F.lit(BREAK), block).alias("value")
    records.select(text).write.text(path, compression=compression, lineSep=END)
    return run


def read_archives(spark: SparkSession, path: str, run: str) -> DataFrame:
    """``page_id`` (text), ``record_type``, ``target``, ``digest``, ``payload_bytes``, ``refers_to``
    (text) and ``html``, NULL for revisits.  A block of the wrong length is an error."""
    mark = f"WARC/1.1{BREAK}WARC-Record-ID: <urn:x-run:{run}:"
    lines = spark.read.option("lineSep", mark).text(path).where("value != ''")
    head = F.substring_index("value", END, 1)
    block = F.expr(f"substr(value, length(substring_index(value, '{END}', 1)) + 5)")
    fields = lines.select(head.alias("head"), block.alias("block"))

    def value(name: str, pattern: str = r"([^\r\n]*)") -> object:
        return F.regexp_extract("head", rf"\r\n{re.escape(name)}: {pattern}", 1)

    def page(text) -> object:
        return F.nullif(text, F.lit("none"))

    body = F.expr(f"substr(block, 1, length(block) - {len(END)})")
    length = value("Content-Length").cast("long")
    checked = F.when(F.octet_length(body) == length, body).otherwise(
        F.raise_error(F.concat(F.lit("block of the wrong length in record "), F.col("head")))
    )
    refers = value("WARC-Refers-To", r"<urn:x-run:[0-9a-f]+:([^>]*)>")
    return fields.select(
        page(F.regexp_extract("head", r"^([^>]*)>", 1)).alias("page_id"),
        value("WARC-Type").alias("record_type"),
        value("WARC-Target-URI").alias("target"),
        value("WARC-Payload-Digest", "sha1:([0-9a-f]+)").alias("digest"),
        value("X-Payload-Length").cast("long").alias("payload_bytes"),
        F.nullif(refers, F.lit("")).alias("refers_to"),
        checked.alias("block"),
    ).select(
        "page_id", "record_type", "target", "digest", "payload_bytes", "refers_to",
        F.when(F.col("record_type") == "response", F.col("block")).alias("html"),
    )


def with_payloads(records: DataFrame) -> DataFrame:
    """Read records in which revisits carry the payload of the response they refer to."""
    keys = ["refers_to", "digest"]
    sources = records.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), "digest", F.col("html").alias("original")
    )
    referred = records.where("refers_to is not null").select(*keys).distinct()
    sources = even_join(sources, referred, keys, "left_semi").dropDuplicates(keys)
    joined = even_join(records, sources, keys, "left")
    return joined.withColumn("html", F.coalesce("html", "original")).drop("original")
