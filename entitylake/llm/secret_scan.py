"""Secrets in texts: three exact patterns, and random strings told apart by Markov models.

Everything here is DataFrame functions.  A pattern's matches and the gaps between them come from
``regexp_extract_all`` and ``split``, which find the same matches; summed lengths give positions.

The models are order-one character models of random strings and of ordinary identifiers.  Labelled
samples come from the texts themselves: values the patterns found are random strings, tokens of
letters outside them are identifiers.  Candidates are tokens of at least ``MIN_TOKEN`` characters
with a digit and a letter, scored by the mean log-likelihood ratio per character; those above
``threshold`` are spans of kind ``markov``.  The models are two tables of transition counts over a
fixed alphabet, summed by Spark; the driver gets one weight per pair of characters.

Defined results: a NULL text is empty and has no span.  Positions are code points, ends exclusive.
Spans are ordered by start, then kind in the order of ``KINDS``, then end; spans of different kinds
may overlap, those of one kind do not.  Without any labelled sample nothing is added to the patterns'
spans.  Repeated rows get equal results; other columns are untouched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the three exact kinds.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6
KINDS = ("assign", "access", "hex", "markov")

MIN_TOKEN = 20
TOKEN = rf"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}"
IDENTIFIER = r"[A-Za-z_]{8,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
THRESHOLD = 1.0
_BLOCK = 256


def _matches(text: Column, pattern: str) -> tuple[Column, Column]:
    """All matches of a pattern, and the pieces of text before, between and after them."""
    found = F.when(text.rlike(pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    gaps = F.when(text.rlike(pattern), F.split(text, pattern, -1))
    return F.coalesce(found, F.array().cast("array<string>")), gaps


def _running(steps: Column) -> Column:
    """Running sums before each element; cut into blocks, so that long arrays are not copied often."""

    def sums(values: Column, start: Column) -> Column:
        return F.aggregate(
            values,
            F.struct(start.alias("at"), F.array().cast("array<long>").alias("sums")),
            lambda acc, x: F.struct(
                (acc["at"] + x).alias("at"), F.concat(acc["sums"], F.array(acc["at"])).alias("sums")
            ),
            lambda acc: acc["sums"],
        )

    zero = F.lit(0).cast("long")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)),
    )
    starts = sums(
        F.transform(blocks, lambda block: F.aggregate(block, zero, lambda acc, x: acc + x)), zero
    )
    joined = F.flatten(F.zip_with(blocks, starts, sums))
    return F.when(F.size(steps) > 0, joined).otherwise(F.array().cast("array<long>"))


def _spans(matches: Column, gaps: Column, kind: int) -> Column:
    """``start, kind, end, match`` of each match."""
    sizes = F.transform(matches, lambda m: F.length(m).cast("long"))
    before = F.transform(F.slice(gaps, 1, F.size(matches)), lambda g: F.length(g).cast("long"))
    # the start of match i: all gaps up to it and all matches before it
    steps = F.zip_with(before, sizes, lambda g, m: g + m)
    placed = F.zip_with(_running(steps), F.arrays_zip(before.alias("g"), matches.alias("m")),
                        lambda at, x: F.struct(
                            (at + x["g"]).alias("start"), F.lit(kind).alias("kind"),
                            (at + x["g"] + F.length(x["m"])).alias("end"), x["m"].alias("match")))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,match:string>>")
    return F.when(F.size(matches) > 0, placed).otherwise(empty)


def assigned_value(match: Column) -> Column:
    return F.regexp_extract(match, ASSIGN, 2)


def with_base_spans(documents: DataFrame, text: str = "text") -> DataFrame:
    """Adds an array ``_assign``, ``_access``, ``_hex`` of spans each, and ``_text`` without NULL."""
    known = documents.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX)):
        found, gaps = _matches(F.col("_text"), pattern)
        known = known.withColumn("_found", found).withColumn("_gaps", gaps)
        spans = _spans(F.col("_found"), F.col("_gaps"), KINDS.index(name))
        if name == "assign":
            spans = F.filter(
                spans, lambda s: F.length(assigned_value(s["match"])) >= ASSIGN_VALUE
            )
        known = known.withColumn(f"_{name}", spans)
    return known.drop("_found", "_gaps")


# --- Markov models -------------------------------------------------------------------------------


@dataclass(frozen=True)
class MarkovModel:
    """Log-likelihood ratios, random over identifier, per pair of characters, row by row.

    The last row and column stand for characters outside the alphabet.
    """

    weights: tuple[float, ...]

    @property
    def size(self) -> int:
        return len(ALPHABET) + 1


def train(documents: DataFrame, text: str = "text") -> MarkovModel:
    """Transition counts of both classes over all documents, each smoothed by one.  Starts a job.

    The patterns label every token.  Secrets may be rare, so no row is left out; equal tokens are
    counted before they are cut into pairs, and the driver gets at most two tables of counts.
    """
    known = with_base_spans(documents.select(F.col(text).alias("text")))
    values = F.concat(
        F.transform("_assign", lambda s: assigned_value(s["match"])),
        F.transform("_access", lambda s: s["match"]),
        F.transform("_hex", lambda s: s["match"]),
    )
    rest = F.regexp_replace(
        F.regexp_replace(F.regexp_replace("_text", ASSIGN, " "), ACCESS, " "), HEX, " "
    )
    words = F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))
    samples = known.select(
        F.explode(
            F.concat(
                F.transform(values, lambda v: F.struct(F.lit(1).alias("random"), v.alias("token"))),
                F.transform(words, lambda v: F.struct(F.lit(0).alias("random"), v.alias("token"))),
            )
        ).alias("sample")
    ).select("sample.random", "sample.token")
    tokens = samples.groupBy("random", "token").agg(F.count(F.lit(1)).alias("n"))
    pairs = tokens.where(F.length("token") > 1).select(
        "random", "n",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substring("token", i, 2)
            )
        ).alias("pair"),
    )
    counts = pairs.groupBy("random", _code(F.substring("pair", 1, 1)).alias("first"),
                           _code(F.substring("pair", 2, 1)).alias("second"))
    size = len(ALPHABET) + 1
    table = {r[:3]: r[3] for r in map(tuple, counts.agg(F.sum("n").alias("n")).collect())}
    if {r for r, _, _ in table} != {0, 1}:
        return MarkovModel((-1e9,) * size * size)
    weights = []
    for first in range(size):
        total = [sum(table.get((r, first, s), 0) for s in range(size)) + size for r in (0, 1)]
        for second in range(size):
            ordinary, random = (
                math.log((table.get((r, first, second), 0) + 1) / total[r]) for r in (0, 1)
            )
            weights.append(round(random - ordinary, 6))
    return MarkovModel(tuple(weights))


def _code(character: Column) -> Column:
    """0-based place in the alphabet, its size for any other character."""
    place = F.instr(F.lit(ALPHABET), character)
    return F.when(place > 0, place - 1).otherwise(F.lit(len(ALPHABET)))


def log_ratio(token: Column, model: MarkovModel) -> Column:
    """Mean log-likelihood ratio per transition of a token of two or more characters."""
    # a literal after constant folding
    weights = F.split(F.lit(",".join(map(str, model.weights))), ",").cast("array<double>")
    size = model.size
    codes = F.transform(
        F.sequence(F.lit(1), F.length(token)), lambda i: _code(F.substring(token, i, 1))
    )
    scored = F.aggregate(
        codes,
        F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.struct(
            c.alias("last"),
            (acc["sum"] + F.when(acc["last"] < 0, F.lit(0.0)).otherwise(
                F.get(weights, acc["last"] * size + c))).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    return scored / (F.length(token) - 1)


def scan(
    documents: DataFrame, model: MarkovModel, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """All columns of ``documents`` and a column ``secrets``: spans ``start, kind, end``.

    ``kind`` is a place in ``KINDS``.  Columns of the names used in between are kept apart; one named
    ``secrets`` is replaced.
    """
    packed = documents.select(F.struct("*").alias("_row"), F.col(text).alias("_source"))
    known = with_base_spans(packed, "_source")
    likely = rf"(?<![A-Za-z0-9+/_=-]){TOKEN}"
    found, gaps = _matches(F.col("_text"), likely)
    known = known.withColumn("_found", found).withColumn("_gaps", gaps)
    known = known.withColumn("_tokens", _spans(F.col("_found"), F.col("_gaps"), 3))
    random = F.filter(
        "_tokens",
        lambda s: F.when(
            s["match"].rlike("[0-9]") & s["match"].rlike("[A-Za-z]"),
            log_ratio(s["match"], model) > threshold,
        ).otherwise(False),
    )
    spans = F.concat("_assign", "_access", "_hex", random)
    bare = F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"]))
    own = [F.col("_row").getField(c).alias(c) for c in documents.columns if c != "secrets"]
    return known.select(*own, F.array_sort(bare).alias("secrets"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redact(documents: DataFrame, text: str = "text", secrets: str = "secrets",
           mark: str = "[SECRET]") -> DataFrame:
    """``documents`` with every span of ``secrets`` in ``text`` replaced by ``mark``.

    Overlapping spans are replaced as one.  A NULL text stays NULL.  The texts between the spans are
    cut from the rest of the text left to right.
    """
    start = F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))
    merged = F.aggregate(
        F.col(secrets),
        F.struct(F.array().cast("array<struct<start:bigint,end:bigint>>").alias("done"),
                 start.alias("last")),
        lambda acc, s: F.when(
            s["start"] < acc["last"]["end"],
            F.struct(acc["done"].alias("done"), F.struct(
                acc["last"]["start"].alias("start"),
                F.greatest(acc["last"]["end"], s["end"]).alias("end")).alias("last")),
        ).otherwise(
            F.struct(F.concat(acc["done"], F.array(acc["last"])).alias("done"), F.struct(
                s["start"].alias("start"), s["end"].alias("end")).alias("last")),
        ),
        lambda acc: F.concat(acc["done"], F.array(acc["last"])),
    )
    source = F.col(text)
    ends = F.transform(merged, lambda s: s["end"])
    starts = F.transform(merged, lambda s: s["start"])
    after = F.zip_with(
        ends, F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.length(source).cast("long"))),
        lambda a, b: F.substring(source, (a + 1).cast("int"), (b - a).cast("int")),
    )
    return documents.withColumn(
        text, F.when(F.size(secrets) > 0, F.array_join(after, mark)).otherwise(source)
    )
