"""Quality rules: a table of thresholds compiled into one projection.

A rule is a ratio of two counts of a text with a range. :data:`RULES` is the table; the counts of a text
are built-in functions of it, and the verdict is one boolean expression. No shuffle, no user function.

Defined results: a NULL text is an empty one with all counts 0. A ratio over 0 is 0. Repeated rows get
equal results. Columns with the name of a result column are replaced; all others are kept.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 50
REPEATED_PERCENT = 50
WINDOW = 3

# Common words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that was for on with as it be are this by from or an at "
    "der die das und ist nicht ein eine zu den dem des mit von auf sich auch als "
    "le la les et est un une du que qui dans pour pas sur avec ne "
    "el los las de en y por se con su para es del al lo no"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; counts by name."""

    name: str
    numerator: str
    denominator: str
    low: float = float("-inf")
    high: float = float("inf")


RULES = (
    Rule("mean word length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols per character", "n_symbols", "word_chars", high=0.08),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=0.3),
    Rule("stop words", "n_stop_words", "n_words", low=0.03),
    Rule("exclamations per word", "n_exclamations", "n_words", high=0.5),
    Rule("capitals per character", "n_capitals", "word_chars", high=0.5),
)


def _without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def _windows(words: Column) -> Column:
    """A 64-bit hash per window of ``WINDOW`` words."""
    places = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashed = F.transform(
        places, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )
    return F.when(F.size(words) >= WINDOW, hashed).otherwise(F.array().cast("array<long>"))


def _repeated(ordered: Column) -> Column:
    """The distinct windows that occur twice or more, from all in order."""
    return F.array_distinct(
        F.filter(ordered, lambda x, i: (i > 0) & (F.get(ordered, i - 1) == x))
    )


def with_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with the counts that rules refer to.

    ``n_repeat_words``: words in a window that occurs twice or more. Repeated windows are looked up in
    buckets by hash, about as many as the square root of the text's words, which bounds the time for
    texts that repeat themselves throughout.
    """
    source = F.coalesce(F.col("_row").getField(text), F.lit(""))
    base = documents.select(F.struct("*").alias("_row")).select("_row", source.alias("_text"))
    words = base.select(
        "_row", "_text",
        F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)).alias("_words"),
        F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD)).alias("_lines"),
    )
    # what a lambda uses is a column of its own before it, or it would be made for every element
    windows = words.withColumn("_windows", _windows(F.col("_words")))
    ordered = windows.withColumn("_ordered", F.sort_array("_windows"))
    again = ordered.withColumn("_again", _repeated(F.col("_ordered")))
    again = again.withColumn(
        "_size", F.greatest(F.lit(1), F.floor(F.sqrt(F.size("_again")))).cast("int")
    )
    lists = F.transform(
        F.sequence(F.lit(0), F.col("_size") - 1),
        lambda b: F.filter("_again", lambda x: F.pmod(x, F.col("_size")) == b),
    )
    dealt = again.withColumn("_buckets", F.when(F.size("_again") > 0, lists))
    flags = F.transform(
        "_windows",
        lambda x: F.array_contains(F.get("_buckets", F.pmod(x, F.col("_size")).cast("int")), x),
    )
    flagged = dealt.withColumn("_flags", F.when(F.size("_again") > 0, flags))

    def covered(i: Column) -> Column:
        hits = [F.coalesce(F.get("_flags", i - k), F.lit(False)) for k in range(WINDOW)]
        return functools.reduce(Column.__or__, hits)

    n_repeat = F.when(
        F.size("_again") > 0,
        F.size(F.filter(F.sequence(F.lit(0), F.size("_words") - 1), covered)),
    ).otherwise(0)
    text_, stop = F.col("_text"), F.array(*[F.lit(w) for w in STOP_WORDS])
    size = F.length(text_)
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length(_without(text_, f"{SPACE}+")),
        "n_symbols": F.length(_without(text_, NOT_SYMBOLS)),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": n_repeat,
        "n_lines": F.size("_lines"),
        "n_stop_words": F.size(F.filter("_words", lambda w: F.array_contains(stop, F.lower(w)))),
        "n_exclamations": size - F.length(F.replace(text_, F.lit("!"), F.lit(""))),
        "n_capitals": F.length(_without(text_, r"\P{Lu}+")),
    }
    return flagged.select(
        *[F.col("_row").getField(n).alias(n) for n in documents.columns if n not in counts],
        *[c.cast("long").alias(n) for n, c in counts.items()],
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")
    )


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where every rule of the table holds."""

    def holds(rule: Rule) -> Column:
        below = F.col(rule.denominator)
        ratio = F.when(below > 0, F.col(rule.numerator) / below).otherwise(F.lit(0.0))
        tests = [F.lit(True)]
        if rule.low != float("-inf"):
            tests.append(ratio >= rule.low)
        if rule.high != float("inf"):
            tests.append(ratio <= rule.high)
        return functools.reduce(Column.__and__, tests)

    return functools.reduce(Column.__and__, map(holds, rules))


def assessed(
    documents: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``documents`` with all counts, ``base_failed`` and ``kept``."""
    counted = with_counts(documents, text).withColumn("base_failed", base_failed())
    return counted.withColumn("kept", ~F.col("base_failed") & compiled(rules))
