"""Which long texts contain which passages, for any number of passages of any lengths.

A passage that a text contains brings its inner words along, whole and in order; only its first and last
word may be parts of longer ones.  So each passage is looked up by one run of inner words, the rarest
that it has: the frequencies of all its runs among the texts are counted first, and a passage with a
run that no text has is out.  Texts that have the passage's rarest run are candidates, and ``contains``
decides.  The work is one pass over the words of the texts, whatever the lengths of the passages; what
is shuffled is 16 bytes per run that texts share with passages, and the texts of candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylake.functions.membership import membership
from entitylake.operators.linkage import even_join, substring_links
from entitylake.sources.scratch import staged

RUN = 3  # words
_GAP = r"[\x20\x09-\x0D]+"


def _runs(words: Column, size: int) -> Column:
    """A hash per run of ``size`` consecutive words, each once."""

    def of(hashes: Column) -> Column:
        count = F.size(hashes) - (size - 1)
        starts = F.when(count > 0, F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1))
        return F.transform(
            F.coalesce(starts, F.array().cast("array<int>")),
            lambda i: F.xxhash64(*[F.get(hashes, i + n) for n in range(size)]),
        )

    # an array of one array: words are hashed once, not for each run
    hashed = F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), of)
    return F.array_distinct(F.flatten(hashed))


def _inner_words(text: Column) -> Column:
    words = F.split(text, _GAP)
    return F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0)))


def prose_links(
    haystacks: DataFrame, needles: DataFrame, haystack: str, needle: str, run: int = RUN
) -> DataFrame:
    """Haystack rows with each distinct needle they contain as ``gram``, once per row and needle.

    Exact for any text.  Needles with fewer than ``run`` inner words are matched by
    :func:`~entitylake.operators.linkage.substring_links` instead, as identifiers are.  An empty needle
    is in every haystack; NULL matches nothing.  Starts jobs: needles, their runs and the runs found are
    written once.
    """
    texts = needles.select(F.col(needle).alias("gram")).where(F.col("gram").isNotNull()).distinct()
    known = staged(texts.withColumn("_needle", F.monotonically_increasing_id()), "needles")
    long = F.size(_inner_words(F.col("gram"))) >= run
    links = _by_rarest_run(haystacks, known.where(long), haystack, run)
    short = known.where(~long).select("gram")
    if not short.isEmpty():
        rest = substring_links(haystacks, short.withColumnRenamed("gram", "_short"), haystack, "_short")
        links = links.unionByName(rest)
    return links


def _by_rarest_run(haystacks: DataFrame, known: DataFrame, haystack: str, run: int) -> DataFrame:
    runs = F.explode(_runs(_inner_words(F.col("gram")), run)).alias("_run")
    wanted = staged(known.select("_needle", runs), "needle-runs")
    distinct = wanted.select("_run").distinct()
    keep = membership(distinct, "_run", wanted.count())
    text = F.col(haystack)
    rows = haystacks.where(text.isNotNull()).withColumn("_text", F.xxhash64(text))
    present = _runs(F.split(text, _GAP), run)
    if keep is not None:
        present = F.filter(present, keep)
    found = rows.select("_text", F.explode(present).alias("_run")).distinct()
    found = staged(even_join(found, distinct, ["_run"], "left_semi"), "text-runs")
    often = found.groupBy("_run").agg(F.count(F.lit(1)).alias("_texts"))
    rarest = (
        even_join(wanted, often, ["_run"], "left")
        .groupBy("_needle")
        .agg(F.min(F.struct(F.coalesce("_texts", F.lit(0)).alias("texts"), "_run")).alias("rarest"))
        .where("rarest.texts > 0")
        .select("_needle", F.col("rarest._run").alias("_run"))
    )
    pairs = staged(even_join(found, rarest, ["_run"]).select("_text", "_needle"), "candidates")
    candidates = even_join(pairs, known, ["_needle"]).select("_text", "gram")
    likely = membership(pairs.select("_text").distinct(), "_text", pairs.count())
    if likely is not None:  # other texts need not be shuffled
        rows = rows.where(likely(F.col("_text")))
    links = even_join(rows, candidates, ["_text"]).where(text.contains(F.col("gram")))
    return links.select(*haystacks.columns, "gram")


def prose_join(
    needles: DataFrame, haystacks: DataFrame, needle: str, haystack: str, run: int = RUN
) -> DataFrame:
    """Every pair of rows in which ``haystack`` contains ``needle`` (inner, duplicates kept)."""
    clash = {c.lower() for c in needles.columns} & {c.lower() for c in haystacks.columns}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    links = prose_links(haystacks, needles, haystack, needle, run)
    pairs = even_join(links, needles.withColumn("gram", F.col(needle)), ["gram"])
    return pairs.select(*needles.columns, *haystacks.columns)
