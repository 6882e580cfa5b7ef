"""Connected components of an edge table, by joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylake.operators.linkage import even_join
from entitylake.sources.scratch import staged


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``id, component`` for every end of ``a, b``: the smallest id in its component.

    Each round takes the smallest label among a vertex and its neighbours, then that label's own
    label, so that chains halve.  Minima are pre-aggregated and joins can be split, so a vertex with
    any number of edges is harmless.  Labels are staged after every round; only a count of changes
    reaches the driver.  Without edges the result is empty.
    """
    both = staged(
        edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "cc-edges"
    )
    labels = staged(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("component")),
        "cc-labels",
    )
    for _ in range(max_rounds):
        seen = even_join(both, labels.withColumnRenamed("id", "b"), ["b"])
        near = seen.groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        hop = labels.select(F.col("id").alias("near"), F.col("component").alias("far"))
        moved = even_join(even_join(labels, near, ["id"]), hop, ["near"], "left")
        least = F.least("component", "near", "far")
        moved = staged(
            moved.select("id", least.alias("component"), (least < F.col("component")).alias("new")),
            "cc-labels",
        )
        labels = moved.select("id", "component")
        if not moved.where("new").limit(1).count():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
