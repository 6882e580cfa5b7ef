"""Session settings for large input.

The library sets none of them itself.  What they are for:

* a side is broadcast only on its *measured* size: the static estimate, which knows file sizes but
  not how far exploded arrays grow, is switched off;
* skewed join partitions are split, and partition numbers follow the data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def apply_recommended(spark: SparkSession) -> None:
    for name, value in RECOMMENDED.items():
        spark.conf.set(name, value)
