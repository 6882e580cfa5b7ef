import pytest
from pyspark.sql import types as T

from entitylake.llm.common import ship

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use for results or in between
        T.StructField("kept", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("shard", T.StringType()),
        T.StructField("secrets", T.StringType()),
    ]
)


@pytest.fixture
def docs(spark):
    """Make documents from texts (ids count from 0) or from ``(id, text, lang)``."""

    def make(rows):
        full = []
        for number, row in enumerate(rows):
            key, text, lang = row if isinstance(row, tuple) else (number, row, "en")
            size = None if text is None else len(text)
            full.append((key, text, lang, None, size, "x", None, "y", None))
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make
