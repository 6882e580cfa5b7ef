"""The plans are the ones intended: what is scanned, what is shuffled, what stays in the JVM."""

import re

import pytest
from documents import CITY, RANK, ZIP5, random_documents

import __spark_entry__ as entry
from entitylake.operators.crosswalk import crosswalk_table, crosswalk_uri_table
from entitylake.operators.linkage import largest_value_per_uri
from entitylake.operators.melt import melt_nested, melt_single
from entitylake.operators.pivot import pivot_single
from entitylake.plans.address import address_wide
from entitylake.plans.entity import groups_wide, linked_tagged
from entitylake.samples import documents
from entitylake.samples.documents import customer_documents, entity_documents
from entitylake.sources.scratch import staged

from conftest import DATA


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(df):
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"ReadSchema: (.*)", text)


def count(df, node):
    return len(re.findall(rf"\b{node}\b", plan(df)))


@pytest.fixture(scope="module")
def stored(spark):
    return staged(entity_documents(spark, DATA), "documents")


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_address_plan_has_no_pairing_join(spark, strategy):
    docs = staged(random_documents(spark, 3), "documents")
    wide = address_wide(docs, [CITY, RANK, ZIP5], strategy=strategy)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert count(wide, node) == 0
    schemas = read_schemas(wide)
    assert all("Country" not in s and "Zip4" not in s for s in schemas if "Zip5" not in s)
    assert not any("Country" in s for s in schemas)


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_address_plan_scans_documents_once(spark, strategy):
    """The shuffled form reads the reduced texts it has written instead."""
    docs = staged(random_documents(spark, 3), "documents")
    wide = address_wide(docs, [CITY, RANK], strategy=strategy)
    scans = sum("attributes" in s for s in read_schemas(wide))
    assert scans == (1 if strategy == "broadcast" else 0)


def test_melts_scan_once_without_shuffle(stored):
    single = melt_single(stored, ["attributes.Name", "attributes.Segment"], keep_empty=False)
    assert count(single, "FileScan") == 1 and count(single, "Exchange") == 0
    (schema,) = read_schemas(single)
    assert "Address" not in schema and "UniqueId" not in schema and "ov" not in schema
    nested = melt_nested(stored, ["attributes.Address.value.City", "attributes.Address.value.Rank"])
    assert count(nested, "FileScan") == 1 and count(nested, "Exchange") == 0
    (schema,) = read_schemas(nested)
    assert "Country" not in schema and "refRelation" not in schema


def test_crosswalk_scans_read_only_their_fields(stored):
    (schema,) = read_schemas(crosswalk_table(stored, keep_empty=False))
    assert schema == (
        "struct<crosswalks:array<struct<type:string,uri:string,value:string>>>"
    )
    uris = crosswalk_uri_table(stored, keep_empty=False)
    (schema,) = read_schemas(uris)
    assert "createDate" not in schema and "attributes:array<string>" in schema
    assert count(uris, "Exchange") == 0


def test_pivot_is_one_shuffle_with_partial_maxima(spark):
    long = spark.createDataFrame(
        [("a", "b", "c", "d", "Name", "v")],
        "cross_source string, cross_value string, sourceid string, EntityID string, "
        "joined_column string, value string",
    )
    wide = pivot_single(long, ["Name", "Segment"])
    assert count(wide, "Exchange") == 1 and "partial_max" in plan(wide)


def test_partial_documents_are_bounded(spark, monkeypatch):
    """A customer document comes from one row; the children of large parents are keyed by part as well."""
    assert count(customer_documents(spark, DATA), "Exchange") == 0
    docs = entity_documents(spark, DATA)
    assert "_part" not in plan(docs) and count(docs, "FileScan") == 2 and count(docs, "Exchange") == 1
    monkeypatch.setattr(documents, "BLOCK", 5)
    assert "_part" in plan(entity_documents(spark, DATA))
    monkeypatch.setattr(documents, "LISTED", 1)
    assert count(entity_documents(spark, DATA), "FileScan") == 3  # too many to be listed


def test_flat_rows_are_gathered_before_they_are_nested(spark):
    """The aggregation sorts what it gathers, and nested elements are many times larger."""
    text = plan(entity_documents(spark, DATA))
    assert "collect_list(struct(o_orderkey" in text and "collect_list(child" not in text


def test_attributes_are_spread_before_their_partial_maxima(stored):
    """A few files may hold them all; copies still meet in partial maxima before the last shuffle."""
    largest = largest_value_per_uri(melt_single(stored, ["attributes.Name"], keep_empty=False))
    nodes = re.findall(r"partial_max|hashpartitioning\(uri#\d+, value#\d+", plan(largest))
    assert nodes[0] == "partial_max" and len(nodes) == 2 and count(largest, "Exchange") == 2


def test_groups_need_one_melt_one_crosswalk_scan_and_one_link(stored):
    groups = {"place": ["attributes.Address.value.City"], "land": ["attributes.Address.value.Country"]}
    tagged = linked_tagged(stored, ["attributes.Name", "attributes.UniqueId"], ["Name", "UniqueId"], groups)
    assert count(tagged, "FileScan") == 2 and sum("crosswalks" in s for s in read_schemas(tagged)) == 1
    joins = len(re.findall(r"\b(?:SortMerge|BroadcastHash|ShuffledHash)Join\b", plan(tagged)))
    assert joins == 1
    assert len(re.findall(r"Join\b", plan(groups_wide(staged(tagged, "tagged"), groups)))) == 1


# training-data operators are free to use Arrow functions; tests/llm checks the native ones
OWN = [n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)]


@pytest.mark.parametrize("name", OWN)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, DATA))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in text
