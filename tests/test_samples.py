"""The sample documents: split parents and session settings do not change results."""

import pytest
from oracle import connect, difference

import __spark_entry__ as entry
from entitylake.samples import documents
from entitylake.settings import RECOMMENDED

from conftest import DATA

NAMES = ["flatten_wide", "entity_wide", "address_wide", "address_wide_shuffled", "crosswalk_table"]


@pytest.mark.parametrize("name", NAMES)
def test_partial_documents_change_nothing(spark, monkeypatch, name):
    monkeypatch.setattr(documents, "BLOCK", 50)
    problem = difference(entry.queries()[name](spark, DATA), connect(DATA), entry.oracle_sql()[name])
    assert problem is None


def test_documents_hold_a_bounded_number_of_children(spark, monkeypatch):
    """Parts are about even: dealt by a hash."""
    monkeypatch.setattr(documents, "BLOCK", 50)
    rows = documents.address_documents(spark, DATA).selectExpr(
        "uri", "size(attributes.Address) as n"
    )
    assert rows.agg({"n": "max"}).first()[0] <= 100
    assert rows.count() > rows.select("uri").distinct().count()


@pytest.fixture(scope="module")
def layouts(spark, tmp_path_factory):
    """The same tables in 1, 3 and 40 files."""
    found = {}
    for files in (1, 3, 40):
        found[files] = str(tmp_path_factory.mktemp(f"files{files}"))
        for name in ("orders", "lineitem", "customer"):
            rows = spark.read.parquet(f"{DATA}/{name}.parquet").repartition(files)
            rows.write.parquet(f"{found[files]}/{name}.parquet")
    return found


@pytest.mark.parametrize("block", [50, documents.BLOCK])
@pytest.mark.parametrize(
    "make", [documents.crosswalk_documents, documents.address_documents, documents.order_documents]
)
def test_documents_do_not_depend_on_files(spark, monkeypatch, layouts, make, block):
    monkeypatch.setattr(documents, "BLOCK", block)
    assert len({make(spark, folder).count() for folder in layouts.values()}) == 1


def test_a_parent_that_is_not_large_is_one_document(spark, layouts):
    rows = documents.crosswalk_documents(spark, layouts[40])
    assert rows.count() == rows.select("uri").distinct().count()


@pytest.mark.parametrize("files", [1, 3, 40])
def test_broken_files_do_not_depend_on_files(spark, layouts, files):
    name = "json_scan_quarantine"
    query, sql = entry.queries()[name], entry.oracle_sql()[name]
    assert difference(query(spark, layouts[files]), connect(DATA), sql) is None


@pytest.mark.parametrize("name", ["entity_wide", "address_wide_shuffled", "nested_entity_join"])
def test_recommended_settings(spark, conf, name):
    for option, value in RECOMMENDED.items():
        conf(option, value)
    problem = difference(entry.queries()[name](spark, DATA), connect(DATA), entry.oracle_sql()[name])
    assert problem is None
