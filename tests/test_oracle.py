"""Every registered query against its oracle SQL on the smallest tables."""

import re

import pytest
from oracle import connect, difference

import __spark_entry__ as entry

from conftest import DATA

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
_TRAINING_DATA = re.compile(r"op\d+_|pipeline$").match  # tested with their subpackage


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_every_query_has_an_oracle():
    assert {n for n in QUERIES if not _TRAINING_DATA(n)} <= set(ORACLE)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_oracle(spark, duck, name):
    assert difference(QUERIES[name](spark, DATA), duck, ORACLE[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
