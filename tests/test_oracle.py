"""Every registered query against its SQL; ORACLE_SF_DIR chooses the data."""

import os

import pytest

import __spark_entry__ as entry
from oracle import connect, differences

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, duck, name):
    assert differences(entry.queries()[name](spark, FOLDER), duck, entry.oracle_sql()[name]) == []


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    found = entry.entry(spark)
    assert found.columns == ["period", "id", "p0", "p1", "p2", "label"]
    assert found.count() > 0
