"""Every registered query against its SQL, on the smallest data."""

from __future__ import annotations

import pytest
from oracle_compare import connect, duck_rows, spark_rows

import __spark_entry__ as contract
from querylens.plans.catalog import QUERIES
from querylens.plans.oracle import ORACLE_SQL

SF_DIR = contract.SMOKE_DIR


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "grain"
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, duck, name):
    columns, rows = spark_rows(contract.queries()[name](spark, SF_DIR))
    expected_columns, expected = duck_rows(duck, contract.oracle_sql()[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
