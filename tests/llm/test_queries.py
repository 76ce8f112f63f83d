"""The registered operators: those with SQL against it, all on the smallest data."""

from __future__ import annotations

import pytest
from oracle_compare import connect, duck_rows, spark_rows

import __spark_entry__ as contract
from querylens.llm.oracle import ORACLE_SQL
from querylens.llm.queries import QUERIES

SF_DIR = contract.SMOKE_DIR


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duck_rows(duck, ORACLE_SQL[name])
    assert columns == expected_columns
    assert rows == expected


def test_native_plans_have_no_python(spark):
    for name in ("op3_surrogates", "op8_fingerprint", "op9_mix_sources"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
