from __future__ import annotations

import pytest

from querylens.operators.quality import CHECKS, Check, not_null, quality_report


def test_declared_checks():
    assert len(CHECKS) == 36
    assert len(set(CHECKS)) == 36
    assert sum(c.table in ("search_export", "label_export") for c in CHECKS) == 6
    assert sum(c.table == "ctr_residual" for c in CHECKS) == 7


def test_counts(spark):
    rows = [(1, "Branded", "restaurant"), (1, "Other", "cuisine"), (None, None, "restaurant"), (2, "Odd", "restaurant"),
            (3, "Branded", "x"), (3, "Branded", "x"), (3, "Branded", "x"), (None, "Branded", "cuisine")]
    df = spark.createDataFrame(rows, "k int, kind string, grain string")
    checks = [
        *not_null("t", "k"),
        *not_null("t", "k", where="grain = 'restaurant'"),
        Check("t", "k", "unique"),
        Check("t", "kind", "accepted_values", ("Branded", "Unbranded")),
        *not_null("other", "k"),
    ]
    report = quality_report({"t": df}, checks)
    assert report.columns == ["table_name", "column_name", "check_name", "failing_rows"]
    found = {(r["column_name"], r["check_name"]): r["failing_rows"] for r in report.collect()}
    assert found == {
        ("k", "not_null"): 2,
        ("k", "not_null where grain = 'restaurant'"): 1,
        ("k", "unique"): 2,
        ("kind", "accepted_values"): 2,
    }


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "k int")
    checks = [*not_null("t", "k"), Check("t", "k", "unique")]
    assert [r["failing_rows"] for r in quality_report({"t": df}, checks).collect()] == [0, 0]


def test_unknown_check():
    with pytest.raises(ValueError):
        Check("t", "k", "positive").fails()


def test_row_checks_share_a_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id k", "id v").write.parquet(path)
    report = quality_report({"t": spark.read.parquet(path)}, not_null("t", "k", "v"))
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
