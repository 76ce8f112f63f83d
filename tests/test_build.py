"""The whole build on a small raw export."""

from __future__ import annotations

import json

import pytest
from oracle_compare import connect, duck_rows, spark_rows
from pyspark.sql import functions as F

from querylens.operators import quality
from querylens.operators.classify import classify_each_once, classify_queries
from querylens.plans import shapes
from querylens.plans.build import build
from querylens.plans.oracle import ORACLE_SQL

SF_DIR = "/root/testdata/sf0.001"

T = "2024-01-01 00:00:00"


def document(*rows):
    keys = ("clicks", "ctr", "impressions", "position")
    return json.dumps({"rows": [{"keys": [r[0]], **dict(zip(keys, r[1:], strict=True))} for r in rows]})


@pytest.fixture(scope="module")
def exports(spark):
    rows = [
        (1, "dadospizzaok.com", document(("pizza dados", 3, 0.3, 10, 1.5), ("sushi", 0, 0.0, 30, 9.0))),
        (1, "dadospizzaok.com", document(("pizza dados", 1, 0.1, 10, 2.5))),
        (2, "thaibasil.com", document(("thai", 2, 0.1, 20, 8.6), ("thai basil", 5, 0.5, 10, 1.0))),
        (3, "empty.com", "bad{"),
    ]
    raw = spark.createDataFrame(rows, "restaurant_id int, domain string, data string")
    raw = raw.selectExpr("*", f"timestamp'{T}' _updated_at", f"timestamp'{T}' _created_at", "'ok' status")
    labels = spark.createDataFrame(
        [(1, '["Pizza"]'), (2, '["thai","Pizza"]'), (3, "[]")], "restaurant_id int, cuisines string"
    )
    return raw, labels


@pytest.fixture(scope="module", params=["planned", "written"])
def built(request, exports, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("build")) if request.param == "written" else None
    return build(*exports, root=root)


def test_classes(built):
    found = {(r["query_raw"], r["search_type"]) for r in built.classified_queries.collect()}
    assert found == {
        ("pizza dados", "Branded"),
        ("sushi", "Unbranded"),
        ("thai", "Unbranded"),
        ("thai basil", "Branded"),
    }
    assert built.classified_queries.columns == [
        "restaurant_id", "domain", "clicks", "ctr", "impressions", "position", "query_raw", "query_cleaned",
        "domain_name_cleaned", "jarrow_similarity", "search_type",
    ]


def test_metrics(built):
    rows = {(r["grain"], r["restaurant_id"] or r["cuisine"], r["search_type"]): r for r in built.unified_metrics.collect()}
    assert len(rows) == 10
    pizza = rows["restaurant", "1", "Branded"]
    assert (pizza["search_query_count"], pizza["total_clicks"], pizza["total_impressions"]) == (1, 4, 20)
    assert (pizza["ctr"], pizza["avg_position"], pizza["pct_impressions"]) == (20.0, 2.0, 40.0)
    both = rows["cuisine", "Pizza", "Branded"]
    assert (both["search_query_count"], both["total_clicks"], both["total_impressions"]) == (2, 9, 30)
    assert rows["global", None, "Branded"]["total_clicks"] == 9
    assert rows["global", None, "Unbranded"]["total_impressions"] == 50


def test_residual(built):
    rows = {r["restaurant_id"]: r for r in built.ctr_residual.collect()}
    assert set(rows) == {"1", "2"}
    assert rows["1"]["expected_ctr"] == 10.0 and rows["1"]["nboi_click_opportunity"] == 3.0
    assert rows["2"]["residual_z_score"] is None


def test_checks_pass(built):
    assert [r for r in built.check().collect() if r["failing_rows"]] == []
    assert built.check().count() == 36


def test_written_tables(exports, spark, tmp_path):
    built = build(*exports, root=str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/unified_metrics/grain=global").count() == 2
    assert spark.read.parquet(f"{tmp_path}/cuisine_metrics").count() == 4
    planned = build(*exports)
    for name, df in built.tables().items():
        other = planned.tables()[name]
        assert df.schema.simpleString() == other.schema.simpleString()
        assert sorted(map(str, df.collect())) == sorted(map(str, other.collect()))
    build(*exports, root=str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/queries").count() == 5


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    return build(
        shapes.search_export(spark, SF_DIR), shapes.label_export(spark, SF_DIR), root=str(tmp_path_factory.mktemp("whole"))
    )


@pytest.mark.parametrize(
    "table, query",
    [
        ("queries", "flatten_search_export"),
        ("labels", "flatten_labels"),
        ("label_names", "label_names"),
        ("classified_queries", "classify_queries"),
        ("unified_metrics", "unified_metrics"),
        ("restaurant_metrics", "restaurant_metrics"),
        ("cuisine_metrics", "cuisine_metrics"),
        ("ctr_residual", "ctr_residual"),
    ],
)
def test_each_written_table_equals_sql(whole, table, query):
    df = whole.tables()[table]
    df = df.withColumns({f.name: F.round(f.name, 6) + 0.0 for f in df.schema.fields if f.dataType.simpleString() == "double"})
    con = connect(SF_DIR)
    sql = f"SELECT COLUMNS(lambda c: c <> 'place') FROM ({ORACLE_SQL[query]})"  # the order is that of the query, not of the table
    names, expected = duck_rows(con, sql)
    columns, found = spark_rows(df)
    assert columns == names
    assert found == [tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in r) for r in expected]


def test_each_pair_is_scored_once(spark):
    queries = spark.createDataFrame([("pizza dados", "dadospizzaok.com", i) for i in range(50)], "query string, domain string, n int")
    names = spark.createDataFrame([("thai",)], "cuisine string")
    once = classify_each_once(queries, names)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "aggregate(" not in plan and "regexp_replace" not in plan  # the text work is done on the stored pairs
    assert sorted(map(str, once.collect())) == sorted(map(str, classify_queries(queries, names).select(*once.columns).collect()))


def faulty(exports, spark, empty=False):
    raw, labels = exports
    more = spark.createDataFrame([(None, None, document(("x", None, None, 4, None)))], "restaurant_id int, domain string, data string")
    raw = raw.unionByName(more.selectExpr("*", "null _updated_at", "null _created_at", "'ok' status"))
    labels = labels.unionByName(spark.createDataFrame([(None, None)], labels.schema))
    return (raw.limit(0), labels.limit(0)) if empty else (raw, labels)


@pytest.mark.parametrize("empty", [False, True])
def test_checks_counted_while_writing_are_those_of_the_tables(exports, spark, tmp_path, empty):
    built = build(*faulty(exports, spark, empty), root=str(tmp_path))
    counted, again = (sorted(map(tuple, x.collect())) for x in (built.check(), quality.quality_report(built.tables())))
    assert counted == again and len(counted) == 36
    assert any(r[-1] for r in counted) is not empty


def test_only_unique_columns_are_read_again(exports, tmp_path):
    built = build(*exports, root=str(tmp_path))
    plan = built.check()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "label_names" in plan
