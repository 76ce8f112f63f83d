"""Properties of the plans that matter for large data."""

from __future__ import annotations

import datetime

import pytest

from querylens.operators import metrics
from querylens.operators.classify import classify_queries
from querylens.operators.flatten import flatten_search_export
from querylens.plans import catalog, shapes
from querylens.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_python(spark, name):
    plan = executed(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = executed(catalog.q_normalize_query(spark, SF_DIR))
    assert "l_quantity" not in plan and "l_shipdate" not in plan


@pytest.fixture(scope="module")
def flat(spark, tmp_path_factory):
    """Flat queries without any partitioning of their own."""
    path = str(tmp_path_factory.mktemp("flat") / "queries")
    catalog.flat_queries(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


def test_queries_are_summed_before_they_are_classified(spark, flat):
    names = catalog.q_label_names(spark, SF_DIR)
    collapsed = metrics.collapse_queries(flat)
    plan = executed(metrics.entity_totals(classify_queries(collapsed, names, with_score=False)))
    # One shuffle by query, in which hot restaurants are spread, and one of the sums.
    assert plan.count("Exchange hashpartitioning") == 2
    assert "hashpartitioning(restaurant_id" in plan
    assert plan.count("partial_sum") >= 2


def test_classifying_rows_moves_none_of_them(spark, flat):
    plan = executed(classify_queries(flat, catalog.q_label_names(spark, SF_DIR)))
    assert "Exchange hashpartitioning" not in plan
    assert "BroadcastHashJoin" in plan


def test_rows_are_dealt_to_documents_before_they_are_gathered(spark, tmp_path):
    day = datetime.datetime(2024, 1, 1)
    lines = [(i % 9000, i % 3, i % 2, 1 + i % 7, 2.0, 0.01, 0.5, day) for i in range(40)]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_shipdate timestamp"
    parts = [(i, f"hot bolt{i}", "SMALL") for i in range(3)]
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(0,), (1,)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    export = shapes.search_export(spark, str(tmp_path))
    plan = executed(export)
    # From the result down: the rows are gathered above the one shuffle by document.
    assert plan.count("Exchange hashpartitioning(restaurant_id") == 1
    assert plan.index("partial_collect_list") < plan.index("Exchange hashpartitioning(restaurant_id")
    assert sorted(r.restaurant_id for r in export.collect()) == [0, 1]


def test_queries_that_come_once_are_not_grouped_again(spark):
    schema = "restaurant_id string, domain string, search_type string, query_raw string, clicks long, impressions long, position_weight double"
    rows = [("r", "d", "Branded", q, 1, 2, 3.0) for q in ("a", "b", None)] + [("r", None, "Branded", "a", 1, 2, 3.0), (None, "d", "Unbranded", None, 1, 2, 3.0)]
    collapsed = spark.createDataFrame(rows, schema)
    once = metrics.entity_totals(collapsed, queries_once=True)
    assert once.exceptAll(metrics.entity_totals(collapsed)).isEmpty() and once.count() == 3
    assert once.schema == metrics.entity_totals(collapsed).schema
    assert executed(once).count("Exchange hashpartitioning") == 1


def test_registered_totals_count_queries_once(spark, flat):
    names = catalog.q_label_names(spark, SF_DIR)
    collapsed = classify_queries(metrics.collapse_queries(flat), names, with_score=False)
    once, distinct = (metrics.entity_totals(collapsed, queries_once=x).drop("position_weight") for x in (True, False))
    assert once.exceptAll(distinct).isEmpty()
    assert "count(distinct" not in executed(catalog.totals(spark, SF_DIR))


def test_documents_are_packed_and_parsed_in_many_tasks(spark, tmp_path):
    """Spark merges the small tasks of a shuffle to one a core or one more, however long each record takes to parse."""
    day = datetime.datetime(2024, 1, 1)
    lines = [(i * 500, i % 3, i % 2, 1 + i % 7, 2.0, 0.01, 0.5, day) for i in range(400)]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_shipdate timestamp"
    parts = [(i, f"hot bolt{i}", "SMALL") for i in range(3)]
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(0,), (1,)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    flat = flatten_search_export(shapes.search_export(spark, str(tmp_path)))
    assert flat.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    assert flat.count() == 400
