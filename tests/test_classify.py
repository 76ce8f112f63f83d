from __future__ import annotations

import pytest
from golden import NAMES, ROWS
from pyspark.sql import functions as F

from querylens.functions import brands
from querylens.operators.classify import classify_queries, clean_queries, with_label_match


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(n,) for n in NAMES], "cuisine string")


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(r[0], r[1]) for r in ROWS], "query string, domain string")


def by_pair(df, column):
    return {(r["query_raw"], r["domain"]): r[column] for r in df.collect()}


@pytest.mark.parametrize("with_score", [True, False])
@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_golden_types(queries, names, with_score, max_bytes):
    found = by_pair(classify_queries(queries, names, with_score=with_score, max_bytes=max_bytes), "search_type")
    assert found == {(r[0], r[1]): "Branded" if r[9] else "Unbranded" for r in ROWS}


def test_golden_scores(queries, names):
    found = by_pair(classify_queries(queries, names), "jarrow_similarity")
    assert {k: int(v + 1e-9) for k, v in found.items()} == {(r[0], r[1]): r[3] for r in ROWS}


def test_golden_rules(queries, names):
    q, b, r = F.col("query_cleaned"), F.col("domain_name_cleaned"), F.col("query_raw")
    flags = with_label_match(clean_queries(queries), names).select(
        "query_raw",
        "domain",
        F.struct(
            brands.match_substring(q, b),
            brands.match_tokens(q, b, r),
            brands.match_prefix(q, b),
            brands.exclude_false_positives(q, b, r, F.col("label")),
            brands.brand_overrides(q, b, r),
        ).alias("flags"),
    )
    found = {k: tuple(int(x) for x in v) for k, v in by_pair(flags, "flags").items()}
    assert found == {(row[0], row[1]): row[4:9] for row in ROWS}


def test_fuzzy_is_the_threshold(queries):
    q, b = F.col("query_cleaned"), F.col("domain_name_cleaned")
    cleaned = clean_queries(queries).withColumn("fuzzy", brands.match_fuzzy(q, b))
    assert by_pair(cleaned, "fuzzy") == {(r[0], r[1]): r[3] >= 78 for r in ROWS}


def test_unknown_is_unbranded(spark, names):
    df = spark.createDataFrame([(None, "a.com"), ("abc", None), (None, None)], "query string, domain string")
    for with_score in (True, False):
        rows = classify_queries(df, names, with_score=with_score).collect()
        assert {r["search_type"] for r in rows} == {"Unbranded"}
        assert len(rows) == 3


def test_null_name_excludes_nothing(spark):
    names = spark.createDataFrame([(None,), ("thai",)], "cuisine string")
    df = spark.createDataFrame([("dadospizzaok", "dadospizzaok.com")], "query string, domain string")
    assert classify_queries(df, names).first()["search_type"] == "Branded"


def test_case_of_names(spark):
    names = spark.createDataFrame([("Thai",)], "cuisine string")
    df = spark.createDataFrame([("thai", "thaibasil.com")], "query string, domain string")
    assert classify_queries(df, names).first()["search_type"] == "Branded"
    assert classify_queries(df, names, lower_names=True).first()["search_type"] == "Unbranded"


def test_prefix_length(spark, names):
    df = spark.createDataFrame([("a pizza place", "amore.com")], "query string, domain string")
    assert classify_queries(df, names).first()["search_type"] == "Branded"
    assert classify_queries(df, names, min_prefix_len=2).first()["search_type"] == "Unbranded"


def test_score_ignores_case(spark, names):
    df = spark.createDataFrame([("dadospizza", "DadosPizza.com")], "query string, domain string")
    assert classify_queries(df, names).first()["jarrow_similarity"] == 100


def test_own_rules(spark, names):
    rules = [brands.Rule("sushi%", "%tokyo%")]
    pairs = [("best tokyo", "sushibar.com"), ("my pie", "pizzayourway.com")]
    df = spark.createDataFrame(pairs, "query string, domain string")
    found = by_pair(classify_queries(df, names, rules=rules), "search_type")
    assert found == {("best tokyo", "sushibar.com"): "Branded", ("my pie", "pizzayourway.com"): "Unbranded"}


def test_india_guard(spark):
    df = spark.createDataFrame(
        [("taste india",), ("taste india in town",), ("taste in india",), ("in india in taste india",)], "raw string"
    )
    q = F.col("raw")
    found = [r[0] for r in df.select(brands.match_tokens(F.lit("taste india"), F.lit("tasteofindia"), q)).collect()]
    assert found == [True, True, True, False]


def test_rows_are_kept(spark, names):
    df = spark.createDataFrame([("thai", "thai.com", i) for i in range(50)], "query string, domain string, i int")
    for max_bytes in (0, 1 << 20):
        assert classify_queries(df, names, max_bytes=max_bytes).count() == 50
