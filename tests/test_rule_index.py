from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from querylens.functions.brands import OVERRIDES, Rule, any_rule
from querylens.operators.classify import classify_queries
from querylens.operators.rule_index import rules_table, with_any_rule

SCHEMA = "query_cleaned string, domain_name_cleaned string, query_raw string, n int, ruled string"
SYLLABLES = ["ta", "co", "piz", "za", "bur", "gé", "r", " ", "o", "%", "_", "near"]


def text(rng):
    return "".join(rng.choices(SYLLABLES, k=rng.randint(0, 5)))


def pattern(rng):
    made = "".join(rng.choice(["%", "%", "%", "_", "", r"\%", r"\_"]) + rng.choice(SYLLABLES[:8]) for _ in range(rng.randint(1, 2)))
    return made + rng.choice(["%", "%", "_", ""])


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    made = [(text(rng), text(rng), text(rng), i % 7, "x") for i in range(400)]
    made += [made[0]] * 5 + [(None, "taco", "taco", 1, "x"), ("taco", None, "taco", 1, "x"), ("taco", "taco", None, 1, "x"), ("", "", "", 1, "x")]
    return spark.createDataFrame(made, SCHEMA)


def each_tested(rules):
    """Every rule tested on every row; a chain of so many conditions overflows the planner's stack."""
    texts = F.col("query_cleaned"), F.col("domain_name_cleaned"), F.col("query_raw")
    return F.array_max(F.array(F.lit(False), *[F.coalesce(any_rule([r], *texts), F.lit(False)) for r in rules]))


def both(spark, rows, rules, **options):
    expected = rows.withColumn("ruled", each_tested(rules))
    found = with_any_rule(rows, rules_table(spark, rules), **options)
    assert found.columns == expected.columns
    return [sorted(map(tuple, x.collect()), key=str) for x in (found, expected)]


def made_rules(rng, n):
    out = [Rule(pattern(rng), pattern(rng), rng.choice(["query", "raw"])) for _ in range(n)]
    return out + [Rule(pattern(rng) + "a%", rng.choice(["(?i)TACO", "^piz+", "z.$"]), rng.choice(["query", "raw"]), True) for _ in range(n // 10)]


@pytest.mark.parametrize("options", [{}, {"max_bytes": 0}])
def test_equals_the_chain(spark, rows, options):
    rules = made_rules(random.Random(4), 300)
    found, expected = both(spark, rows, rules, **options)
    assert found == expected and 20 < sum(r[-1] for r in found) < 380


def test_rules_without_plain_characters(spark, rows):
    rules = [Rule("%", "___"), Rule("_%", "zz|taco", "raw", True), Rule("%", r"\%%"), Rule("piz%", "%")]
    found, expected = both(spark, rows, rules)
    assert found == expected and any(r[-1] for r in found)
    many = [Rule("%", f"x{i}", "raw", True) for i in range(65)]
    with pytest.raises(ValueError, match="no plain character"):
        with_any_rule(rows, rules_table(spark, many))


def test_empty_tables_nulls_and_repeated_rules(spark, rows):
    none = rules_table(spark, [])
    assert with_any_rule(rows, none).where("ruled").isEmpty()
    assert with_any_rule(rows.limit(0), rules_table(spark, OVERRIDES)).isEmpty()
    null = spark.createDataFrame([(None, "%taco%", "query", False), ("%taco%", None, "raw", False)], none.schema)
    assert with_any_rule(rows, null).where("ruled").isEmpty()
    rule = Rule("%ta%", "%co%")
    assert len({str(both(spark, rows, [rule] * n)) for n in (1, 3)}) == 1


def test_twenty_thousand_rules_in_a_plan_of_the_same_size(spark, rows):
    rules = [Rule(f"{a}{b}%", f"%{b} {c}%") for a in SYLLABLES[:8] for b in SYLLABLES[:8] for c in range(320)]
    few, many = rules[:20], rules[:20_000] + made_rules(random.Random(5), 100)
    plans = [with_any_rule(rows, rules_table(spark, x))._jdf.queryExecution().optimizedPlan().toString() for x in (few, many)]
    assert len(many) > 20_000 and plans[0].count("\n") == plans[1].count("\n")
    found = with_any_rule(rows, rules_table(spark, many))
    # No text has a digit, so the others fit nothing.
    assert found.where("ruled").count() == rows.where(each_tested(many[20_000:])).count() > 0


def test_classes_are_those_of_the_list(spark):
    queries = [("a & r grill", "aandrgrill.com"), ("pepz", "stadiumpepz.com"), ("pizza", "x.com"), (None, "y.com"), ("my pie", "pizzayourway.com")]
    df = spark.createDataFrame(queries, "query string, domain string")
    names = spark.createDataFrame([("pizza",)], "cuisine string")
    found = [sorted(map(tuple, classify_queries(df, names, r).collect()), key=str) for r in (OVERRIDES, rules_table(spark, OVERRIDES))]
    assert found[0] == found[1] and {r[-1] for r in found[0]} == {"Branded", "Unbranded"}
