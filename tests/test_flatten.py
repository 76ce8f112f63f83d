from __future__ import annotations

import json

import pytest

from querylens.operators.flatten import flatten_labels, flatten_search_export, label_names

ROW = {"keys": ["pizza dados"], "clicks": 3, "ctr": 0.3, "impressions": 10, "position": 1.5}
SCHEMA = "restaurant_id string, domain string, data string"


def flat(spark, *documents):
    df = spark.createDataFrame([("r", "d.com", d) for d in documents], SCHEMA)
    return [tuple(r) for r in flatten_search_export(df).collect()]


def one(spark, **changes):
    document = json.dumps({"rows": [{**ROW, **changes}]})
    (row,) = flat(spark, document)
    return row


def test_two_records(spark):
    document = json.dumps({"rows": [ROW, {**ROW, "keys": ["second", "US"]}]})
    expected = ("r", "d.com", 3, 0.3, 10, 1.5)
    assert flat(spark, document) == [(*expected, "pizza dados"), (*expected, "second")]


@pytest.mark.parametrize(
    "document",
    ["bad{", '{"x":1}', '{"rows":null}', '{"rows":[]}', '{"rows":5}', None, "", "[1]", '"x"', '{"rows":[{}],',
     '{"rows":[{}]} trailing', '{"rows":[{}]}{"rows":[{}]}', '{"rows":[{}]},{"rows":[{}]}', '{"Rows":[{}]}', '{"rows":[{}]}] trailing', '{"rows":[{}]},"1"] x',
     "{'rows':[{}]}", '{"rows":[NaN]}', '{"rows":[Infinity]}', '{"rows":[{"a":1,"a":2}]}', '{"rows":[01]}', '{"rows":[1,]}'],
)
def test_no_rows(spark, document):
    assert flat(spark, document) == []


@pytest.mark.parametrize(
    "document, rows", [('{"rows":[{"clicks":1}],"rows":[{"clicks":2}]}', 1), ("{'rows':[{}]}", 0), ('{"rows":[NaN]}', 0), ('{"rows":[{}]}] x', 0)]
)
def test_long_documents_follow_the_same_rules(spark, document, rows):
    filler = '{"filler":"' + "x" * (40 << 20) + '",'
    assert len(flat(spark, document)) == len(flat(spark, document.replace("{", filler, 1))) == rows


def test_the_last_of_a_repeated_name_counts(spark):
    assert [r[2] for r in flat(spark, '{"rows":[{"clicks":1}],"rows":[{"clicks":2}]}')] == [2]


def test_object_of_records(spark):
    assert [r[2] for r in flat(spark, '{"rows":{"a":{"clicks":1},"b":{"clicks":2}}}')] == [1, 2]


@pytest.mark.parametrize(
    "value, expected",
    [(2.6, 3), (2.5, 3), (2.4, 2), ("7", 7), ("x", None), (None, None), (9007199254740993, 9007199254740993)],
)
def test_whole_numbers(spark, value, expected):
    assert one(spark, clicks=value)[2] == expected


@pytest.mark.parametrize(
    "keys, expected", [([], None), ([None], None), (["  a b "], "a b"), (["é"], "é"), (None, None), ([5], "5")]
)
def test_query(spark, keys, expected):
    assert one(spark, keys=keys)[6] == expected


def test_records_that_are_no_objects(spark):
    assert [r[2] for r in flat(spark, '{"rows":[null,5,{"clicks":1}]}')] == [None, None, 1]


def test_many_records(spark):
    document = json.dumps({"rows": [{**ROW, "clicks": i + 0.6} for i in range(100)]})
    assert [r[2] for r in flat(spark, document)] == list(range(1, 101))


def test_labels(spark):
    rows = [
        ("1", '["Thai","Pizza"]'),
        ("2", '["Thai", "Thai"]'),
        ("3", '[" \\" Soup \\" "]'),
        ("4", "bad["),
        ("5", None),
        ("6", "[]"),
        ("7", "[null]"),
        ("8", '"Thai"'),
        ("9", '["Thai"]] x'),
        ("9", '["Thai"],["Thai"]'),
        ("9", "['Thai']"),
    ]
    df = spark.createDataFrame(rows, "restaurant_id string, cuisines string")
    found = sorted((tuple(r) for r in flatten_labels(df).collect()), key=str)
    assert found == [("1", "Pizza"), ("1", "Thai"), ("2", "Thai"), ("2", "Thai"), ("3", "Soup"), ("7", None)]
    assert sorted(str(r[0]) for r in label_names(flatten_labels(df)).collect()) == ["None", "Pizza", "Soup", "Thai"]


@pytest.mark.parametrize("flatten, column", [(flatten_search_export, "data"), (flatten_labels, "cuisines")])
def test_a_document_is_read_once_as_each_kind(spark, flatten, column):
    df = spark.createDataFrame([("r", "d.com", "[1]")], "restaurant_id string, domain string, text string").withColumnRenamed("text", column)
    plan = flatten(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2  # the second only for what isn't an array
    assert not any("from_json(" in line for line in plan.splitlines() if "Generate" in line or "Filter" in line)
    assert "isnull(_array" in plan
