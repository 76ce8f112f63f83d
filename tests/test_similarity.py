from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from querylens.functions.similarity import jaro_winkler, jaro_winkler_at_least

ALPHABETS = ("abcdef ", "abcdefghijklmnopqrstuvwxyz0123456789 ", "ab")


def random_pairs(n: int) -> list[tuple[str, str]]:
    rng = random.Random(7)
    pairs = []
    for _ in range(n):
        letters = rng.choice(ALPHABETS)
        a = "".join(rng.choice(letters) for _ in range(rng.randint(0, 18)))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            if b:
                b[rng.randrange(len(b))] = rng.choice(letters)
        if rng.random() < 0.4:
            rng.shuffle(b)
        tail = "".join(rng.choice(letters) for _ in range(rng.randint(0, 8)))
        pairs.append((a, "".join(b) + tail))
    return pairs


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame(random_pairs(20_000), "a string, b string").repartition(8)
    a, b = F.col("a"), F.col("b")
    flags = [jaro_winkler_at_least(a, b, t / 100).alias(f"at{t}") for t in (60, 78, 95)]
    return df.select("a", "b", jaro_winkler(a, b).alias("score"), *flags).toPandas()


def test_equals_other_engine(scored):
    wrong = duckdb.sql("SELECT * FROM scored WHERE abs(score - jaro_winkler_similarity(a, b)) > 1e-9").fetchall()
    assert wrong == []


@pytest.mark.parametrize("threshold", [60, 78, 95])
def test_shortcut_changes_nothing(scored, threshold):
    assert (scored[f"at{threshold}"] == (scored["score"] >= threshold / 100)).all()
    assert scored[f"at{threshold}"].any()


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("", ""), ("", "a"), ("a", "")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    rows = df.select(jaro_winkler(a, b), jaro_winkler_at_least(a, b, 0.78)).collect()
    assert [r[0] for r in rows] == [None, None, 0.0, 0.0, 0.0]
    assert not any(r[1] for r in rows)
