"""Exact sums against plain arithmetic, the whole result against a version in numpy and fractions, and odd tables."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from querylens.llm.queries import QUERIES
from querylens.llm.whitening import scatter, whiten

SCHEMA = "vec_id long, embedding array<float>"


def plain_version(rows: list[tuple], components: int = 4):
    """(n, deviations by row, components with eigenvalues, covariance) from whole numbers."""
    x = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({v for _, v in x})
    n, dims = len(fit), len(fit[0])
    sums = [sum(v[d] for v in fit) for d in range(dims)]
    deviations = [(i, sum((n * v[d] - sums[d]) ** 2 for d in range(dims))) for i, v in x]
    cov = np.array([[sum((n * v[a] - sums[a]) * (n * v[b] - sums[b]) for v in fit) / n**3 for b in range(dims)] for a in range(dims)])
    values, vectors = np.linalg.eigh(cov)
    mean = np.array(sums) / n
    z = [(i, (np.array(v) - mean) @ vectors[:, ::-1][:, :components] / np.sqrt(values[::-1][:components])) for i, v in x]
    return n, deviations, z, values[::-1][:components] / np.trace(cov)


def check(spark, rows: list[tuple]):
    found = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    n, deviations, z, explained = plain_version(rows)
    each = len(explained)
    assert len(found) == each * len(z)
    assert {r["n"] for r in found} == {n}
    assert sorted((r["vec_id"], r["deviation"]) for r in found if r["component"] == 1) == sorted(deviations)
    assert all(r["deviation"] == r["deviation_exact"] for r in found)
    for c in range(each):
        mine = sorted((r["vec_id"], r["whitened"]) for r in found if r["component"] == c + 1)
        theirs = sorted((i, v[c]) for i, v in z)
        a, b = np.array([v for _, v in mine]), np.array([v for _, v in theirs])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
        shares = {r["explained"] for r in found if r["component"] == c + 1}
        assert len(shares) == 1 and math.isclose(shares.pop(), explained[c], rel_tol=1e-9)
    assert found[0]["identity_error"] < 1e-9


def vectors(count: int, dims: int, seed: int) -> list[tuple]:
    draw = np.random.default_rng(seed)
    spread = np.arange(1, dims + 1)
    return [(i, [float(np.float32(c)) for c in draw.normal(size=dims) * spread]) for i in range(count)]


def test_equals_the_plain_version(spark):
    check(spark, vectors(300, 6, 1))


def test_sums_of_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        check(spark, vectors(200, 3, 8))
    finally:
        for name, value in (("spark.sql.adaptive.enabled", "true"), ("spark.sql.shuffle.partitions", "4")):
            spark.conf.set(name, value)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_repeated_vectors_count_once(spark):
    rows = vectors(40, 5, 2)
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(3, rows[3][1]), (None, rows[4][1])]
    found = whiten(spark.createDataFrame(rows, SCHEMA))
    assert found.agg(F.max("n")).first()[0] == 40
    assert found.count() == 4 * 242
    check(spark, [r for r in rows if r[0] is not None])


def test_unusable_vectors_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(50, 3, 3)
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 1.0, 2.0]), (103, [1.0, inf, 2.0]), (104, [1.0, -inf, 2.0]), (105, []), (106, [1.0])]
    found = whiten(spark.createDataFrame(rows + bad, SCHEMA))
    assert {r["vec_id"] for r in found.collect()} == set(range(50))
    check(spark, rows)


def test_components_without_variance(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0]) for i in range(10)]
    found = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["component"], r["whitened"] is None) for r in found} == {(1, False), (2, True), (3, True)}
    assert found[0]["identity_error"] < 1e-9
    one = whiten(spark.createDataFrame(rows[:1], SCHEMA)).collect()
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(0, None, 0.0, None)] * 3


def test_empty_tables_and_clashing_names(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).collect() == []
    rows = [(i, v, i, "a") for i, v in vectors(20, 4, 4)]
    named = spark.createDataFrame(rows, f"{SCHEMA}, component int, x string")
    assert whiten(named).count() == 80


def test_large_entries_stay_exact(spark):
    draw = random.Random(5)
    rows = [(i, [float(draw.randrange(-(2**40), 2**40)) for _ in range(3)]) for i in range(30)]
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    _, deviations, _, _ = plain_version(rows)
    exact = {r["vec_id"]: (r["deviation"], r["deviation_exact"]) for r in found}
    for i, d in deviations:
        assert exact[i] == (d if d < 2**63 else None, d)
    assert found[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("high", [2, 300, 2**31, 2**62])
def test_scatter_is_exact(high):
    draw = np.random.default_rng(7)
    x = draw.integers(-high, high, (130, 4))
    sums, cross = scatter(x)
    plain = [[int(v) for v in row] for row in x]
    assert sums == [sum(r[d] for r in plain) for d in range(4)]
    assert cross == [[sum(r[a] * r[b] for r in plain) for b in range(4)] for a in range(4)]


def test_query_equals_the_plain_version(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = QUERIES["op13_whitening"](spark, sf_dir).collect()
    n, deviations, z, explained = plain_version(rows)
    assert sorted((r["vec_id"], r["deviation"]) for r in found if r["component"] == 1) == sorted(deviations)
    assert {r["n"] for r in found} == {n} and found[0]["identity_error"] < 1e-9
    of = {(r["vec_id"], r["component"]): r["whitened"] for r in found}
    for c in range(4):
        ratio = [of[i, c + 1] / v[c] for i, v in z]
        assert max(abs(abs(r) - 1) for r in ratio) < 1e-6
