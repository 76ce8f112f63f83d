from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from querylens.operators import history

DAY0 = datetime.datetime(2024, 1, 1)


def observations(n=600):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        key = 1 if rng.random() < 0.5 else rng.randint(2, 9)
        # Key 2 changes in one burst; ties in time are settled by the id.
        minute = rng.randint(0, 3) if key == 2 else rng.randint(0, 3000)
        rows.append((key, DAY0 + datetime.timedelta(minutes=minute), i, rng.choice(["a", "b", None])))
    rows.append((None, DAY0, n, "a"))
    return rows


def expected_intervals(rows):
    result = []
    for key in {r[0] for r in rows} - {None}:
        changes, before = [], object()
        for _, at, _, value in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2])):
            if value != before:
                changes.append((at, value))
            before = value
        ends = [c[0] for c in changes[1:]] + [None]
        result += [(key, value, at, end) for (at, value), end in zip(changes, ends, strict=True)]
    return result


def intervals(spark, kind, slice_rows):
    df = spark.createDataFrame(observations(), "k bigint, at timestamp_ntz, id bigint, v string").repartition(7)
    df = df.withColumn("at", F.col("at").cast(kind))
    return history.scd2_intervals(df, ["k"], "at", ["v"], order=["id"], slice_rows=slice_rows)


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


@pytest.mark.parametrize("slice_rows", [7, 40, 1_000_000])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_intervals(spark, kind, slice_rows):
    found = [tuple(r) for r in intervals(spark, kind, slice_rows).collect()]
    assert sorted(found, key=str) == sorted(expected_intervals(observations()), key=str)


@pytest.mark.parametrize("slice_rows", [7, 40, 1_000_000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join(spark, slice_rows, how):
    rng = random.Random(6)
    facts = [
        (rng.choice([1, 1, 2, 3, 77]), DAY0 + datetime.timedelta(minutes=rng.randint(-50, 3200)), i) for i in range(500)
    ]
    facts += [(None, DAY0, 500), (1, None, 501)]
    expected = []
    known = expected_intervals(observations())
    for key, at, i in facts:
        hits = [
            t for t in known if at is not None and t[0] == key and t[2] <= at and (t[3] is None or at < t[3])
        ]
        assert len(hits) <= 1
        if hits:
            expected.append((key, at, i, *hits[0][1:]))
        elif how == "left":
            expected.append((key, at, i, None, None, None))
    df = spark.createDataFrame(facts, "k bigint, at timestamp_ntz, i int").repartition(5)
    joined = history.scd2_join(df, intervals(spark, "timestamp_ntz", 50), ["k"], "at", how, slice_rows)
    assert joined.columns == ["k", "at", "i", "v", "effective_start_date", "effective_end_date"]
    assert sorted(map(str, (tuple(r) for r in joined.collect()))) == sorted(map(str, expected))


def test_closed_intervals(spark):
    day = datetime.date
    dimension = spark.createDataFrame(
        [(1, "x", day(2024, 1, 1), day(2024, 1, 5)), (1, "y", day(2024, 1, 9), None)],
        "k int, v string, effective_start_date date, effective_end_date date",
    )
    facts = spark.createDataFrame([(1, day(2024, 1, d)) for d in (1, 4, 5, 8, 9, 20)], "k int, at date")
    rows = history.scd2_join(facts, dimension, ["k"], "at", how="left").orderBy("at").collect()
    assert [r["v"] for r in rows] == ["x", "x", None, None, "y", "y"]
    assert history.scd2_join(facts, dimension, ["k"], "at").count() == 4


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def largest_slice(df, order, slice_rows):
    sliced = history._slice(df, ["k"], order, slice_rows).rows
    return sliced.groupBy("k", "_slice").count().agg(F.max("count")).first()[0]


def test_many_small_keys_need_one_window(spark):
    df = spark.range(20_000).select((F.col("id") % 2_000).alias("k"), F.col("id").alias("at"), (F.col("id") % 3).alias("v"))
    sliced = history._slice(df, ["k"], ["at"], 50)
    assert not sliced.heavy
    carried = sliced.carry(F.col("v"), ["at"], "before", inclusive=False, backward=False)
    plan = carried._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and "Join" not in plan and exchanges(carried) == 1


@pytest.mark.parametrize("rows", [10, 100])
def test_heavy_keys_are_found_exactly(spark, rows):
    # Key i has i rows; NULL has 150.
    df = spark.range(1, 200).select(F.explode(F.sequence(F.lit(1), F.col("id"))).alias("i"), F.col("id").alias("k"))
    df = df.select("k").unionByName(spark.range(150).select(F.lit(None).cast("bigint").alias("k"))).repartition(7)
    found = history.heavy_keys(df, ["k"], rows)
    expected = df.groupBy("k").count().where(F.col("count") > rows).select(F.xxhash64("k"), "count")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_only_heavy_keys_are_cut(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("at")
    )
    sliced = history._slice(df, ["k"], ["at"], 500)
    assert sliced.heavy
    assert sliced.rows.where("_slice is not null").select("k").distinct().collect() == [(1,)]
    assert sliced.rows.where("_slice is null").count() == 4_999
    assert largest_slice(df, ["at"], 500) <= 1_500


def test_a_key_of_equal_times_is_cut(spark):
    # One key has nearly all rows, all but one of them in the same second.
    late = F.when(F.col("id") == 0, F.lit(DAY0 + datetime.timedelta(days=900))).otherwise(F.lit(DAY0))
    df = spark.range(10_000).select(F.lit(1).alias("k"), late.alias("at"), "id")
    assert largest_slice(df, ["at", "id"], 500) <= 2000
    assert history.scd2_intervals(
        df.withColumn("v", F.col("id") % 2), ["k"], "at", ["v"], order=["id"], slice_rows=500
    ).count() == 10_000


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    day = datetime.date

    def dimension(*rows):
        return spark.createDataFrame(rows, "k int, v string")

    history.snapshot_dimension(dimension((1, "old"), (2, "gone")), day(2024, 1, 1), path)
    history.snapshot_dimension(dimension((1, "wrong")), day(2024, 1, 8), path)
    history.snapshot_dimension(dimension((1, "new"), (1, "second")), day(2024, 1, 8), path)
    snapshots = spark.read.parquet(path)
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, n int")

    def at(as_of, **options):
        rows = history.snapshot_in_effect(facts, snapshots, ["k"], as_of, **options).collect()
        return sorted((r["k"], r["n"], str(r["v"])) for r in rows)

    assert at(day(2023, 12, 31)) == []
    assert at(day(2024, 1, 7)) == [(1, 10, "old"), (2, 20, "gone")]
    assert at(day(2024, 1, 8)) == [(1, 10, "new"), (1, 10, "second")]
    left = [(1, 10, "new"), (1, 10, "second"), (2, 20, "None"), (3, 30, "None")]
    assert at(day(2024, 2, 1), how="left") == left
    assert at(day(2024, 2, 1), how="left", max_bytes=0, hot_rows=1) == left


def test_only_one_snapshot_is_read(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    for d in (1, 2, 3):
        history.snapshot_dimension(spark.range(5).withColumnRenamed("id", "k"), datetime.date(2024, 1, d), path)
    joined = history.snapshot_in_effect(
        spark.range(5).withColumnRenamed("id", "k"), spark.read.parquet(path), ["k"], datetime.date(2024, 1, 2)
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_each_fact_gets_the_snapshot_of_its_day(spark, tmp_path):
    day, at = datetime.date, datetime.datetime
    path = str(tmp_path / "snapshots")
    for d, rows in ((1, [(1, "a"), (2, "b")]), (8, [(1, "c"), (1, "d")])):
        history.snapshot_dimension(spark.createDataFrame(rows, "k int, v string"), day(2024, 1, d), path)
    snapshots = spark.read.parquet(path)
    facts = [(1, at(2023, 12, 31, 23)), (1, at(2024, 1, 1, 0)), (2, at(2024, 1, 7, 23)), (1, at(2024, 1, 8, 5)), (2, at(2024, 1, 9)), (3, at(2024, 1, 2)), (1, None), (None, at(2024, 1, 2))]
    df = spark.createDataFrame(facts, "k int, at timestamp_ntz")
    inner = [(1, facts[1][1], "a"), (2, facts[2][1], "b"), (1, facts[3][1], "c"), (1, facts[3][1], "d")]
    missing = [(facts[i][0], facts[i][1], None) for i in (0, 4, 5, 6, 7)]
    for options in ({}, {"max_bytes": 0, "hot_rows": 1}):
        found = history.snapshots_in_effect(df, snapshots, ["k"], "at", **options)
        assert sorted((r["k"], r["at"], r["v"]) for r in found.collect()) == sorted(inner)
        left = history.snapshots_in_effect(df, snapshots, ["k"], "at", how="left", **options)
        assert sorted(((r["k"], r["at"], r["v"]) for r in left.collect()), key=str) == sorted(inner + missing, key=str)
    none = history.snapshots_in_effect(df, snapshots.limit(0), ["k"], "at")
    assert none.count() == 0


def test_small_slices_share_tasks_and_files(spark):
    df = spark.range(3_000).select((F.col("id") % 3).alias("k"), F.pmod(F.xxhash64("id"), F.lit(500)).alias("at"), "id")
    sliced = history._slice(df, ["k"], ["at", "id"], 5)
    assert len(sliced.rows.where("_slice is not null").inputFiles()) <= 4  # 600 with a task for each slice
    sizes = sliced.rows.groupBy("_slice").count()
    assert sizes.agg(F.max("count"), F.count("*")).first()[0] == 5 and sizes.count() <= 602
    spans = sliced.rows.groupBy("k", "_slice").agg(F.min(F.struct("at", "id")).alias("first"), F.max(F.struct("at", "id")).alias("last"))
    for key in range(3):
        line = spans.where(F.col("k") == key).orderBy("_slice").collect()
        assert all(a.last < b.first for a, b in zip(line, line[1:], strict=False))
