"""Dimensions that change over time: dated snapshots and Type-2 intervals."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from querylens.operators.joins import BROADCAST_BYTES, HOT_ROWS, lookup_join
from querylens.sources.scratch import materialize

# Rows of one key that a single task is meant to sort.
SLICE_ROWS = 2_000_000
# Rows of heavy keys that a task puts in order before they are cut; smaller slices share such a task.
RANGE_ROWS = 250_000


# --- dated snapshots -------------------------------------------------------


def snapshot_dimension(dimension: DataFrame, date: datetime.date, path: str) -> None:
    """Store a copy of the dimension under its date; repeating a date replaces that copy only."""
    (
        dimension.withColumn("snapshot_date", F.lit(date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )


def snapshot_in_effect(
    facts: DataFrame,
    snapshots: DataFrame,
    keys: Sequence[str],
    as_of: datetime.date,
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join facts with the last snapshot taken on or before ``as_of``.

    The date is settled first, so only that snapshot's folder is read.
    """
    taken = snapshots.where(F.col("snapshot_date") <= F.lit(as_of))
    date = taken.agg(F.max("snapshot_date")).first()[0]
    effective = snapshots.where(F.col("snapshot_date") == F.lit(date))
    return lookup_join(facts, effective, keys, how, max_bytes=max_bytes, hot_rows=hot_rows)


def snapshots_in_effect(
    facts: DataFrame,
    snapshots: DataFrame,
    keys: Sequence[str],
    date: str,
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join each fact with the last snapshot taken on or before its own ``date``.

    A snapshot is all rows of one ``snapshot_date``, so which one is in effect
    depends on the day alone. The days that occur and the snapshots' dates are
    put in one order, a list as long as the calendar, and each day gets the
    date before it; the facts look theirs up, and then join on the keys and
    that date. A fact without a date, or before the first snapshot, has none:
    with ``how="left"`` it stays with a NULL ``snapshot_date``. So does one
    whose key the snapshot in effect doesn't have, with that snapshot's date.
    """
    day = F.to_date(date)
    taken = snapshots.select(F.col("snapshot_date").alias("_day"), F.col("snapshot_date").alias("_taken")).distinct()
    days = facts.select(day.alias("_day")).where("_day is not null").distinct()
    line = days.join(taken, "_day", "full").withColumn("_part", F.lit(0))  # one row per day
    before = Window.partitionBy("_part").orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    calendar = line.select("_day", F.last("_taken", ignorenulls=True).over(before).alias("snapshot_date"))
    calendar = materialize(calendar.where("snapshot_date is not null"), "calendar")
    dated = lookup_join(facts.withColumn("_day", day), calendar, ["_day"], how, max_bytes=max_bytes, hot_rows=hot_rows)
    return lookup_join(
        dated.drop("_day"), snapshots, [*keys, "snapshot_date"], how, max_bytes=max_bytes, hot_rows=hot_rows
    )


# --- carrying values along a key's rows ------------------------------------


@dataclass(frozen=True)
class _Sliced:
    """Rows with the ``_slice`` of their key's line in which they are sorted; NULL for keys that are sorted as a whole."""

    rows: DataFrame
    keys: tuple[str, ...]
    heavy: bool  # whether any key has slices

    def carry(self, value: Column, order: Sequence[str], out: str, inclusive: bool, backward: bool) -> DataFrame:
        """Add the last non-NULL ``value`` before each row of its key, or after it if ``backward``.

        Each slice of a key is sorted on its own. What its rows need from
        other slices is the last value of the nearest slice that has one: one
        row per slice, of heavy keys alone. Without any there is one window.
        """

        def run(*columns: str) -> list[Column]:
            return [F.desc(c) if backward else F.asc(c) for c in columns]

        inside = Window.partitionBy(*self.keys, "_slice").orderBy(*run(*order))
        inside = inside.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        carried = self.rows.withColumn(out, F.last(value, ignorenulls=True).over(inside))
        if not self.heavy:
            return carried
        ends = F.min_by if backward else F.max_by
        position = F.when(value.isNotNull(), F.struct(*order))
        cut = self.rows.where("_slice is not null")
        edges = cut.groupBy(*self.keys, "_slice").agg(ends(value, position).alias("_edge"))
        across = Window.partitionBy(*self.keys).orderBy(*run("_slice"))
        across = across.rowsBetween(Window.unboundedPreceding, -1)
        edges = edges.select(*self.keys, "_slice", F.last("_edge", ignorenulls=True).over(across).alias("_carried"))
        edges = materialize(edges.where(F.col("_carried").isNotNull()), "edges")
        return carried.join(edges, [*self.keys, "_slice"], "left").withColumn(out, F.coalesce(out, "_carried")).drop("_carried")


def heavy_keys(df: DataFrame, keys: Sequence[str], rows: int, n: int | None = None) -> DataFrame:
    """(_key, n): hashes of the keys with more than ``rows`` of the ``n`` rows of ``df``, as a stored table.

    A summary of frequent items, counted by each task and merged, names all
    keys that may have so many, at most some eight times n / rows; only those are
    counted exactly, in a second pass. So what is shuffled follows from the
    number of heavy keys and not from that of all keys. Above a million
    counters ``rows`` counts as n / 125,000. Rows with a NULL in a key have
    one like others. Two keys with the same hash count as one.
    """
    n = df.count() if n is None else n
    counters = max(_LEAST_COUNTERS, min(_MOST_COUNTERS, -(-_COUNTERS_EACH * n // rows)))
    least = max(rows, _COUNTERS_EACH * n // counters)
    hashed = df.select(F.xxhash64(*keys).alias("_key"))
    frequent = hashed.agg(F.expr(f"approx_top_k(_key, {counters}, {counters})").alias("found"))
    frequent = frequent.select(F.explode("found.item").alias("_key"))
    frequent = F.broadcast(materialize(frequent, "frequent-keys"))  # a million longs at most
    counts = hashed.join(frequent, "_key", "left_semi").groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counts.where(F.col("n") > least), "heavy-keys")


# A key is sure to be in the summary if its rows are more than 7 n / counters.
_COUNTERS_EACH = 8
_LEAST_COUNTERS = 100
_MOST_COUNTERS = 1_000_000
# monotonically_increasing_id has the number of the partition above these bits and the row's place below.
_RANGE_BITS = 33


def _slice(df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_rows: int) -> _Sliced:
    """Cut the rows of keys with more than ``slice_rows`` into about as many slices of that size, along ``order``.

    All other keys are left whole, however many there are. The heavy ones are
    put in their own order, in ranges of ``RANGE_ROWS`` at least, and each range is
    cut by place. So there are as many tasks as the rows need, however small the slices, and a key
    all of whose rows have the same time is cut as well.
    """
    whole = _Sliced(df.withColumn("_slice", F.lit(None).cast("bigint")), tuple(keys), heavy=False)
    n = df.count()
    if n <= slice_rows:
        return whole
    heavy = heavy_keys(df, keys, slice_rows, n)
    rows = heavy.agg(F.sum("n")).first()[0]
    if rows is None:
        return whole
    heavy = F.broadcast(heavy.select("_key"))  # n / slice_rows rows at most
    hashed = df.withColumn("_key", F.xxhash64(*keys))
    cut = hashed.join(heavy, "_key", "left_semi").drop("_key")
    cut = cut.repartitionByRange(max(2, -(-rows // max(slice_rows, RANGE_ROWS))), *keys, *order)
    # Each range begins at a multiple of 2 ** _RANGE_BITS.
    place = F.monotonically_increasing_id()
    slice_ = F.expr(f"_place - pmod(pmod(_place, {1 << _RANGE_BITS}), {slice_rows})")
    cut = cut.sortWithinPartitions(*keys, *order).withColumn("_place", place)
    cut = materialize(cut.withColumn("_slice", slice_).drop("_place"), "slices")
    light = hashed.join(heavy, "_key", "left_anti").drop("_key").withColumn("_slice", F.lit(None).cast("bigint"))
    return _Sliced(light.unionByName(cut), tuple(keys), heavy=True)


# --- Type-2 intervals ------------------------------------------------------


def scd2_intervals(
    observations: DataFrame,
    keys: Sequence[str],
    time: str,
    attributes: Sequence[str],
    order: Sequence[str] = (),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per change of the attributes, with the time it took effect and that of the next change.

    An observation equal to the one before it is no change. ``order`` settles
    observations of the same time. The last row of a key has no end. Rows
    without a key belong to none and are left out.
    """
    known = observations.dropna(subset=list(keys)).select(*keys, time, *order, *attributes)
    ordering = [time, *order]
    state = F.struct(*attributes)
    sliced = _slice(known, keys, ordering, slice_rows)
    seen = sliced.carry(state, ordering, "_before", inclusive=False, backward=False)
    changes = seen.where(~F.col("_before").eqNullSafe(state)).drop("_before")
    changes = materialize(changes, "changes")
    ended = _Sliced(changes, tuple(keys), sliced.heavy).carry(
        F.col(time), ordering, "effective_end_date", inclusive=False, backward=True
    )
    return ended.select(*keys, *attributes, F.col(time).alias("effective_start_date"), "effective_end_date")


def scd2_join(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    time: str,
    how: str = "inner",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Join each fact with the interval of its key in which its ``time`` lies.

    A key's intervals do not overlap, so the one in question is the last to
    start by then. Facts and intervals are put in one order and the interval
    carried forward, which takes work in proportion to the rows; comparing all
    facts of a key with all its intervals would not.
    """
    attributes = [c for c in dimension.columns if c not in keys]
    start, end = "effective_start_date", "effective_end_date"
    fact, interval = F.col("_fact"), F.col("_interval")
    known = facts if how == "left" else facts.dropna(subset=[*keys, time])
    events = known.select(
        *keys,
        F.col(time).alias("_at"),
        F.lit(1).alias("_kind"),
        F.lit(True).alias("_open"),
        F.lit(None).cast(dimension.schema[end].dataType).alias("_end"),
        F.xxhash64(*facts.columns).alias("_tie"),
        F.struct(*[c for c in facts.columns if c not in keys]).alias("_fact"),
    ).unionByName(
        # At equal starts the interval that ends last, or not at all, comes last.
        dimension.dropna(subset=list(keys)).select(
            *keys,
            F.col(start).alias("_at"),
            F.lit(0).alias("_kind"),
            F.col(end).isNull().alias("_open"),
            F.col(end).alias("_end"),
            F.lit(0).cast("bigint").alias("_tie"),
            F.struct(*attributes).alias("_interval"),
        ),
        allowMissingColumns=True,
    )
    ordering = ["_at", "_kind", "_open", "_end", "_tie"]
    matched = _slice(events, keys, ordering, slice_rows).carry(
        interval, ordering, "_found", inclusive=True, backward=False
    )
    matched = matched.where(fact.isNotNull())
    found_end = F.col(f"_found.{end}")
    in_effect = F.col("_found").isNotNull() & (found_end.isNull() | (F.col("_at") < found_end))
    if how == "inner":
        matched = matched.where(in_effect)
    own = [F.col(c) if c in keys else F.col(f"_fact.{c}") for c in facts.columns]
    return matched.select(*own, *[F.when(in_effect, F.col(f"_found.{c}")).alias(c) for c in attributes])
