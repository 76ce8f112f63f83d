"""Places in an order, without bringing all rows to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from querylens.sources.scratch import materialize

_WITHIN = (1 << 33) - 1  # the part of a monotonically increasing id that counts the rows of a partition


def with_place(df: DataFrame, order: Sequence[Column], place: str = "place") -> DataFrame:
    """Add the place of each row in ``order``, from 1; rows that are equal in it are told apart arbitrarily, but once.

    Rows are dealt out by sampled ranges of the order, sorted and counted
    there, and stored. A range's first place follows from the counts of those
    before it, a list with one row per range.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    ranged = materialize(ranged, "ranged")
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.lit(0).alias("_all"))
    before = Window.partitionBy("_all").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    placed = ranged.join(F.broadcast(starts), "_range")
    number = F.col("_before") + F.col("_at").bitwiseAND(F.lit(_WITHIN)) + 1
    return placed.select(*df.columns, number.alias(place))
