"""Joins that stay safe when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from querylens.sources.scratch import materialize

# A broadcast copy is held by every executor, so its measured size is kept well below the executor's memory.
BROADCAST_BYTES = 32 << 20

# Rows of one key that a single task may join. The list of keys above it has at most
# (rows / HOT_ROWS) entries, so it can be broadcast.
HOT_ROWS = 5_000_000


def measured_bytes(df: DataFrame) -> int:
    """Data size of a stored table: eight bytes per field plus the text in it; nested values count as JSON text."""
    text = [F.col(f.name) for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    text += [F.to_json(F.struct(f.name)) for f in df.schema.fields if isinstance(f.dataType, nested)]
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.coalesce(F.sum(F.octet_length(c)), F.lit(0)).alias(f"t{i}") for i, c in enumerate(text)],
    ).first()
    return row["n"] * 8 * len(df.columns) + sum(row[f"t{i}"] for i in range(len(text)))


def _equal(pairs: dict[str, str], null_safe: bool) -> Column:
    tests = [F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b) for a, b in pairs.items()]
    return reduce(Column.__and__, tests)


def _spread_hot_keys(
    left: DataFrame, right: DataFrame, pairs: dict[str, str], null_safe: bool, hot_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Add a salt to both sides: several per hot key, one for all others.

    The rows of a hot key are dealt out by their place in the stored ``left``,
    equal rows too; a repeated task finds each row at the same place.
    """
    left = materialize(left, "left")
    names = {c: f"_hot_{c}" for c in pairs}
    hot = left.groupBy(*pairs).agg(F.ceil(F.count(F.lit(1)) / hot_rows).alias("_salts")).where("_salts > 1")
    hot = F.broadcast(materialize(hot.withColumnsRenamed(names), "hot"))
    columns = left.columns
    left = left.withColumn("_place", F.monotonically_increasing_id())
    left = left.join(hot, _equal(names, null_safe), "left").select(
        *columns, F.coalesce(F.pmod("_place", "_salts"), F.lit(0)).alias("_salt")
    )
    columns = right.columns
    last = F.coalesce(F.col("_salts"), F.lit(1)) - 1
    right = right.join(hot, _equal({pairs[c]: names[c] for c in pairs}, null_safe), "left").select(
        *columns, F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_right_salt")
    )
    return left, right


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``left`` with a smaller stored table ``right`` on equal ``on`` columns.

    ``right`` is measured first. Small enough, it is broadcast and ``left`` is
    not shuffled. Otherwise both sides are shuffled on the keys; a key with
    more than ``hot_rows`` rows on the left gets a salt taken from a row's
    place, and its rows on the right are repeated once per salt.
    """
    names = {c: f"_right_{c}" for c in on}
    right = right.withColumnsRenamed(names)
    pairs = dict(names)
    if measured_bytes(right) <= max_bytes:
        right = F.broadcast(right)
    else:
        left, right = _spread_hot_keys(left, right, pairs, null_safe, hot_rows)
        pairs["_salt"] = "_right_salt"
    return left.join(right, _equal(pairs, null_safe), how).drop("_salt", *pairs.values())
