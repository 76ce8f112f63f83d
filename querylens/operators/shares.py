"""A row's part of its group's total."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from querylens.operators.joins import BROADCAST_BYTES, lookup_join
from querylens.sources.scratch import materialize

HUNDRED = Decimal("100.0")


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` to two places, rounded half up in decimals; NULL when ``whole`` is zero."""
    return F.round(F.lit(HUNDRED) * part / F.nullif(whole, F.lit(0)), 2).cast("double")


def with_group_totals(
    df: DataFrame,
    by: Sequence[str],
    totals: Mapping[str, Column],
    max_bytes: int = BROADCAST_BYTES,
    source: DataFrame | None = None,
) -> DataFrame:
    """Add each group's totals to its rows; rows with NULL keys form one group.

    ``source`` has the rows to sum, where ``df`` took work to derive from them.

    A window would sort every row of a group in one task. Here the totals are
    summed with partial aggregation and looked up, so a group may be of any
    size and ``df`` is not shuffled when the totals are small.
    """
    summed = (df if source is None else source).groupBy(*by).agg(*[c.alias(name) for name, c in totals.items()])
    return lookup_join(df, materialize(summed, "totals"), by, null_safe=True, max_bytes=max_bytes)


def share_of_total(
    df: DataFrame,
    by: Sequence[str],
    measures: Mapping[str, str],
    max_bytes: int = BROADCAST_BYTES,
    source: DataFrame | None = None,
) -> DataFrame:
    """For each output name in ``measures``, the percent its column has in the group's sum."""
    names = {out: f"_total_{column}" for out, column in measures.items()}
    totals = {names[out]: F.sum(column) for out, column in measures.items()}
    shared = with_group_totals(df, by, totals, max_bytes, source)
    return shared.withColumns(
        {out: percent(F.col(column), F.col(names[out])) for out, column in measures.items()}
    ).drop(*names.values())
