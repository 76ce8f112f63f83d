"""Metric sums kept up to date load by load.

What a load changes is a list of signed rows: those it brings count once, those
it supersedes count minus once. Added up per query they change a counted
multiset of queries; where a query's count becomes or stops being zero, the
distinct count of its restaurant changes by one. So a load costs what it
touches: the rows of other restaurants are neither shuffled nor classified
again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from querylens.operators.joins import BROADCAST_BYTES, measured_bytes
from querylens.sources.scratch import materialize

KEY = "restaurant_id"
GROUP = (KEY, "domain", "search_type")
SUMS = ("clicks", "impressions", "position_weight")
TOTALS = {"clicks": "total_clicks", "impressions": "total_impressions", "position_weight": "position_weight"}

Classify = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Maintained:
    """Stored tables: ``queries``, a row per restaurant, domain, class and query with its number of rows and sums, and
    ``totals``, a row per restaurant, domain and class with its number of rows, distinct queries and sums."""

    queries: DataFrame
    totals: DataFrame


def _counted(rows: DataFrame, classify: Classify) -> DataFrame:
    """The multiset of some raw rows: each query is classified once."""
    weight = F.col("position") * F.col("impressions")
    collapsed = rows.groupBy(KEY, "domain", "query").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("clicks").alias("clicks"),
        F.sum("impressions").alias("impressions"),
        F.sum(weight).alias("position_weight"),
    )
    return classify(collapsed).select(*GROUP, "query_raw", "n", *SUMS)


def _distinct(present: Column) -> Column:
    return F.sum(F.when(F.col("query_raw").isNotNull(), present).otherwise(0)).cast("bigint").alias("search_query_count")


def start(rows: DataFrame, classify: Classify) -> Maintained:
    """The state after a first load of raw rows (restaurant_id, domain, query, clicks, impressions, position)."""
    queries = materialize(_counted(rows, classify), "counted-queries")
    sums = [F.sum(c).alias(t) for c, t in TOTALS.items()]
    totals = queries.groupBy(*GROUP).agg(F.sum("n").alias("n"), _distinct(F.lit(1)), *sums)
    return Maintained(queries, materialize(totals, "maintained-totals"))


def _touched(load: DataFrame) -> DataFrame:
    """The restaurants of a load, to be joined with; a broadcast copy if their measured size allows."""
    keys = materialize(load.select(F.col(KEY).alias("_key")).distinct(), "touched")
    return F.broadcast(keys) if measured_bytes(keys) <= BROADCAST_BYTES else keys


def split(table: DataFrame, touched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of a table that a load leaves as they are, and the others."""
    same = F.col(KEY).eqNullSafe(F.col("_key"))
    return table.join(touched, same, "left_anti"), table.join(touched, same, "left_semi")


def signed_changes(state: Maintained, load: DataFrame, classify: Classify, touched: DataFrame) -> DataFrame:
    """What a load changes in the multiset, as a stored table: differences of ``n`` and the sums, none of them all zero.

    A load replaces all rows of the restaurants it has. Rows without a
    restaurant replace nothing and are added.
    """
    _, met = split(state.queries.where(F.col(KEY).isNotNull()), touched)
    measures = ("n", *SUMS)
    superseded = met.select(*GROUP, "query_raw", *[(-F.col(c)).alias(c) for c in measures])
    changes = _counted(load, classify).unionByName(superseded)
    changes = changes.groupBy(*GROUP, "query_raw").agg(*[F.sum(c).alias(c) for c in measures])
    some = F.lit(False)
    for c in measures:
        some = some | (F.coalesce(c, F.lit(0)) != 0)
    return materialize(changes.where(some), "changes")


def apply_load(state: Maintained, load: DataFrame, classify: Classify) -> Maintained:
    """The state after one more load.

    ``classify`` must give a query of a domain the class it had before; when
    cuisine names or rules change, start again. Sums of whole numbers are
    exact; those of fractions may differ in their last digits from a full
    build's, as the order of addition does.
    """
    touched = _touched(load)
    changes = signed_changes(state, load, classify, touched)
    untouched, met = split(state.queries, touched)
    before = met.select("*", F.col("n").alias("n_before"))
    both = before.unionByName(changes.withColumn("n_before", F.lit(0).cast("bigint")))
    merged = both.groupBy(*GROUP, "query_raw").agg(
        *[F.sum(c).alias(c) for c in ("n", *SUMS)], F.sum("n_before").alias("n_before")
    )
    merged = materialize(merged, "merged-queries")
    kept = merged.where("n > 0").drop("n_before")
    queries = materialize(untouched.unionByName(kept.select(*untouched.columns)), "counted-queries")

    came = (F.col("n") > 0).cast("int") - (F.col("n_before") > 0).cast("int")
    moved = merged.groupBy(*GROUP).agg(_distinct(came)).withColumns({t: F.lit(0) for t in ("n", *TOTALS.values())})
    sums = changes.groupBy(*GROUP).agg(F.sum("n").alias("n"), *[F.sum(c).alias(t) for c, t in TOTALS.items()])
    untouched, met = split(state.totals, touched)
    columns = state.totals.columns
    differences = moved.select(*columns).unionByName(sums.withColumn("search_query_count", F.lit(0)).select(*columns))
    totals = met.unionByName(differences).groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in columns if c not in GROUP])
    types = {f.name: f.dataType for f in state.totals.schema.fields}
    totals = totals.where("n > 0").select(*[F.col(c).cast(types[c]) for c in columns])
    return Maintained(queries, materialize(untouched.unionByName(totals), "maintained-totals"))
