"""Clicks, impressions, click-through rate and position by restaurant, cuisine and overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from querylens.operators.history import snapshots_in_effect
from querylens.operators.joins import BROADCAST_BYTES, lookup_join
from querylens.operators.shares import percent, share_of_total
from querylens.sources.scratch import materialize

SHARES = {
    "pct_unique_search_queries": "search_query_count",
    "pct_clicks": "total_clicks",
    "pct_impressions": "total_impressions",
}
METRICS = ("search_query_count", "total_clicks", "total_impressions", "ctr", "avg_position", *SHARES)
UNIFIED = ("grain", "restaurant_id", "cuisine", "search_type", "domain", *METRICS)

_SUMS = ("search_query_count", "total_clicks", "total_impressions", "position_weight")


def collapse_queries(queries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per restaurant, domain and query, with its sums; for each value of ``by``.

    The class of a query depends on nothing else, so classifying these rows
    instead of the raw ones gives the same metrics. The distinct count needs
    this grouping anyway, so it adds no shuffle.
    """
    return queries.groupBy(*by, "restaurant_id", "domain", "query").agg(
        F.sum("clicks").alias("clicks"),
        F.sum("impressions").alias("impressions"),
        F.sum(F.col("position") * F.col("impressions")).alias("position_weight"),
    )


def entity_totals(classified: DataFrame, by: Sequence[str] = (), queries_once: bool = False) -> DataFrame:
    """Additive sums per restaurant, domain and search type, from raw or collapsed rows; for each value of ``by``.

    ``queries_once`` says that a query comes once per restaurant and domain (and
    value of ``by``), as in collapsed rows. Then its rows are counted, without
    the two further groupings by query that a distinct count takes.
    """
    weight = F.col("position_weight" if "position_weight" in classified.columns else "_weight")
    if "position_weight" not in classified.columns:
        classified = classified.withColumn("_weight", F.col("position") * F.col("impressions"))
    return classified.groupBy(*by, "restaurant_id", "domain", "search_type").agg(
        (F.count("query_raw") if queries_once else F.count_distinct("query_raw")).alias("search_query_count"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("impressions").alias("total_impressions"),
        F.sum(weight).alias("position_weight"),
    )


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in _SUMS]


def _with_rates(sums: DataFrame) -> DataFrame:
    clicks, impressions = F.col("total_clicks"), F.col("total_impressions")
    return sums.withColumns(
        {
            "ctr": percent(clicks, impressions),
            "avg_position": F.col("position_weight") / F.nullif(impressions, F.lit(0)),
        }
    )


def _present(df: DataFrame, grain: str) -> DataFrame:
    """The unified columns, NULL where this grain has none."""
    absent = {c: F.lit(None).cast("string") for c in ("restaurant_id", "cuisine", "domain") if c not in df.columns}
    return df.withColumns({"grain": F.lit(grain), **absent}).select(
        *[F.col(c).cast("string") if c == "restaurant_id" else F.col(c) for c in UNIFIED]
    )


def entity_metrics(totals: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Restaurant grain: one row per restaurant, domain and search type, shares within the restaurant."""
    return _present(share_of_total(_with_rates(totals), ["restaurant_id"], SHARES, max_bytes), "restaurant")


def _with_distinct(summed: DataFrame, by: list[str], distinct: DataFrame | None) -> DataFrame:
    if distinct is None:
        return summed
    counted = lookup_join(summed, materialize(distinct, "distinct"), by, null_safe=True)
    return counted.withColumn("search_query_count", F.col("distinct_queries")).drop("distinct_queries")


def attributed_metrics(totals: DataFrame, labels: DataFrame, distinct: DataFrame | None = None) -> DataFrame:
    """Cuisine grain: every cuisine of a restaurant gets the restaurant's full sums.

    Both sides are reduced before they meet: the sums to one row per
    restaurant and search type, the labels to one row per restaurant and
    cuisine with the number of times it is listed.
    """
    by_entity = totals.groupBy("restaurant_id", "search_type").agg(*_sums())
    listed = labels.groupBy("restaurant_id", "cuisine").agg(F.count(F.lit(1)).alias("times"))
    times = F.col("times")
    expanded = listed.join(by_entity, "restaurant_id")
    summed = expanded.groupBy("cuisine", "search_type").agg(*[F.sum(F.col(c) * times).alias(c) for c in _SUMS])
    summed = _with_distinct(summed, ["cuisine", "search_type"], distinct)
    return _present(_with_window_shares(_with_rates(summed), Window.partitionBy("cuisine")), "cuisine")


def asof_metrics(classified: DataFrame, snapshots: DataFrame, date: str) -> DataFrame:
    """Cuisine grain for each ``date``, by the cuisines the restaurants had on that date.

    ``snapshots`` are labels with the ``snapshot_date`` they were stored on.
    Every cuisine that the snapshot in effect lists for a restaurant gets the
    restaurant's full sums of that date, as often as it is listed. Shares are
    within the date and cuisine. Rows before the first snapshot, and of
    restaurants that it doesn't have, belong to no cuisine and are left out.
    """
    totals = entity_totals(classified, [date])
    by_entity = totals.groupBy(date, "restaurant_id", "search_type").agg(*_sums())
    listed = snapshots.groupBy("snapshot_date", "restaurant_id", "cuisine").agg(F.count(F.lit(1)).alias("times"))
    expanded = snapshots_in_effect(materialize(by_entity, "dated-totals"), materialize(listed, "listed"), ["restaurant_id"], date)
    sums = [F.sum(F.col(c) * F.col("times")).alias(c) for c in _SUMS]
    summed = expanded.groupBy(date, "snapshot_date", "cuisine", "search_type").agg(*sums)
    shares = _with_window_shares(_with_rates(summed), Window.partitionBy(date, "cuisine"))
    return shares.select(date, "snapshot_date", "cuisine", "search_type", *METRICS)


def global_metrics(totals: DataFrame, distinct: DataFrame | None = None) -> DataFrame:
    """Global grain: one row per search type, from the restaurants so that no cuisine counts twice."""
    summed = _with_distinct(totals.groupBy("search_type").agg(*_sums()), ["search_type"], distinct)
    everything = Window.partitionBy(F.lit("global"))
    return _present(_with_window_shares(_with_rates(summed), everything), "global")


def _with_window_shares(df: DataFrame, window: Window) -> DataFrame:
    # Only for groups already summed to one row per search type.
    return df.withColumns({out: percent(F.col(c), F.sum(c).over(window)) for out, c in SHARES.items()})


def distinct_by_cuisine(classified: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct queries per cuisine and search type, over all its restaurants."""
    owners = materialize(labels.select("restaurant_id", "cuisine").distinct(), "owners")
    queries = classified.select("restaurant_id", "search_type", "query_raw").distinct()
    owned = lookup_join(queries, owners, ["restaurant_id"], how="inner")
    return owned.groupBy("cuisine", "search_type").agg(F.count_distinct("query_raw").alias("distinct_queries"))


def distinct_overall(classified: DataFrame) -> DataFrame:
    """Distinct queries per search type."""
    return classified.groupBy("search_type").agg(F.count_distinct("query_raw").alias("distinct_queries"))


# A sketch keeps 2 ** this many hashes. Counts up to that are exact; beyond, the standard error is 1 / sqrt(that), 1.6 %.
SKETCH_LOG = 12


def query_sketches(classified: DataFrame, log_entries: int = SKETCH_LOG) -> DataFrame:
    """(restaurant_id, search_type, sketch): the distinct queries of each restaurant, to be merged at any grain.

    A row takes at most 8 bytes for each of the 2 ** ``log_entries`` hashes.
    Stored once, sketches answer for cuisines and overall without the queries,
    and those of a new load are merged into them.
    """
    sketch = F.theta_sketch_agg("query_raw", F.lit(log_entries)).alias("sketch")
    return classified.where("query_raw is not null").groupBy("restaurant_id", "search_type").agg(sketch)


def merged_sketches(sketches: DataFrame, by: Sequence[str], log_entries: int = SKETCH_LOG) -> DataFrame:
    """(*by, distinct_queries): the estimated distinct queries of all sketches of a group."""
    estimate = F.theta_sketch_estimate(F.theta_union_agg("sketch", F.lit(log_entries)))
    return sketches.groupBy(*by).agg(estimate.cast("bigint").alias("distinct_queries"))


def sketched_distinct_metrics(
    totals: DataFrame, labels: DataFrame, sketches: DataFrame, log_entries: int = SKETCH_LOG
) -> DataFrame:
    """The unified table from stored totals and sketches, a query of several restaurants of a group counting once.

    Up to 2 ** ``log_entries`` distinct queries of a group the result is that
    of ``exact_distinct``; beyond, counts are off by some 1 / sqrt of it.
    """
    owners = materialize(labels.select("restaurant_id", "cuisine").distinct(), "owners")
    owned = lookup_join(sketches, owners, ["restaurant_id"], how="inner")
    by_cuisine = merged_sketches(owned, ["cuisine", "search_type"], log_entries)
    return all_grains(totals, labels, by_cuisine, merged_sketches(sketches, ["search_type"], log_entries))


def unified_metrics(
    classified: DataFrame, labels: DataFrame, exact_distinct: bool = False, queries_once: bool = False
) -> DataFrame:
    """All three grains in one table, told apart by ``grain``; ``queries_once`` as for ``entity_totals``.

    ``search_query_count`` of a cuisine, and overall, adds up the distinct
    queries of the restaurants. With ``exact_distinct`` a query that several
    of them have counts once.
    """
    totals = materialize(entity_totals(classified, queries_once=queries_once), "totals")
    by_cuisine = distinct_by_cuisine(classified, labels) if exact_distinct else None
    overall = distinct_overall(classified) if exact_distinct else None
    return all_grains(totals, labels, by_cuisine, overall)


def all_grains(
    totals: DataFrame, labels: DataFrame, by_cuisine: DataFrame | None = None, overall: DataFrame | None = None
) -> DataFrame:
    """The unified table from stored entity totals, with distinct queries of cuisines and overall if they are given."""
    return (
        entity_metrics(totals)
        .unionByName(attributed_metrics(totals, labels, by_cuisine))
        .unionByName(global_metrics(totals, overall))
    )


def restaurant_metrics(unified: DataFrame) -> DataFrame:
    return (
        unified.where(F.col("grain") == "restaurant")
        .select("restaurant_id", "domain", "search_type", *METRICS)
        .orderBy("restaurant_id", "search_type")
    )


def cuisine_metrics(unified: DataFrame) -> DataFrame:
    return (
        unified.where(F.col("grain") == "cuisine")
        .select("cuisine", "search_type", *METRICS)
        .orderBy(F.col("cuisine").asc_nulls_last(), "search_type")
    )
