"""Click-through rate against what other restaurants reach at the same position."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from querylens.operators.shares import with_group_totals

COLUMNS = (
    "restaurant_id",
    "pos_bin",
    "avg_position",
    "ctr",
    "expected_ctr",
    "position_ctr_residual",
    "nboi_click_gap_pct",
    "nboi_click_opportunity",
    "total_impressions",
    "total_clicks",
    "residual_z_score",
)


def ctr_residual(unified: DataFrame) -> DataFrame:
    """Position-adjusted residual of each restaurant's unbranded click-through rate.

    The expectation is the rate of all other rows in the same rounded
    position, weighted by impressions. Rows that have none, for lack of
    impressions or of others in their bin, are left out. The z-score is NULL
    where the expectation leaves no variance.
    """
    rows = unified.where(
        (F.col("grain") == "restaurant") & (F.col("search_type") == "Unbranded") & (F.col("total_impressions") > 0)
    ).select(
        "restaurant_id",
        F.round("avg_position").cast("bigint").alias("pos_bin"),
        "avg_position",
        "ctr",
        "total_impressions",
        "total_clicks",
    )
    binned = with_group_totals(
        rows.where(F.col("pos_bin").isNotNull()),
        ["pos_bin"],
        {"_clicks": F.sum("total_clicks"), "_impressions": F.sum("total_impressions")},
    )
    n, clicks = F.col("total_impressions"), F.col("total_clicks")
    rate = (F.col("_clicks") - clicks) / F.nullif(F.col("_impressions") - n, F.lit(0))
    expected, gap = F.col("expected_ctr"), F.col("nboi_click_gap_pct")
    p = expected / 100
    variance = n * p * (1 - p)
    return (
        binned.withColumn("expected_ctr", 100 * rate)
        .where(expected.isNotNull())
        .withColumn("position_ctr_residual", F.col("ctr") - expected)
        .withColumn("nboi_click_gap_pct", F.greatest(F.lit(0.0), expected - F.col("ctr")))
        .withColumn("nboi_click_opportunity", gap / 100 * n)
        .withColumn("residual_z_score", F.when(variance > 0, (clicks - n * p) / F.sqrt(variance)))
        .select(*COLUMNS)
    )
