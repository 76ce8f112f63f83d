"""Nested JSON exports to flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from querylens.functions.variant import variant_bigint, variant_double, variant_string, with_members


def flatten_search_export(raw: DataFrame) -> DataFrame:
    """One row per search query in each export document.

    Malformed documents, and those without records, give no rows. A value of
    the wrong type becomes NULL.
    """
    record = F.col("record")
    read, records = with_members(raw.select("restaurant_id", "domain", "data"), "data", "rows")
    return read.select("restaurant_id", "domain", F.explode(records).alias("record")).select(
        "restaurant_id",
        "domain",
        variant_bigint(record, "$.clicks").alias("clicks"),
        variant_double(record, "$.ctr").alias("ctr"),
        variant_bigint(record, "$.impressions").alias("impressions"),
        variant_double(record, "$.position").alias("position"),
        F.trim(variant_string(record, "$.keys[0]")).alias("query"),
    )


def flatten_labels(raw: DataFrame) -> DataFrame:
    """One row per cuisine in each restaurant's list, repeats included."""
    read, names = with_members(raw.select("restaurant_id", "cuisines"), "cuisines")
    return read.select("restaurant_id", F.explode(names).alias("name")).select(
        "restaurant_id", F.btrim(variant_string(F.col("name"), "$"), F.lit('" ')).alias("cuisine")
    )


def label_names(labels: DataFrame) -> DataFrame:
    return labels.select("cuisine").distinct()
