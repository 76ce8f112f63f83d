"""Result tables: full refresh and clustered by the columns that are filtered most."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

CLUSTER_BY = ("grain", "search_type")


def write_full(df: DataFrame, path: str) -> None:
    """Replace the table at ``path`` with ``df``."""
    df.write.mode("overwrite").parquet(path)


def write_clustered(df: DataFrame, path: str, by: Sequence[str] = CLUSTER_BY) -> None:
    """Replace the table at ``path``, one folder per value pair, so that filters on ``by`` read only their folders.

    The tasks keep their own partitioning: each writes at most one file per
    pair, and no pair's rows are gathered into one task.
    """
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
