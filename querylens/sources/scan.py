"""Number of tasks for work that is heavy on the CPU."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The last wave of tasks leaves cores idle for one task's time at most, so small tasks waste little.
TASKS_PER_CORE = 4


def balanced(table: DataFrame) -> DataFrame:
    """Spread a table scan that has fewer splits than there are cores over all cores.

    For scans ahead of work that is heavy on the CPU, such as JSON parsing or
    text matching. A large table has more splits and is left as it is.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def heavy_tasks(spark: SparkSession) -> int:
    """Tasks for a shuffle ahead of such work: the session's number, or a few a core if that is more.

    A shuffle that is given its number of tasks keeps it. Spark merges others
    by their bytes, at best to about one task a core, often to one more: then the
    cores wait for the last one, which takes as long as all before it.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
