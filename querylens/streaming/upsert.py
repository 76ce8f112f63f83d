"""Merging files into a keyed table as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from querylens.sources.incremental import LoadTable


def read_file_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Parquet files under ``path`` as a stream, at most ``max_files`` per batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_upsert(source: DataFrame, table: LoadTable, checkpoint: str) -> StreamingQuery:
    """Merge all rows that are available now, then stop.

    The checkpoint takes the place of the high-water mark. Each batch is one
    load named after the checkpoint's id and its own, so a batch repeated after
    a failure is merged once, and a stream with a new checkpoint adds its own loads; rows are ordered by version, so late files do not undo newer ones.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        table.merge(batch, f"{batch_id:012d}", f"stream-{query_id}")

    return (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
