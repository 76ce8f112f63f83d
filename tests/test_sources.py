from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from querylens.sources import scratch
from querylens.sources.contracts import conform, read_label_export, read_search_export, LABEL_EXPORT, SEARCH_EXPORT
from querylens.sources.scan import balanced
from querylens.sources.scratch import materialize, scratch_path
from querylens.sources.sinks import write_clustered, write_full

RAW = (
    "extra int, RESTAURANT_ID bigint, DOMAIN string, _UPDATED_AT timestamp, _CREATED_AT timestamp_ntz,"
    " STATUS string, DATA string"
)


def test_search_export_contract(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([(1, 2, "d", None, None, "ok", "{}")], RAW).write.parquet(path)
    df = read_search_export(spark, path)
    assert df.columns == list(SEARCH_EXPORT)
    assert df.first()["restaurant_id"] == 2


def test_label_export_as_json_and_as_table(spark, tmp_path):
    rows = spark.createDataFrame([("r", '["Thai"]')], "RESTAURANT_ID string, CUISINES string")
    path = str(tmp_path / "labels")
    rows.write.json(path)
    assert read_label_export(spark, path, "json").first()["cuisines"] == '["Thai"]'
    rows.createOrReplaceTempView("label_export")
    assert read_label_export(spark, "label_export", None).columns == list(LABEL_EXPORT)


def test_missing_and_mistyped_columns(spark):
    df = spark.createDataFrame([(1, 2)], "restaurant_id int, cuisines int")
    with pytest.raises(ValueError, match="cuisines is int"):
        conform(df, LABEL_EXPORT)
    with pytest.raises(ValueError, match="missing columns: cuisines"):
        conform(df.drop("cuisines"), LABEL_EXPORT)


def test_full_refresh_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_full(spark.range(5), path)
    write_full(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_clustered_table_reads_only_the_asked_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(g, t, i) for g in ("restaurant", "cuisine", "global") for t in ("Branded", "Unbranded") for i in range(3)]
    write_clustered(spark.createDataFrame(rows, "grain string, search_type string, n int"), path)
    df = spark.read.parquet(path).where("grain = 'cuisine' AND search_type = 'Branded'")
    assert df.count() == 3
    assert len({r[0] for r in df.select(F.input_file_name()).distinct().collect()}) >= 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(grain" in plan
    assert all("grain=cuisine/search_type=Branded" in r[0] for r in df.select(F.input_file_name()).collect())


def test_scratch_is_under_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert scratch_path(spark, "x").startswith(root.rstrip("/") + "/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


class _Cluster:
    """A session that names no shared folder and is not local."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"


def test_no_local_scratch_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(_Cluster(), "x")
    _Cluster.sparkContext.master = "local[2]"
    assert scratch_path(_Cluster(), "x").startswith(scratch._local_root())


def test_materialize(spark):
    df = materialize(spark.range(10).withColumn("s", F.lit("x")), "t")
    assert df.count() == 10
    assert "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()


def test_balanced(spark):
    cores = spark.sparkContext.defaultParallelism
    assert balanced(spark.range(100).coalesce(1)).rdd.getNumPartitions() == cores
    large = spark.range(0, 100, numPartitions=cores + 5)
    assert balanced(large) is large
