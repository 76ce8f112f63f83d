"""Loading only what is new, and merging it by key."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from querylens.operators.joins import BROADCAST_BYTES, measured_bytes
from querylens.sources.scratch import materialize


def incremental_read(source: DataFrame, target: DataFrame | None, updated: str) -> DataFrame:
    """Source rows later than the latest one in ``target``; all of them if there is none.

    The high-water mark is one value. As a literal it is pushed down to the
    source's file statistics. It travels as text, which no time zone shifts.
    """
    high_water = None if target is None else target.agg(F.max(updated).cast("string")).first()[0]
    if high_water is None:
        return source
    mark = F.lit(high_water).cast(source.schema[updated].dataType)
    return source.where(F.col(updated) > mark)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last by ``order``; the other columns break ties.

    A maximum is combined on the map side, so a key with many rows sends one
    row per task. A window would sort them all in one.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    last = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns])


def reduce_to_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``latest_per_key`` for wide rows, few of which share a key.

    Only the keys are shuffled to find those that occur more than once. If
    they are few, the rows of all other keys stay where they are. A row whose
    key has a NULL is the same as no other and stays, as in ``upsert``.
    """
    names = {c: f"_again_{c}" for c in keys}
    keyed = reduce(Column.__and__, [F.col(c).isNotNull() for c in keys])
    again = df.where(keyed).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)
    again = materialize(again.withColumnsRenamed(names), "again")
    if measured_bytes(again) > BROADCAST_BYTES:
        return latest_per_key(df.where(keyed), keys, order).unionByName(df.where(~keyed))
    same = reduce(Column.__and__, [F.col(c) == F.col(names[c]) for c in keys])
    once = df.join(F.broadcast(again), same, "left_anti")
    several = df.join(F.broadcast(again), same, "left_semi")
    return once.unionByName(latest_per_key(several, keys, order))


def upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``delta`` replacing those of the same key, and the new ones added.

    ``delta`` has one row per key. Nothing is deleted. The result has to go to
    a new location, never over the files it reads.
    """
    replaced = materialize(delta.select(*keys), "replaced")
    if measured_bytes(replaced) <= BROADCAST_BYTES:
        replaced = F.broadcast(replaced)
    return target.join(replaced, list(keys), "left_anti").unionByName(delta)


class LoadTable:
    """A keyed table kept as the loads it received.

    Merging a load appends its rows under ``load=<sequence>-<writer>-<id>``;
    nothing already written is rewritten. Readers drop the rows that a later
    version supersedes; among equal versions the later load counts. A load
    counts once its job has committed, so a failed one can be repeated, and
    one that its writer repeats after it committed changes nothing. Ids of
    different writers never meet.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.order = list(order)

    def loads(self) -> list[str]:
        """Names of the committed loads, in order."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/load=*/_SUCCESS")
        files = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern)
        return sorted(f.getPath().getParent().getName().removeprefix("load=") for f in files or [])

    def _next(self, writer: str, load_id: str) -> str | None:
        """The name of a new load, None if its writer committed it before."""
        names = [name.split("-", 1) for name in self.loads()]
        own = f"{writer}-{load_id}"
        if any(name == own for _, name in names):
            return None
        return f"{max((int(number) for number, _ in names), default=0) + 1:012d}-{own}"

    def merge(self, delta: DataFrame, load_id: str, writer: str = "batch") -> None:
        """Add a load, reduced to the latest row per key, unless ``writer`` has added ``load_id`` before."""
        if name := self._next(writer, load_id):
            rows = reduce_to_latest(delta, self.keys, self.order)
            rows.write.mode("overwrite").parquet(f"{self.path}/load={name}")

    def merge_new(self, source: DataFrame, updated: str) -> None:
        """Add the source rows that are later than everything loaded so far."""
        delta = incremental_read(source, self.rows() if self.loads() else None, updated)
        self.merge(delta, uuid.uuid4().hex, "new")

    def rows(self) -> DataFrame:
        """All rows of all loads, with the ``load`` they came in.

        A column that only some loads have is NULL in the others.
        """
        paths = [f"{self.path}/load={load}" for load in self.loads()]
        if not paths:
            raise ValueError(f"no loads in {self.path}")
        # Ids are kept as text: partition discovery would drop their leading zeros.
        parts = self.spark.read.option("mergeSchema", "true").parquet(*paths)
        return parts.withColumn("load", F.regexp_extract("_metadata.file_path", "/load=([^/]+)/[^/]*$", 1))

    def current(self) -> DataFrame:
        """The latest row of each key.

        Only the keys and versions are shuffled to find the superseded rows;
        the full rows are filtered in place when those are few, as they are
        between compactions.
        """
        rows = self.rows()
        if len(self.loads()) == 1:
            return rows.drop("load")
        version = F.struct(*self.order, "load")
        versions = rows.select(*self.keys, version.alias("version"))
        latest = versions.groupBy(*self.keys).agg(F.max("version").alias("latest"))
        old = versions.join(latest, self.keys).where(F.col("version") < F.col("latest"))
        old = materialize(old.select(*self.keys, F.col("version.load").alias("load")), "superseded")
        if measured_bytes(old) <= BROADCAST_BYTES:
            old = F.broadcast(old)
        return rows.join(old, [*self.keys, "load"], "left_anti").drop("load")

    def compact(self, path: str) -> LoadTable:
        """The current rows as the first load of a new table at ``path``."""
        compacted = LoadTable(self.spark, path, self.keys, self.order)
        self.current().write.mode("overwrite").parquet(f"{compacted.path}/load={0:012d}-compact-{uuid.uuid4().hex}")
        return compacted
