"""Document fingerprints: all shingle hashes below a fixed fraction of the hash range, as DataFrame expressions.

Whether a shingle is kept depends on its hash alone. So the sketch of a union
is the union of the sketches, and the share of one text's shingles that
another contains can be told from the sketches, however unequal their lengths.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from querylens.sources.scratch import materialize

SHINGLE = 5
FRACTION = 0.25
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """Hashes of the runs of ``size`` words, in order; one of all words if there are fewer, none without words."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATORS)

    def hashes(found: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(found) - size)
        runs = F.transform(at, lambda i: F.xxhash64(*[F.get(found, i + j) for j in range(size)]))
        whole = F.transform(F.array(found), lambda x: F.xxhash64(x))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(found) >= size, runs).when(F.size(found) > 0, whole).otherwise(none)

    return _let(F.filter(parts, lambda x: x != ""), hashes)


def sketch(text: Column, size: int = SHINGLE, fraction: float = FRACTION) -> Column:
    """The distinct shingle hashes in the lowest ``fraction`` of the range, sorted.

    NULL and empty texts, and those without words, have an empty sketch; a
    short one may have. Equal texts have equal sketches.
    """
    if fraction >= 1:
        kept = shingle_hashes(text, size)
    else:
        below = F.lit(int(fraction * (1 << 64)) - (1 << 63))
        kept = F.filter(shingle_hashes(text, size), lambda h: h < below)
    return F.array_sort(F.array_distinct(kept))


def merged(left: Column, right: Column) -> Column:
    """The sketch of two texts together."""
    return F.array_sort(F.array_union(left, right))


def containment(left: Column, right: Column) -> Column:
    """Estimated share of the left text's shingles that are in the right one; 0 if the left sketch is empty."""
    common = F.size(F.array_intersect(left, right))
    return F.when(F.size(left) > 0, common / F.size(left)).otherwise(0.0)


def resemblance(left: Column, right: Column) -> Column:
    """Estimated Jaccard similarity of the shingles; 1 if both sketches are empty, as they are equal then."""

    def share(common: Column) -> Column:
        both = F.size(left) + F.size(right) - common
        return F.when(both > 0, common / both).otherwise(1.0)

    return _let(F.size(F.array_intersect(left, right)), share)


def as_text(hashes: Column) -> Column:
    """A sketch as hexadecimal digits, 16 for each hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _numbered_ranges(rows: DataFrame) -> DataFrame:
    """``rows`` with ``bucket``: ranges of ascending ``doc_id`` of about equal numbers of rows; -1 for NULL.

    Their number grows with the square root of the rows, so the ranges and the
    rows in one stay few together.
    """
    n = 4 * math.isqrt(rows.count()) + 1
    inner = [i / n for i in range(1, n)]
    cuts = rows.select(F.col("doc_id").cast("double").alias("d")).approxQuantile("d", inner, 0.5 / n) if n > 1 else []
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    if len(splits) == 2:
        return rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(0))
    place = Bucketizer(splits=splits, inputCol="d", outputCol="place", handleInvalid="keep")
    placed = place.transform(rows.withColumn("d", F.col("doc_id").cast("double"))).drop("d")
    return placed.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(F.col("place").cast("int"))).drop("place")


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch): each document beside the one after it in descending order of ids.

    The document after the last is the first; a single document follows
    itself. NULL ids come last, rows with the same id in descending order of a
    hash of their texts. NULL texts become empty.

    Documents are grouped by ranges of their ids and shuffled once. The first
    document of each range goes along to the range before it. That list has
    one row per range, some four times the square root of the rows, and is broadcast.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    placed = _numbered_ranges(rows).withColumn("tie", F.xxhash64("text"))
    heads = placed.groupBy("bucket").agg(F.max(F.struct("doc_id", "tie")).alias("head"))
    above = F.lead("bucket").over(W.orderBy("bucket"))
    first = F.min("bucket").over(W.partitionBy())
    heads = materialize(heads.select("bucket", "head", F.coalesce(above, first).alias("guest_of")), "range-heads")

    is_head = F.col("p.bucket").eqNullSafe(F.col("h.bucket")) & F.struct("p.doc_id", "p.tie").eqNullSafe(F.col("h.head"))
    placed = placed.alias("p").join(F.broadcast(heads.alias("h")), is_head, "left")
    own = F.struct(F.col("p.bucket").alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("h.guest_of").alias("bucket"), F.lit(True).alias("guest"))
    places = F.when(F.col("h.guest_of").isNull(), F.array(own)).otherwise(F.array(own, guest))
    dealt = placed.select("p.doc_id", "p.text", "p.tie", F.explode(places).alias("at")).select("doc_id", "text", "tie", "at.*")
    dealt = dealt.repartition("bucket").withColumn("sketch", sketch(F.col("text")))
    order = [F.col("guest"), F.col("doc_id").desc_nulls_last(), F.col("tie").desc()]
    following = W.partitionBy("bucket").orderBy(*order)
    shown = dealt.withColumn("next_text", F.lead("text").over(following))
    shown = shown.withColumn("next_sketch", F.lead("sketch").over(following)).where("not guest")
    return shown.select("doc_id", "text", "sketch", "next_text", "next_sketch")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, sketch) of each row of ``docs``; cases as in ``sketch``."""
    return docs.select(F.col(doc_id).alias("doc_id"), sketch(F.col(text)).alias("sketch"))
