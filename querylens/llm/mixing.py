"""Mixing sources to target weights, as DataFrame operations only.

Every document gets a hash-random key. Keys are uniform, so equal slices of
their range hold about equally many documents of a source: each source is cut
into such ranges, a task sorts one range, and sums of ranges give each range
its start. The place where the running sum meets the source's budget is a key,
and a document is taken when its own key is not beyond it. Texts are read
twice and never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from querylens.operators.joins import lookup_join
from querylens.sources.scratch import materialize

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix"


def n_tokens(text: Column) -> Column:
    """Number of runs without white space; 0 for NULL."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     "), " ")
    return F.size(F.filter(parts, lambda x: x != "")).cast("long")


def random_key(doc_id: str, text: str, seed: str) -> Column:
    """Hash of a document's id and text, uniform over 32 hexadecimal digits."""
    known = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.md5(F.concat_ws("|", F.lit(seed), known, F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))))


def source_targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``totals`` (source, source_size) with each source's target.

    Sources in order of their code points, NULL last, take the weights in
    turn. All targets add up to all sizes; none is above ``max_epochs`` times
    its source's size, and what is cut off there is shared out by weight among
    the others. In order of the share at which a source meets its limit, the
    limited ones come first, so running sums find them.
    The table has one row per source.
    """
    cap = (F.col("source_size") * max_epochs).alias("cap")
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    shares = totals.withColumn("cap", cap).withColumn("weight", weight.cast("long"))
    by_limit = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    later = by_limit.rowsBetween(0, W.unboundedFollowing)
    before = by_limit.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    shares = (
        shares.withColumn("total", F.sum("source_size").over(every))
        .withColumn("left_weight", F.sum("weight").over(later))
        .withColumn("left_total", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("limited", F.col("cap") * F.col("left_weight") <= F.col("left_total") * F.col("weight"))
    )
    free_total = F.col("total") - F.sum(F.when(F.col("limited"), F.col("cap")).otherwise(0)).over(every)
    free_weight = F.sum(F.when(F.col("limited"), 0).otherwise(F.col("weight"))).over(every)
    share = free_total.cast("double") * F.col("weight") / free_weight
    target = F.when(F.col("limited"), F.col("cap").cast("double")).otherwise(share)
    return shares.select("source", "source_size", target.alias("target"))


def source_cuts(sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: its size, target, whole ``epochs``, and the last key (``cut``) of the part of an epoch after them.

    ``sized`` is a stored table (source, key, size) with one row per document.
    The number of ranges is the square root of the number of rows, so both the
    rows of a range and the ranges of a source stay small together.
    """
    ranges = math.isqrt(sized.count()) + 1
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = source_targets(totals, weights, max_epochs).withColumn("epochs", epochs.cast("long"))
    targets = targets.withColumn("part", F.col("target") - F.col("epochs") * F.col("source_size"))

    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") * ranges / float(1 << 32)
    same = sized.groupBy("source", "key", "size").agg((F.count(F.lit(1)) * F.col("size")).alias("tokens"))
    same = same.withColumn("range", F.floor(place).cast("int"))
    sums = same.groupBy("source", "range").agg(F.sum("tokens").alias("tokens"))
    earlier = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("source", "range", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("start"))
    starts = starts.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
    starts = starts.select("s.source", "s.range", "s.start", "t.part").alias("s")

    within = W.partitionBy("source", "range").orderBy("key", "size").rowsBetween(W.unboundedPreceding, -1)
    inside = same.withColumn("inside", F.coalesce(F.sum("tokens").over(within), F.lit(0))).alias("d")
    at = (F.col("s.start") + F.col("d.inside")) * 2 + F.col("d.tokens")
    of_range = F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.range") == F.col("s.range"))
    taken = inside.join(starts, of_range).where(at < F.col("s.part") * 2)
    cuts = taken.groupBy(F.col("d.source").alias("source")).agg(F.max(F.struct("d.key", "d.size")).alias("cut"))
    cuts = cuts.alias("c")
    joined = targets.alias("t").join(cuts, F.col("t.source").eqNullSafe(F.col("c.source")), "left")
    return joined.select("t.source", "t.source_size", "t.target", "t.epochs", "c.cut")


def _with_copies(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    part = F.coalesce(F.struct("key", "size") <= F.col("cut"), F.lit(False)).cast("long")
    joined = lookup_join(rows, materialize(cuts, "mix-cuts"), ["source"], null_safe=True)
    return joined.withColumn("copies", F.col("epochs") + part).drop("epochs", "cut")


def _sized(docs: DataFrame, doc_id: str, text: str, source: str, seed: str) -> DataFrame:
    return docs.select(
        F.col(source).alias("source"),
        F.col(doc_id).alias("doc_id"),
        random_key(doc_id, text, seed).alias("key"),
        n_tokens(F.col(text)).alias("size"),
    )


def mix_plan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """How often the mix takes each document: (source, doc_id, key, size, source_size, target, copies).

    One row per row of ``docs``; whole documents are taken, and a source's
    taken tokens differ from its target by half a document at most. NULL
    source is a source of its own; a NULL text has no tokens and is taken with
    the same rule; NULL ids are told apart by their texts. Rows equal in id
    and text are taken or left together. An empty table gives an empty one.
    Other columns of ``docs`` are not read.
    """
    sized = materialize(_sized(docs, doc_id, text, source, seed), "mix-sizes")
    return _with_copies(sized, source_cuts(sized.select("source", "key", "size"), weights, max_epochs))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """The mixed documents: the columns of ``docs``, each row as often as the mix takes it.

    Cases as in ``mix_plan``. Rows are repeated where they are; texts are not shuffled.
    """
    sized = materialize(_sized(docs, doc_id, text, source, seed).select("source", "key", "size"), "mix-sizes")
    cuts = source_cuts(sized, weights, max_epochs)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(
        row, F.col(source).alias("source"), random_key(doc_id, text, seed).alias("key"), n_tokens(F.col(text)).alias("size")
    )
    taken = _with_copies(rows, cuts).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
