"""Rules by the thousand: a join on literal pieces in place of one long condition.

A text that a LIKE pattern fits contains every run of the pattern's plain
characters, so every piece of such a run. Each rule is filed under the one of
its pieces, of brand or query, that the fewest texts have. Texts meet only
the rules filed under one of their own pieces; those few are tested exactly.
The plan is the same for ten rules as for a million.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from querylens.functions.brands import Rule, any_rule
from querylens.operators.joins import BROADCAST_BYTES, lookup_join
from querylens.sources.scratch import materialize

# Characters of a piece; shorter runs are pieces as they are.
PIECE = 3
# Rules without any plain character in a LIKE pattern, which every text has to be tested for, at most.
UNINDEXED = 64

_RULE = ["rule_brand", "rule_pattern", "rule_field", "rule_regex"]


def rules_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """(brand, pattern, field, regex) of each rule."""
    rows = [(r.brand, r.pattern, r.field, r.regex) for r in rules]
    return spark.createDataFrame(rows, "brand string, pattern string, field string, regex boolean")


def _pieces(text: Column, size: int) -> Column:
    """All runs of ``size`` characters, none of a shorter text or NULL."""
    places = F.sequence(F.lit(1), F.char_length(text) - size + 1)
    found = F.transform(places, lambda i: F.substring(text, i, F.lit(size)))
    return F.when(F.char_length(text) >= size, found).otherwise(F.array().cast("array<string>"))


def _pieces_of_pattern(pattern: Column) -> Column:
    """The pieces that every text has which the LIKE pattern fits. An escaped character ends a run."""
    runs = F.split(pattern, r"(?s)\\.|[%_]")
    whole = F.filter(runs, lambda x: (x != "") & (F.char_length(x) < PIECE))
    return F.array_distinct(F.concat(whole, F.flatten(F.transform(runs, lambda x: _pieces(x, PIECE)))))


def _of_kind(kind: Column, pieces: Column) -> Column:
    return F.transform(pieces, lambda p: F.struct(kind.alias("kind"), p.alias("piece")))


def _rule_pieces(rules: DataFrame) -> DataFrame:
    """The rules with ``pieces``: kind (brand, query or raw) and text of each."""
    none = F.array().cast("array<struct<kind:string,piece:string>>")
    of_query = F.when(F.col("rule_regex"), none).otherwise(_of_kind(F.col("rule_field"), _pieces_of_pattern(F.col("rule_pattern"))))
    return rules.withColumn("pieces", F.concat(_of_kind(F.lit("brand"), _pieces_of_pattern(F.col("rule_brand"))), of_query))


def _text_pieces(texts: DataFrame, keep: Sequence[str]) -> DataFrame:
    """A row for each different piece of each text, with the ``keep`` columns, ``kind`` and ``piece``."""

    def of(kind: str) -> Column:
        sizes = [_pieces(F.col(kind), n) for n in range(1, PIECE + 1)]
        return _of_kind(F.lit(kind), F.array_distinct(F.concat(*sizes)))

    found = F.explode(F.concat(of("brand"), of("query"), of("raw")))
    return texts.select(*keep, found.alias("p")).select(*keep, "p.kind", "p.piece")


def _rarest(rules: DataFrame, texts: DataFrame, max_bytes: int) -> DataFrame:
    """Each rule with the ``kind`` and ``piece`` of its own that the fewest texts have."""
    each = rules.select(*_RULE, F.explode("pieces").alias("p")).select(*_RULE, "p.*")
    each = materialize(each, "rule-pieces")
    asked = materialize(each.select("kind", "piece").distinct(), "asked-pieces")
    counts = lookup_join(_text_pieces(texts, []), asked, ["kind", "piece"], "inner", max_bytes=max_bytes)
    counts = materialize(counts.groupBy("kind", "piece").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counted = lookup_join(each, counts, ["kind", "piece"], max_bytes=max_bytes).fillna({"n": 0})
    # Rules with a piece that no text has fit nothing.
    best = F.min(F.struct("n", F.negative(F.char_length("piece")).alias("longest"), "kind", "piece")).alias("best")
    return counted.groupBy(*_RULE).agg(best).where("best.n > 0").select(*_RULE, "best.kind", "best.piece")


def _fits(text: Column) -> Column:
    found = F.when(F.col("rule_regex"), F.rlike(text, F.col("rule_pattern"))).otherwise(F.like(text, F.col("rule_pattern")))
    return F.like(F.col("brand"), F.col("rule_brand")) & found


def with_any_rule(
    rows: DataFrame,
    rules: DataFrame,
    query: str = "query_cleaned",
    brand: str = "domain_name_cleaned",
    raw: str = "query_raw",
    out: str = "ruled",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``rows`` with ``out``: whether any rule of the table ``rules`` fits.

    The result is that of ``any_rule``, with false where it is NULL. Rules
    that are NULL in any column fit nothing; repeated ones change nothing. A
    regular expression is found by its brand's pieces alone. Rules without a
    plain character on either side are tested on every text; more than
    ``UNINDEXED`` of them raise an error. ``rows`` is read twice.
    """
    named = rules.select("brand", "pattern", "field", "regex").toDF(*_RULE).dropna().distinct()
    named = materialize(_rule_pieces(named), "rules")
    loose = named.where(F.size("pieces") == 0).select(*_RULE).limit(UNINDEXED + 1).collect()
    if len(loose) > UNINDEXED:
        raise ValueError(f"more than {UNINDEXED} rules have no plain character to find them by")
    texts = rows.select(F.col(query).alias("query"), F.col(brand).alias("brand"), F.col(raw).alias("raw"))
    texts = materialize(texts.dropna(subset=["brand"]).distinct(), "ruled-texts")
    index = materialize(_rarest(named.where(F.size("pieces") > 0), texts, max_bytes), "rule-index")
    met = lookup_join(_text_pieces(texts, ["query", "brand", "raw"]), index, ["kind", "piece"], "inner", max_bytes=max_bytes)
    fitting = met.where(F.when(F.col("rule_field") == "raw", _fits(F.col("raw"))).otherwise(_fits(F.col("query"))))
    fitting = fitting.select(F.col("query").alias(query), F.col("brand").alias(brand), F.col("raw").alias(raw)).distinct()
    fitting = materialize(fitting.withColumn(out, F.lit(True)), "ruled")
    found = lookup_join(rows.drop(out), fitting, [query, brand, raw], null_safe=True, max_bytes=max_bytes)
    rest = any_rule([Rule(*r) for r in loose], F.col(query), F.col(brand), F.col(raw))
    return found.withColumn(out, F.coalesce(F.col(out), F.lit(False)) | F.coalesce(rest, F.lit(False)))
