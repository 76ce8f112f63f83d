"""Branded and unbranded search queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from querylens.functions.brands import (
    OVERRIDES,
    SIMILARITY_THRESHOLD,
    Rule,
    brand_overrides,
    exclude_false_positives,
    match_fuzzy,
    match_prefix,
    match_substring,
    match_tokens,
    similarity,
)
from querylens.functions.text import brand_name, normalize_query
from querylens.operators.joins import BROADCAST_BYTES, lookup_join
from querylens.operators.rule_index import with_any_rule
from querylens.sources.scratch import materialize

BRANDED = "Branded"
UNBRANDED = "Unbranded"


def clean_queries(queries: DataFrame, lowercase_first: bool = False) -> DataFrame:
    """Add the cleaned query and the brand; the query itself becomes ``query_raw``."""
    return queries.withColumnRenamed("query", "query_raw").withColumns(
        {
            "query_cleaned": normalize_query(F.col("query_raw"), lowercase_first),
            "domain_name_cleaned": brand_name(F.col("domain")),
        }
    )


def with_label_match(
    cleaned: DataFrame, names: DataFrame, lower_names: bool = False, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``label``: the cuisine name equal to the cleaned query, else NULL.

    Names are compared as written unless ``lower_names`` is set.
    """
    name = F.lower("cuisine") if lower_names else F.col("cuisine")
    known = names.select(name.alias("query_cleaned")).where(F.col("query_cleaned").isNotNull()).distinct()
    known = known.withColumn("label", F.col("query_cleaned"))
    return lookup_join(cleaned, materialize(known, "names"), ["query_cleaned"], max_bytes=max_bytes)


def classify_queries(
    queries: DataFrame,
    names: DataFrame,
    rules: Sequence[Rule] | DataFrame = OVERRIDES,
    with_score: bool = True,
    lowercase_first: bool = False,
    lower_names: bool = False,
    min_prefix_len: int = 1,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``search_type`` to queries of a ``domain``.

    Branded means: the query matches the brand by similarity, substring, words
    or prefix and is not a general one, or an override says so. Anything that
    cannot be decided is unbranded. Without ``with_score`` the similarity is
    only computed where the cheaper rules leave the answer open. ``rules`` may
    be a table of any number of them (brand, pattern, field, regex), which is joined.
    """
    cleaned = clean_queries(queries, lowercase_first)
    kept = cleaned.columns
    query, brand, raw = F.col("query_cleaned"), F.col("domain_name_cleaned"), F.col("query_raw")
    labelled = with_label_match(cleaned, names, lower_names, max_bytes)
    if with_score:
        labelled = labelled.withColumn("_similarity", similarity(query, brand))
        kept = [*kept, (100 * F.col("_similarity")).alias("jarrow_similarity")]
        fuzzy = F.col("_similarity") >= SIMILARITY_THRESHOLD / 100
    else:
        fuzzy = match_fuzzy(query, brand)
    matches = (
        match_substring(query, brand)
        | match_prefix(query, brand, min_prefix_len)
        | match_tokens(query, brand, raw)
        | fuzzy
    )
    general = exclude_false_positives(query, brand, raw, F.col("label"))
    if isinstance(rules, DataFrame):
        labelled = with_any_rule(labelled, rules, out="_ruled", max_bytes=max_bytes)
        overridden = F.col("_ruled")
    else:
        overridden = brand_overrides(query, brand, raw, rules)
    branded = (~general & matches) | overridden
    return labelled.select(*kept, F.when(branded, BRANDED).otherwise(UNBRANDED).alias("search_type"))


def classify_each_once(queries: DataFrame, names: DataFrame, rules: Sequence[Rule] = OVERRIDES) -> DataFrame:
    """``classify_queries`` with scores for raw rows: each pair of query and domain is scored once and looked up.

    The pairs are stored. Rows come back in the same columns and numbers.
    """
    pairs = classify_queries(queries.select("query", "domain").distinct(), names, rules)
    rows = queries.withColumnRenamed("query", "query_raw")
    return lookup_join(rows, materialize(pairs, "classified-pairs"), ["query_raw", "domain"], null_safe=True)
