"""Rules that decide whether a query names the brand.

``query`` is the cleaned query, ``brand`` the name left of the domain, ``raw``
the query as it was searched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, functions as F

from querylens.functions.similarity import jaro_winkler, jaro_winkler_at_least

# Fixed value: similarity, from 0 to 100, from which a query names the brand.
SIMILARITY_THRESHOLD = 78

# Queries that are too general to name a brand.
GENERIC_QUERIES = (
    "tandor", "viet", "pasta", "latino", "egg", "india", "bahn", "cuisine", "waffles", "pizza", "restaurant",
    "express", "bar", "grill", "bakery", "spice", "best delivery pizza chicago", "pastery", "fries", "salad",
    "bagel", "bistro", "burger", "shawarma", "taqueria", "hibachi", "chicken", "taco", "teriyaki", "noodles",
    "burrito", "vietnam", "pastry",
)


@dataclass(frozen=True)
class Rule:
    """A test of the brand together with a test of the query.

    ``brand`` and ``pattern`` are LIKE patterns, except that ``regex`` makes
    ``pattern`` a regular expression found anywhere in the text. ``field``
    says which text is tested, ``query`` or ``raw``.
    """

    brand: str
    pattern: str
    field: str = "query"
    regex: bool = False

    def test(self, query: Column, brand: Column, raw: Column) -> Column:
        text = {"query": query, "raw": raw}[self.field]
        found = text.rlike(self.pattern) if self.regex else text.like(self.pattern)
        return brand.like(self.brand) & found


# Pairs that are not the brand although the texts are alike.
EXCLUSIONS = (
    Rule("flavorsofindia", "flavorful%", field="raw"),
    Rule("%", "delivery pizza%"),
    Rule("smashsd", "smash%burger%"),
)

# Pairs that are the brand whatever the other rules say.
OVERRIDES = (
    Rule("mediterranean%", "mediterranean"),
    Rule("%aandr%", r"a\s*&\s*r", field="raw", regex=True),
    Rule("pizzayourway", "%my pie%"),
    Rule("tbmx1", "%tacos and beer%"),
    Rule("hhboiledbagels", "%henry higgins%"),
    Rule("tharealgoodfellas", "%goodfellas%"),
    Rule("saigon8vegas", "%saigon 8%"),
    Rule("tmvrestaurants", "%the modern vegan%"),
    Rule("delawarepubandgrill", "the delaware%"),
    Rule("thesombrero", "%sombrero%"),
    Rule("thechubbfather", "%chubbfather%"),
    Rule("aaruz", "%aarus%"),
    Rule("stadiumpepz", "(?i)pep[sz]", regex=True),
    Rule("3happinessomaha", r"(?i)threes?|three\s+happiness", regex=True),
    Rule("dialogcafe", "(?i)dialog|dialogue", regex=True),
)


def any_rule(rules: Sequence[Rule], query: Column, brand: Column, raw: Column) -> Column:
    return reduce(Column.__or__, [r.test(query, brand, raw) for r in rules], F.lit(False))


def similarity(query: Column, brand: Column) -> Column:
    """Jaro-Winkler similarity from 0 to 1, ignoring case."""
    return jaro_winkler(F.lower(query), F.lower(brand))


def match_fuzzy(query: Column, brand: Column, threshold: float = SIMILARITY_THRESHOLD) -> Column:
    return jaro_winkler_at_least(F.lower(query), F.lower(brand), threshold / 100)


def match_substring(query: Column, brand: Column) -> Column:
    """Either text contains the other, the query without its spaces."""
    joined = F.translate(query, " ", "")
    return F.contains(joined, brand) | F.contains(brand, joined)


def match_tokens(query: Column, brand: Column, raw: Column) -> Column:
    """At least two of the first three words, each longer than a letter, occur in the brand.

    Not for searches near a place, nor for those in which "india" and "in"
    follow each other both ways round.
    """
    words = F.split(query, " ")

    def counts(i: int) -> Column:
        word = F.get(words, F.lit(i))
        return F.when((F.length(word) > 1) & F.contains(brand, word), 1).otherwise(0)

    nearby = raw.like("%near me%")
    india = raw.like("%india% in%") & raw.like("%in% india%")
    return (counts(0) + counts(1) + counts(2) >= 2) & ~nearby & ~india


def match_prefix(query: Column, brand: Column, min_prefix_len: int = 1) -> Column:
    """The brand starts with the query's first word, ignoring case."""
    word = F.get(F.split(query, " "), F.lit(0))
    starts = F.startswith(F.lower(brand), F.lower(word))
    return starts & (F.length(word) >= min_prefix_len) if min_prefix_len > 1 else starts


def exclude_false_positives(query: Column, brand: Column, raw: Column, label: Column) -> Column:
    """True for queries that are general; ``label`` is the cuisine name equal to the query, if any."""
    return (
        (F.length(query) <= 1)
        | label.isNotNull()
        | query.isin(*GENERIC_QUERIES)
        | any_rule(EXCLUSIONS, query, brand, raw)
    )


def brand_overrides(query: Column, brand: Column, raw: Column, rules: Sequence[Rule] = OVERRIDES) -> Column:
    return any_rule(rules, query, brand, raw)
