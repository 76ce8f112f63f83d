"""Query and brand text cleaning."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

# The patterns removed from a query, in this order.
EXTRANEOUS_TERMS = (
    r"(near me| a | around me|menu|'|buffet|open now|food|deliver(y|s)?|gift cards?( (online|balance))?)"
)
PRICES_AND_AMPERSAND = r"\$[0-9]+|&"
# All but lower-case letters, digits and spaces. Java finds a class of single characters
# many times faster than one of ranges when several threads use it.
OTHER_CHARACTERS = f"[^{string.ascii_lowercase}{string.digits} ]"
SPACES = r"\s+"
TRAILING_S = "s$"

# The patterns removed from a domain to leave the brand.
DOMAIN_SUFFIX = r"\.[a-z]+$"
DOMAIN_SEPARATORS = "[-_]"

# A word boundary that counts only ASCII letters, digits and underscore as word characters.
# What \b counts depends on the Java release.
_EDGE = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"


def normalize_query(query: Column, lowercase_first: bool = False) -> Column:
    """The query text that is compared with brands.

    Capitals are removed with the other characters unless ``lowercase_first``
    is set; the lower-casing step itself comes after that removal.
    """
    text = F.lower(query) if lowercase_first else query
    for pattern, replacement in (
        (_EDGE + EXTRANEOUS_TERMS + _EDGE, ""),
        (PRICES_AND_AMPERSAND, ""),
        (OTHER_CHARACTERS, ""),
        (SPACES, " "),
    ):
        text = F.regexp_replace(text, pattern, replacement)
    return F.trim(F.regexp_replace(F.lower(text), TRAILING_S, ""))


def brand_name(domain: Column) -> Column:
    """The domain without its last suffix, hyphens and underscores as spaces."""
    return F.regexp_replace(F.regexp_replace(domain, DOMAIN_SUFFIX, ""), DOMAIN_SEPARATORS, " ")
