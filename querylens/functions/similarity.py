"""Jaro-Winkler similarity as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Fixed values of the measure: weight and length of the common prefix, and the score above which it counts.
PREFIX_WEIGHT = 0.1
PREFIX_LENGTH = 4
BOOST_ABOVE = 0.7

_USED = "\u0001"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _char(text: Column, i: Column) -> Column:
    return F.substr(text, i, F.lit(1))


def _common_prefix(a: Column, b: Column) -> Column:
    lengths = range(PREFIX_LENGTH, 0, -1)
    shared = [
        F.when((F.length(a) >= k) & (F.left(a, F.lit(k)) == F.left(b, F.lit(k))), F.lit(k)) for k in lengths
    ]
    return F.coalesce(*shared, F.lit(0))


def _boost(jaro: Column, a: Column, b: Column) -> Column:
    boosted = jaro + PREFIX_WEIGHT * _common_prefix(a, b) * (1 - jaro)
    return F.when(jaro > BOOST_ABOVE, boosted).otherwise(jaro)


def _match_positions(a: Column, b: Column) -> Column:
    """Positions in ``b`` matched by the characters of ``a``, in the order of ``a``.

    Each character of ``a`` takes the first equal, still free character of
    ``b`` at most ``reach`` places away.
    """
    half = F.floor(F.greatest(F.length(a), F.length(b)) / 2).cast("int")

    def walk(reach: Column) -> Column:
        def take(state: Column, i: Column) -> Column:
            at = F.call_function("locate", _char(a, i), state["free"], F.greatest(i - reach, F.lit(1)))
            return _let(
                at,
                lambda found: F.when(
                    (found > 0) & (found <= i + reach),
                    F.struct(
                        F.overlay(state["free"], F.lit(_USED), found, F.lit(1)).alias("free"),
                        F.array_append(state["matched"], found).alias("matched"),
                    ),
                ).otherwise(state),
            )

        start = F.struct(b.alias("free"), F.array().cast("array<int>").alias("matched"))
        return F.aggregate(F.sequence(F.lit(1), F.length(a)), start, take, lambda state: state["matched"])

    return _let(F.greatest(half - 1, F.lit(0)), walk)


def jaro(a: Column, b: Column) -> Column:
    def score(matched: Column) -> Column:
        m = F.size(matched)
        pairs = F.zip_with(matched, F.sort_array(matched), lambda x, y: _char(b, x) != _char(b, y))
        moved = F.floor(F.size(F.filter(pairs, lambda differs: differs)) / 2)
        mean = (m / F.length(a) + m / F.length(b) + (m - moved) / m) / 3
        return F.when(m == 0, F.lit(0.0)).otherwise(mean)

    empty = (F.length(a) == 0) | (F.length(b) == 0)
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(empty, F.lit(0.0))
        .otherwise(_let(_match_positions(a, b), score))
    )


def jaro_winkler(a: Column, b: Column) -> Column:
    """Similarity from 0 to 1; NULL if either text is NULL."""

    # Expressions over columns would be evaluated anew in each step; over a bound pair they are not.
    def of(pair: Column) -> Column:
        return _let(jaro(pair["a"], pair["b"]), lambda j: _boost(j, pair["a"], pair["b"]))

    return _let(F.struct(a.alias("a"), b.alias("b")), of)


def jaro_winkler_at_least(a: Column, b: Column, threshold: float) -> Column:
    """``jaro_winkler(a, b) >= threshold``, skipping pairs that cannot reach it.

    No more characters can match than occur in the other text at all; the
    score with that many matches, all in order, is an upper bound that needs
    no walk over the text.
    """

    def occurring(x: Column, y: Column) -> Column:
        return F.length(x) - F.length(F.call_function("translate", x, y, F.lit("")))

    most = F.least(occurring(a, b), occurring(b, a))
    # Not guarded by a condition: the planner may compute a repeated division ahead of it.
    ceiling = (F.try_divide(most, F.length(a)) + F.try_divide(most, F.length(b)) + 1) / 3
    empty = (F.length(a) == 0) | (F.length(b) == 0)
    hopeless = empty | (_boost(ceiling, a, b) < threshold - 1e-9)
    return ~hopeless & (jaro_winkler(a, b) >= threshold)
