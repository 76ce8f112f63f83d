from __future__ import annotations

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from querylens.operators import metrics

SCHEMA = (
    "restaurant_id bigint, domain string, clicks bigint, impressions bigint, position double,"
    " query_raw string, search_type string"
)


def sample(n: int = 400) -> list[tuple]:
    rng = random.Random(3)
    rows = []
    for _ in range(n):
        r = rng.choice([1, 1, 1, 2, 3, 4, None])
        domain = rng.choice(["a.com", "b.com"]) if r == 1 else f"{r}.com"
        impressions = rng.choice([0, 0, 1, 5, 50]) if r != 4 else 0
        clicks = rng.choice([0, 1, 3, None]) if r != 3 else 0
        position = rng.choice([1.0, 2.0, 7.0, None])
        query = rng.choice(["a", "b", "c", "d", None])
        rows.append((r, domain, clicks, impressions, position, query, rng.choice(["Branded", "Unbranded"])))
    return rows


LABELS = [(1, "Thai"), (1, "Pizza"), (2, "Thai"), (2, "Thai"), (4, "Soup"), (9, "Cake"), (None, "Nobody"), (2, None)]


def total(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def pct(part, whole):
    if part is None or not whole:
        return None
    return float((Decimal(100) * part / whole).quantize(Decimal("0.01"), ROUND_HALF_UP))


def mean(weight, n):
    return None if weight is None or not n else round(weight / n, 9)


def expected(rows, labels):
    """The three grains computed row by row."""
    groups = defaultdict(list)
    for r, domain, clicks, impressions, position, query, kind in rows:
        weight = None if position is None else position * impressions
        groups[r, domain, kind].append((clicks, impressions, weight, query))
    entities = {}
    for key, members in groups.items():
        clicks, impressions, weights, queries = zip(*members, strict=True)
        distinct = len(set(queries) - {None})
        entities[key] = [distinct, total(clicks), total(impressions), total(weights)]

    def add(target, key, sums, times=1):
        old = target.get(key, [None] * 4)
        scaled = [None if s is None else s * times for s in sums]
        target[key] = [total(pair) for pair in zip(old, scaled, strict=True)]

    cuisines, overall = {}, {}
    for (r, _, kind), sums in entities.items():
        add(overall, (None, kind), sums)
        for owner, cuisine in labels:
            if owner is not None and owner == r:
                add(cuisines, (cuisine, kind), sums)

    def present(grain, items):
        # items: parent, (restaurant, cuisine, type, domain), sums
        parents = defaultdict(lambda: [None] * 4)
        for parent, _, sums in items:
            parents[parent] = [total(p) for p in zip(parents[parent], sums, strict=True)]
        for parent, (r, cuisine, kind, domain), (n, c, i, w) in items:
            whole = parents[parent]
            yield (
                grain, None if r is None else str(r), cuisine, kind, domain, n, c, i, pct(c, i), mean(w, i),
                pct(n, whole[0]), pct(c, whole[1]), pct(i, whole[2]),
            )

    yield from present("restaurant", [(k[0], (k[0], None, k[2], k[1]), s) for k, s in entities.items()])
    yield from present("cuisine", [(k[0], (None, k[0], k[1], None), s) for k, s in cuisines.items()])
    yield from present("global", [(0, (None, None, k[1], None), s) for k, s in overall.items()])


def rows_of(df):
    result = []
    for r in df.select(*metrics.UNIFIED).collect():
        values = list(r)
        values[9] = None if values[9] is None else round(values[9], 9)
        result.append(tuple(values))
    return sorted(result, key=str)


@pytest.fixture(scope="module")
def classified(spark):
    return spark.createDataFrame(sample(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "restaurant_id bigint, cuisine string")


@pytest.fixture(scope="module")
def unified(classified, labels):
    return metrics.unified_metrics(classified, labels)


def test_equals_row_by_row(unified):
    assert rows_of(unified) == sorted(expected(sample(), LABELS), key=str)


def test_collapsed_rows_give_the_same(classified, labels):
    # The class must follow from the query and domain for this.
    from pyspark.sql import functions as F

    kind = F.when(F.coalesce("query_raw", F.lit("a")).isin("a", "b"), "Branded").otherwise("Unbranded")
    plain = classified.withColumn("search_type", kind)
    collapsed = metrics.collapse_queries(plain.withColumnRenamed("query_raw", "query"))
    collapsed = collapsed.withColumnRenamed("query", "query_raw").withColumn("search_type", kind)
    assert rows_of(metrics.unified_metrics(collapsed, labels)) == rows_of(metrics.unified_metrics(plain, labels))


def test_shares_add_up(unified):
    rows = unified.collect()
    for grain, parent in (("restaurant", "restaurant_id"), ("cuisine", "cuisine"), ("global", "grain")):
        sums = defaultdict(list)
        for r in rows:
            if r["grain"] == grain:
                sums[r[parent]].append(r["pct_unique_search_queries"])
        for values in sums.values():
            assert abs(sum(values) - 100) <= 0.01 * len(values)


def test_global_is_the_sum_of_restaurants(unified):
    rows = unified.collect()
    for c in ("search_query_count", "total_clicks", "total_impressions"):
        by_grain = {
            g: sum(r[c] or 0 for r in rows if r["grain"] == g) for g in ("restaurant", "global", "cuisine")
        }
        assert by_grain["global"] == by_grain["restaurant"]


def test_views(unified):
    restaurants = metrics.restaurant_metrics(unified)
    assert restaurants.columns == ["restaurant_id", "domain", "search_type", *metrics.METRICS]
    cuisines = metrics.cuisine_metrics(unified)
    assert cuisines.columns == ["cuisine", "search_type", *metrics.METRICS]
    found = [(r["cuisine"], r["search_type"]) for r in cuisines.collect()]
    assert found == sorted(found, key=lambda t: (t[0] is None, t[0] or "", t[1]))
    assert found[-1][0] is None


def test_types(unified):
    kinds = {f.name: f.dataType.simpleString() for f in unified.schema.fields}
    assert kinds["restaurant_id"] == kinds["cuisine"] == kinds["domain"] == "string"
    assert kinds["search_query_count"] == kinds["total_clicks"] == "bigint"
    assert kinds["ctr"] == kinds["avg_position"] == kinds["pct_clicks"] == "double"


def test_exact_distinct(classified, labels, unified):
    exact = {
        (r["grain"], r["cuisine"], r["search_type"]): r["search_query_count"]
        for r in metrics.unified_metrics(classified, labels, exact_distinct=True).collect()
        if r["grain"] != "restaurant"
    }
    wanted = defaultdict(set)
    for r, _, _, _, _, query, kind in sample():
        wanted["global", None, kind].add(query)
        for owner, cuisine in LABELS:
            if owner is not None and owner == r:
                wanted["cuisine", cuisine, kind].add(query)
    assert exact == {k: len(v - {None}) for k, v in wanted.items()}
    assert {(r["grain"], r["cuisine"], r["search_type"]) for r in unified.where("grain <> 'restaurant'").collect()} == set(
        exact
    )
