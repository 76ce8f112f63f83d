from __future__ import annotations

import pytest

from querylens.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, key string"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in rows], SCHEMA)


def expected_targets(sizes: dict) -> dict:
    """Share by weight, cut at the limit, share the rest again, until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, limited = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in limited]
        rest = total - sum(limited.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**limited, **share}
        limited.update({s: 3 * sizes[s] for s in over})


def test_targets_and_budgets(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), s) for s, n in (("a", 300), ("b", 5), ("é", 60), (None, 40)) for i in range(n)]
    plan = mixing.mix_plan(rows_of(spark, [(1000 * k + i, t, s) for k, (i, t, s) in enumerate(rows)])).collect()
    sizes = {}
    for r in plan:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    targets = expected_targets(sizes)
    for source, size in sizes.items():
        own = [r for r in plan if r.source == source]
        assert {r.source_size for r in own} == {size}
        assert own[0].target == pytest.approx(targets[source])
        assert abs(sum(r["size"] * r.copies for r in own) - targets[source]) <= 25
        assert max(r.copies for r in own) <= 3
        # What is left after whole epochs goes to the smallest keys.
        by_key = [r.copies for r in sorted(own, key=lambda r: r.key)]
        assert by_key == sorted(by_key, reverse=True)


def test_reruns_and_partitioning_agree(spark):
    docs = rows_of(spark, [(i, "w " * (i % 9), f"s{i % 4}") for i in range(200)])
    first = sorted(mixing.mix_plan(docs).collect(), key=str)
    assert first == sorted(mixing.mix_plan(docs.repartition(7)).collect(), key=str)


def test_mix_repeats_documents_and_keeps_columns(spark):
    docs = rows_of(spark, [(i, f"w{i} " * (i % 9 + 1), f"s{i % 4}") for i in range(200)])
    copies = {r.doc_id: r.copies for r in mixing.mix_plan(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    found = {}
    for r in mixed.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + 1
    assert found == {i: n for i, n in copies.items() if n}


def test_nulls_ties_and_empty_tables(spark):
    docs = rows_of(spark, [(None, None, None), (None, "", None), (1, "a b", None), (1, "a b", None), (2, " \t\n", "s")])
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == 5
    same = [r.copies for r in plan if r.doc_id == 1]
    assert len(set(same)) == 1
    assert {r["size"] for r in plan if r.doc_id != 1} == {0}
    assert mixing.mix_plan(docs.limit(0)).collect() == []
    assert mixing.mix(docs.limit(0)).collect() == []
    assert all(r.target == 0 for r in mixing.mix_plan(rows_of(spark, [(1, None, "a"), (2, "", "b")])).collect())


def test_one_source_holds_almost_all(spark):
    docs = rows_of(spark, [(i, "a b c", "hot" if i % 100 else "cold") for i in range(3000)])
    plan = mixing.mix_plan(docs).collect()
    for source, target in {r.source: r.target for r in plan}.items():
        assert abs(sum(r["size"] * r.copies for r in plan if r.source == source) - target) <= 2
