from __future__ import annotations

import math

from querylens.operators.residual import COLUMNS, ctr_residual

ROWS = [
    # restaurant, type, position, clicks, impressions
    ("1", "Unbranded", 2.4, 10, 100),
    ("2", "Unbranded", 1.6, 2, 100),
    ("3", "Unbranded", 2.5, 5, 50),
    ("4", "Unbranded", 2.0, 0, 200),
    ("5", "Branded", 2.0, 90, 100),
    ("6", "Unbranded", None, 3, 0),
    ("7", "Unbranded", 8.0, 1, 10),
    ("8", "Unbranded", 5.0, 0, 10),
    ("9", "Unbranded", 5.0, 0, 20),
]


def test_against_definition(spark):
    data = [("restaurant", *r, 100.0 * r[3] / r[4] if r[4] else None) for r in ROWS]
    data.append(("cuisine", None, "Unbranded", 2.0, 50, 100, 50.0))
    unified = spark.createDataFrame(
        data,
        "grain string, restaurant_id string, search_type string, avg_position double,"
        " total_clicks bigint, total_impressions bigint, ctr double",
    )
    result = ctr_residual(unified)
    assert result.columns == list(COLUMNS)
    found = {r["restaurant_id"]: r for r in result.collect()}
    bins = {}
    for r, kind, position, clicks, n in ROWS:
        if kind == "Unbranded" and n:
            bins.setdefault(math.floor(position + 0.5), []).append((r, clicks, n))
    assert set(found) == {r for members in bins.values() if len(members) > 1 for r, _, _ in members}
    for number, members in bins.items():
        for r, clicks, n in members:
            others = [m for m in members if m[0] != r]
            if not others:
                continue
            p = sum(m[1] for m in others) / sum(m[2] for m in others)
            row = found[r]
            ctr = 100 * clicks / n
            assert row["pos_bin"] == number
            assert math.isclose(row["expected_ctr"], 100 * p)
            assert math.isclose(row["position_ctr_residual"], ctr - 100 * p, abs_tol=1e-9)
            assert math.isclose(row["nboi_click_gap_pct"], max(0, 100 * p - ctr), abs_tol=1e-9)
            assert math.isclose(row["nboi_click_opportunity"], max(0, 100 * p - ctr) / 100 * n, abs_tol=1e-9)
            if 0 < p < 1:
                assert math.isclose(row["residual_z_score"], (clicks - n * p) / math.sqrt(n * p * (1 - p)))
            else:
                assert row["residual_z_score"] is None
