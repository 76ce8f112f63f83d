from __future__ import annotations

from querylens.llm import preference

SCHEMA = "conv_id long, turn long, role string, text string, prompt string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def render(role, text):
    return f"<|{role or ''}|>\n{text or ''}<|end|>\n"


def test_prefix_is_rendered_once_and_masks_cover_replies(spark):
    shared = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello")]
    good = [*shared, (1, 3, "user", "more"), (1, 4, "assistant", "gladly é"), (1, 5, "user", "thanks")]
    bad = [*shared, (1, 3, "user", "other"), (1, 4, "assistant", "no")]
    (row,) = preference.preference_pairs(turns(spark, good), turns(spark, bad)).collect()
    assert row.n_common == 3
    assert row.prompt == "".join(render(*t[2:]) for t in shared)
    assert row.chosen == "".join(render(*t[2:]) for t in good[3:])
    assert row.rejected == "".join(render(*t[2:]) for t in bad[3:])
    assert [row.chosen[s.start : s.end] for s in row.chosen_mask] == ["gladly é<|end|>"]
    assert [row.rejected[s.start : s.end] for s in row.rejected_mask] == ["no<|end|>"]


def test_edges(spark):
    a = [(1, 0, "user", "x"), (2, 0, "user", "x"), (3, 0, "user", None), (None, 0, "user", "x"), (4, 0, "user", "only here")]
    a += [(5, None, None, "first"), (5, 1, "assistant", "b"), (5, 1, "assistant", "a")]
    b = [(1, 0, "user", "x"), (2, 0, "user", "y"), (3, 0, "user", ""), (None, 0, "user", "x"), (5, 0, None, "first")]
    rows = {r.pair_id: r for r in preference.preference_pairs(turns(spark, a), turns(spark, b)).collect()}
    assert sorted(rows) == [1, 2, 3, 5]
    assert (rows[1].n_common, rows[1].chosen, rows[1].rejected, rows[1].chosen_mask) == (1, "", "", [])
    assert (rows[2].n_common, rows[2].prompt) == (0, "")
    assert rows[3].n_common == 1
    assert rows[5].chosen == render("assistant", "a") + render("assistant", "b")
    assert len(rows[5].chosen_mask) == 2
    assert preference.preference_pairs(turns(spark, []), turns(spark, b)).collect() == []


def test_order_of_rows_does_not_matter(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"{c} {t} " * 300) for c in range(5) for t in range(60)]
    a, b = turns(spark, rows), turns(spark, rows[::-1]).repartition(4)
    got = preference.preference_pairs(a, preference.with_shortened_reply(b)).collect()
    assert {r.n_common for r in got} == {59}
    for r in got:
        (span,) = r.rejected_mask
        reply = f"{r.pair_id} 59 " * 300
        assert r.rejected[span.start : span.end] == reply[: len(reply) // 2] + "<|end|>"
