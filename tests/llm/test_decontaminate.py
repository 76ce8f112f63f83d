from __future__ import annotations

import re

from hypothesis import given, settings, strategies as st

from querylens.llm import decontaminate
from querylens.llm.common import WORD

ITEM = "one two three four five six seven eight nine ten eleven twelve"


def words_of(text: str | None) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(WORD, low)


def brute_force(text, items, window=10):
    words, hit, found = words_of(text), set(), set()
    for item_id, item in items:
        own = words_of(item)
        n = min(window, len(own))
        for j in range(len(own) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == own[j : j + n]:
                    hit.update(range(i, i + n))
                    found.add(item_id)
    return len(words), len(hit), sorted(x for x in found if x is not None)


def found(spark, texts, items, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    return sorted(decontaminate.find_passages(docs, bench, **options).collect())


def test_windows_short_items_and_offsets(spark):
    texts = [
        f"Before. {ITEM.upper()}! After",
        "one two three four five six seven eight nine TEN only",
        "nine words of the item are not enough: " + " ".join(ITEM.split()[:9]),
        "a SHORT, item; here",
        "É short item",
        "",
        None,
        "...",
    ]
    items = [("a", ITEM), ("b", "short item"), (None, "after"), ("e", ""), ("n", None)]
    for r, text in zip(found(spark, texts, items), texts, strict=True):
        assert (r.n_words, r.n_hit, r["items"]) == brute_force(text, items)
        for span in r.spans:
            assert words_of(text[span.start : span.end])
        assert sum(len(words_of(text[s.start : s.end])) for s in r.spans) == r.n_hit


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.text("ab ,É", max_size=40), max_size=4),
    st.text("ab ,É\n", max_size=120),
    st.integers(1, 4),
)
def test_automaton_equals_brute_force(items, text, window):
    named = [(str(i), x) for i, x in enumerate(items)]
    words = decontaminate.split_words(text.encode())
    ranges, ids = decontaminate.Matcher([(i, x.encode()) for i, x in named], window).find(words)
    n, hit, ids_expected = brute_force(text, named, window)
    assert (len(words), sum(b - a for a, b in ranges), sorted(ids)) == (n, hit, ids_expected)
    spans = decontaminate.original_spans(text.encode(), ranges)
    assert sum(len(words_of(text[s["start"] : s["end"]])) for s in spans) == hit


def test_blocks_of_items_change_nothing(spark):
    texts = [f"x {ITEM} short item", "short item", f"{ITEM} " * 40, None]
    items = [("a", ITEM), ("b", "short item"), ("c", "two three four"), ("d", "x one")]
    assert found(spark, texts, items) == found(spark, texts, items, block_bytes=40)


def test_long_text_and_empty_tables(spark):
    long = "word " * 200_000 + ITEM
    (row,) = found(spark, [long], [("a", ITEM)])
    assert (row.n_words, row.n_hit, row.spans[0].end) == (200_012, 12, len(long))
    assert found(spark, ["text"], [])[0].n_hit == 0
    assert found(spark, [], [("a", ITEM)]) == []


def test_clean_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(1, f"a {ITEM}", 5), (2, "clean", 6), (3, None, 7)], "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame([("a", ITEM)], "item_id string, text string")
    clean = decontaminate.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3]
