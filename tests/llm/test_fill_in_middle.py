"""Cuts and forms against a plain version; ranks against counting; the text rebuilt from its output."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from querylens.llm.fill_in_middle import Boundaries, WaveletMatrix, fill_in_middle, restored

SCHEMA = "doc_id long, text string"
TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain_version(doc_id, text) -> tuple:
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    tokens = TOKEN.findall(text)
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def key(row: tuple) -> tuple:
    return tuple((v is not None, v) for v in row)


def random_texts(count: int) -> list[str]:
    draw = random.Random(11)
    letters = "abZ .,\n\t0é漢😀<>PSM{}@`[́\x00ñ"
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(40))) for _ in range(count)]


def test_equals_the_plain_version(spark):
    rows = list(enumerate(random_texts(400)))
    rows += [(i, t) for i, t in enumerate(["", None, "<P>", "a<S>b", "x<M", "<", "a", " ", "漢字", "word " * 50_000, "x" * 300_000])]
    rows += [(7, "the same"), (7, "the same"), (None, "no id"), (None, None), (-3, "below zero")]
    found = fill_in_middle(spark.createDataFrame(rows, SCHEMA))
    both = found.select("*", restored(F.col("output"), F.col("form")).alias("again")).collect()
    assert sorted((tuple(r)[:6] for r in both), key=key) == sorted((plain_version(*r) for r in rows), key=key)
    assert sorted(r["again"] for r in both) == sorted(t or "" for _, t in rows)


def test_clashing_names_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, "x", "y")], f"{SCHEMA}, n int, output string, h1 string")
    assert tuple(fill_in_middle(docs).first()) == plain_version(1, "a b c")
    empty = fill_in_middle(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert empty.count() == 0


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 1000])
def test_ranks_are_counts(size):
    values = np.random.default_rng(size).integers(0, 8, size).astype(np.uint8)
    matrix = WaveletMatrix(values, 3)
    ends = np.arange(size + 1)
    for value in range(8):
        assert matrix.rank(value, ends).tolist() == [int((values[:e] == value).sum()) for e in ends]


def test_cuts_are_token_starts():
    texts = [t.encode() for t in random_texts(60)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = Boundaries(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for i, text in enumerate(texts):
        starts = [m.start() for m in TOKEN.finditer(text.decode())] + [len(text.decode())]
        assert found.count()[i] == len(starts) - 1
        for k, start in enumerate(starts):
            tokens = np.minimum(k, found.count())
            assert found.cut(tokens)[i] - found.texts[i] == start
