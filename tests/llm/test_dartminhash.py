from __future__ import annotations

import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from querylens.llm import dartminhash as dm
from querylens.llm.common import WORD, text_chunks


def weighted(text: str | None) -> Counter:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(WORD, low)
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def groups(texts: list[str | None], least=0.8) -> list[int]:
    sets, group = [weighted(t) for t in texts], list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and similarity(sets[i], sets[j]) >= least:
            a, b = sorted((group[i], group[j]))
            group = [a if g == b else g for g in group]
    return group


def found(spark, texts, ids=None):
    rows = [(i, t, "x") for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string").repartition(3)
    return dm.near_duplicates(docs)


def prose(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(n)]


def edited(rng: random.Random, words: list[str], edits: int) -> list[str]:
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"edit{rng.random()}"
    return out


def test_signatures_agree_as_often_as_the_sets_are_similar():
    rng = random.Random(1)
    base = prose(rng, 300) + ["again"] * 200
    texts = [" ".join(base), " ".join(edited(rng, base, 10)), " ".join(base[:300]), " ".join(prose(rng, 300)), "a b"]
    column = pa.array(texts)
    (chunk,) = text_chunks(column)
    signature = dm.dart_signatures(*dm.regions(*dm.shingles(*chunk)), len(texts), 2000)
    assert (signature != 0).all()
    for i, j in itertools.combinations(range(len(texts)), 2):
        expected = similarity(weighted(texts[i]), weighted(texts[j]))
        assert (signature[i] == signature[j]).mean() == pytest.approx(expected, abs=0.05)


def test_groups_equal_brute_force(spark):
    rng = random.Random(2)
    passage = prose(rng, 40)
    texts: list[str | None] = []
    for _ in range(12):
        base = prose(rng, rng.randint(20, 120))
        texts += [" ".join(edited(rng, base, rng.randint(0, 6))) for _ in range(rng.randint(1, 8))]
    # Texts that share a passage, similar by a half to nine tenths: chains, strangers, and borderline pairs.
    texts += [" ".join(passage + prose(rng, rng.randint(1, 30))) for _ in range(60)]
    base = prose(rng, 100)
    texts += [" ".join(edited(rng, base, 3)) for _ in range(80)]
    texts += ["one two", "One, TWO!", "one two three", "", None, "...", "", "a a a a a a a a", "a a a a a a a", "b " * 50_000]
    rng.shuffle(texts)
    got = {r.doc_id: r.class_id for r in found(spark, texts).collect()}
    assert got == dict(enumerate(groups(texts)))


def test_hot_group_of_copies_and_chains(spark):
    rng = random.Random(3)
    words = prose(rng, 60)
    chain = [" ".join([f"x{i}" for i in range(k)] + words[k:]) for k in range(0, 40, 2)]
    texts = ["same text of many rows here"] * 500 + chain + [" ".join(prose(rng, 30)) for _ in range(50)]
    got = {r.doc_id: r.class_id for r in found(spark, texts).collect()}
    assert got == dict(enumerate(groups(texts)))


def test_nulls_repeated_ids_and_empty_tables(spark):
    texts = ["a b c d e f", "a b c d e f", None, "other words in this text", "a b c d e f", None]
    rows = sorted(found(spark, texts, [None, 7, 8, None, 7, None]).collect(), key=str)
    assert rows == sorted([(None, 7), (7, 7), (8, 8), (None, None), (7, 7), (None, None)], key=str)
    assert found(spark, []).collect() == []
    assert sorted(found(spark, ["", "one text"]).collect()) == [(0, 0), (1, 1)]


def test_chunks_do_not_matter():
    rng = random.Random(4)
    texts = [" ".join(prose(rng, rng.randint(0, 80))) for _ in range(1200)] + [None, "", "x"]
    column = pa.array(texts, pa.string())
    ids = [i for c in text_chunks(column) for i in dm._set_ids(*dm.regions(*dm.shingles(*c)), len(c[1]) - 1)]
    one = [dm._set_ids(*dm.regions(*dm.shingles(*c)), 1)[0] for t in texts for c in text_chunks(pa.array([t], pa.string()))]
    assert ids == one
    assert ids[-3:-1] == [None, None]
    sliced = [c for c in text_chunks(column.slice(100, 50))]
    assert dm._set_ids(*dm.regions(*dm.shingles(*sliced[0])), 50) == ids[100:150]


def test_connected_follows_long_paths(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200)]
    rows = [(b"%03d" % a, b"%03d" % b) for a, b in pairs]
    edges = spark.createDataFrame(rows, "a binary, b binary")
    got = {int(bytes(r.node)): int(bytes(r.root)) for r in dm.connected(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}


def test_no_python_beyond_signatures_and_sets(spark):
    texts = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    signed = dm.signatures(texts, "text")
    assert [f.name for f in signed.schema.fields] == ["doc_id", "node", "n", "bands"]
    assert signed.select(F.size("bands")).first()[0] == dm.BANDS
    assert np.array(signed.first().bands).dtype == np.int64


def test_marks_rule_out_only_what_is_not_similar(spark):
    rng = random.Random(9)
    base = prose(rng, 120)
    texts = [" ".join(w if rng.random() > share else f"x{rng.randint(0, 10**6)}" for w in base) for share in (0, 0.01, 0.02, 0.1, 0.5) for _ in range(4)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "", "one two"])], "doc_id long, text string")
    sets = dm.weighted_sets(docs, "text").withColumn("n", F.size("regions"))
    other = sets.select(*[F.col(c).alias(f"o_{c}") for c in sets.columns]).withColumnRenamed("o_doc_id", "other")
    both = sets.join(other, sets.doc_id < other.other).where("n > 0 and o_n > 0")
    fit = dm._marks_fit("n", "o_n", "marks", "o_marks", 0.8)
    rows = both.select(fit.alias("fit"), dm._similar(F.col("regions"), F.col("o_regions"), 0.8).alias("similar")).collect()
    assert any(r.similar for r in rows) and all(r.fit for r in rows if r.similar)
    assert any(not r.fit for r in rows)
