from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
from querylens.llm import langid
from querylens.llm.queries import QUERIES

SYLLABLES = {
    "en": ["the", "ing", "tion", "and", "er", "wh"],
    "de": ["sch", "ein", "ung", "keit", "ü", "pf"],
    "fr": ["eau", "eux", "que", "tré", "ê", "oi"],
    "es": ["ción", "ado", "rr", "que", "ñ", "los"],
    "xx": ["zq", "qz", "kk", "xj", "vv", "jx"],
}


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(5)
    rows = [(prose(rng, lang, rng.randint(5, 60)), lang) for lang in SYLLABLES for _ in range(60)]
    rows += [(None, "en"), ("no language", None), ("123", "fr")]
    return langid.fit(spark.createDataFrame(rows, "text string, lang string"))


def predicted(spark, model, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    return [(r.lang_pred, r.score) for r in sorted(langid.predict(docs, model).collect())]


def test_families_then_languages(spark, model):
    assert model.families.classes == ["germanic", "other", "romance"]
    assert {k: v.classes for k, v in model.languages.items()} == {"germanic": ["de", "en"], "romance": ["es", "fr"], "other": ["xx"]}
    assert len(model.families.pairs) == 3
    rng = random.Random(6)
    langs = [lang for lang in SYLLABLES for _ in range(20)]
    found = predicted(spark, model, [prose(rng, lang, 30) for lang in langs])
    assert sum(a == b for (a, _), b in zip(found, langs, strict=True)) >= 98
    assert all(0 <= score <= 1 for _, score in found)


def test_edges(spark, model):
    found = predicted(spark, model, [None, "", "12 !?", "中文", "the " * 100_000, "The ING", "the ing"])
    assert found[:3] == [("und", 0.0)] * 3
    assert found[3][0] != "und" and found[4][0] == "en" and found[5] == found[6]
    assert predicted(spark, model, []) == []


def test_equal_texts_get_equal_results_wherever_they_stand(spark, model):
    rng = random.Random(7)
    texts = [prose(rng, lang, 20) for lang in SYLLABLES] * 30
    assert len({(t, *r) for t, r in zip(texts, predicted(spark, model, texts), strict=True)}) == 5


def test_one_language_and_none(spark):
    one = langid.fit(spark.createDataFrame([("abc", "en")], "text string, lang string"))
    assert predicted(spark, one, ["xyz", None]) == [("en", 1.0), ("und", 0.0)]
    none = langid.fit(spark.createDataFrame([(None, "en")], "text string, lang string"))
    assert none is None and predicted(spark, none, ["xyz"]) == [("und", 0.0)]


def test_rejection_keeps_columns(spark, model):
    docs = spark.createDataFrame([(1, "the and er", 0.5), (2, "...", 0.5), (3, None, None)], "doc_id long, text string, score double")
    kept = langid.identified(docs, model)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]
    assert [r.doc_id for r in langid.identified(docs, None).collect()] == [1]


def machines(classes, centres):
    """Between each two classes, the plane halfway between their centres, with both at margins of 1 and -1."""
    pairs = [(a, b) for a in range(len(classes)) for b in range(a + 1, len(classes))]
    weights = [2 * (centres[a] - centres[b]) / np.sum((centres[a] - centres[b]) ** 2) for a, b in pairs]
    middles = [-w @ (centres[a] + centres[b]) / 2 for w, (a, b) in zip(weights, pairs, strict=True)]
    return langid.Pairwise(classes, pairs, np.array(weights).reshape(len(pairs), langid.DIMENSIONS), np.array(middles))


def test_all_listed_languages_are_kept(spark):
    rng = random.Random(11)
    own = {lang: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(8)] for lang in langid.FAMILIES}

    def speech(lang):
        return " ".join("".join(rng.choices(own[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(30, 60)))

    def centre(langs):
        texts = [speech(lang).encode() for lang in langs for _ in range(20)]
        ends = np.cumsum([0, *map(len, texts)])
        return langid.features(np.frombuffer(b"".join(texts), np.uint8), ends).mean(axis=0)

    members = {f: sorted(x for x in own if langid.FAMILIES[x] == f) for f in sorted(set(langid.FAMILIES.values()))}
    steps = {f: machines(langs, [centre([x]) for x in langs]) for f, langs in members.items()}
    model = langid.Model(machines(list(members), [centre(x) for x in members.values()]), steps)
    docs = spark.createDataFrame([(speech(lang), lang) for lang in own for _ in range(5)] + [("12", "en")], "text string, lang string")
    found = langid.predict(docs, model).where("lang_pred = lang").collect()
    assert len(found) == 90 and max(r.score for r in found) < 0.3
    assert langid.identified(docs, model).count() == 90
    undecided = np.zeros(langid.DIMENSIONS)
    steps = {f: langid.Pairwise(p.classes, p.pairs, p.weights * 0, p.intercepts * 0) for f, p in steps.items()}
    model = langid.Model(langid.Pairwise(model.families.classes, model.families.pairs, np.stack([undecided] * 3), np.zeros(3)), steps)
    assert langid.identified(docs, model).count() == 0


def test_query_on_held_out_documents(spark):
    rows = QUERIES["op1_language_id"](spark, contract.SMOKE_DIR).collect()
    docs = spark.read.parquet(f"{contract.SMOKE_DIR}/documents.parquet").collect()
    lang = {r.doc_id: r.lang for r in docs}
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_copies_neither_flood_nor_starve_the_sample(spark):
    rows = [("the same page", "en")] * 5_000 + [(f"page {i} of fifty", "en") for i in range(50)] + [("une page", "fr")] * 3
    labelled = spark.createDataFrame(rows, "text string, lang string").select("text", "lang")
    drawn = langid._drawn(labelled, 1_000).collect()
    assert len(drawn) == len(set(drawn)) == 52
    few = langid._drawn(labelled, 10).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in few}["en"] < 30
