from __future__ import annotations

import random
import time
import zlib

import numpy as np
import pytest

from querylens.llm import toxicity
from querylens.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.character_model(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_trigrams_are_counted_in_all_texts(spark):
    docs = spark.createDataFrame([("ab b",), (None,), ("",), ("AB",), ("1a2",)], "text string")
    got = {r.code: r.n for r in toxicity.trigram_counts(docs).collect()}
    expected: dict[int, int] = {}
    for word in ["ab", "b", "ab", "a"]:
        codes = [0, 0, *(ord(c) - 96 for c in word), 0]
        for x, y, z in zip(codes, codes[1:], codes[2:], strict=False):
            code = (x * toxicity.SYMBOLS + y) * toxicity.SYMBOLS + z
            expected[code] = expected.get(code, 0) + 1
    # Between two words the boundary marks meet as well.
    assert {k: v for k, v in got.items() if k} == {k: v for k, v in expected.items() if k} | {
        k: v for k, v in got.items() if k and k not in expected and k // toxicity.SYMBOLS**2 and k % toxicity.SYMBOLS == 0
    }


@pytest.mark.parametrize(
    ("noisy", "word"),
    [
        ("1d10t", "idiot"), ("i d i o t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiiiooot", "idiot"), ("l0ser", "loser"),
        ("tr@sh", "trash"), ("$cum", "scum"), ("p4th3t1c", "pathetic"), ("w-o-r-t-h-l-e-s-s", "worthless"),
        ("m0r0n!!", "moron"), ("c l 0 w n", "clown"),
    ],
)
def test_channel_is_undone(model, noisy, word):
    assert toxicity.Restorer(model).text(f"and {noisy} the".encode()) == f"and {word} the".encode()


@pytest.mark.parametrize(
    "frame", ["and {} the", "he is {}.", "an {}, he", 'he said "{}" and', "a {} is", "I {} you", "{}", "one\n{}\ntwo"]
)
def test_disguises_at_sentence_ends_in_quotes_and_after_short_words(model, frame):
    restorer = toxicity.Restorer(model)
    forms = ["i d i o t", "i  d  i  o  t", "i/d/i/o/t", "i,d,i,o,t", "i, d, i, o, t", "i d i o 7", "idio7", "idio+", "idioot", "1d10t", "id-iot"]
    for noisy in forms:
        assert restorer.text(frame.format(noisy).encode()).lower() == frame.format("idiot").lower().encode(), noisy
    for noisy in ("stuupid", "5tup1d", "s t u p i d"):
        assert b"stupid" in restorer.text(frame.format(noisy).encode()).split(b".")[0].replace(b",", b"").replace(b'"', b"").split(), noisy
    assert b"stupid idiot" in restorer.text(frame.format("s t u p i d i d i o t").encode())


def test_words_with_doubled_letters_numbers_and_signs_stay(model):
    restorer = toxicity.Restorer(model.knowing([b"don", b"t", b"well", b"known", b"covid"]))
    assert restorer.text(b"worthless 1 2 3 4 don't well-known covid19") == b"worthless 1 2 3 4 don't well-known covid19"


def test_clean_text_stays(model):
    restorer = toxicity.Restorer(model)
    for text in ("The Tree, and 12 apples cost 3.50!", "été à la plage", "", "I am a man", "100 %", "a b"):
        assert restorer.text(text.encode()) == text.encode()


def test_decoding_is_the_best_path(model):
    """Viterbi against all readings of short tokens."""
    rng = random.Random(8)
    for _ in range(60):
        token = "".join(rng.choices("abeost013$@.!", k=rng.randint(1, 6))).encode()
        paths = [(0.0, b"", (0, 0))]
        before = None
        for code in token:
            paths = [
                (cost + extra + (float(model.cost[a, b, toxicity._SYMBOL[x[0]]]) if x else 0), word + x, (b, int(toxicity._SYMBOL[x[0]])) if x else (a, b))
                for cost, word, (a, b) in paths
                for x, extra in toxicity._readings(code, before)
            ]
            before = code
        best = min(cost + float(model.cost[a, b, 0]) for cost, _, (a, b) in paths)
        words = {word for cost, word, (a, b) in paths if cost + float(model.cost[a, b, 0]) <= best + 1e-4}
        assert model.restore(token) in words


def test_query_on_held_out_documents(spark):
    rows = QUERIES["op5_toxicity"](spark, SF_DIR).collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    good, bad = [s for s, t in held if not t], [s for s, t in held if t]
    assert np.mean([[b > g for g in good] for b in bad]) > 0.9


def test_disguised_words_are_scored_and_edges(spark, model):
    docs = spark.createDataFrame(
        [(i, f"word{i % 9} " * 5 + ("idiot scum" if i % 4 == 0 else "tree"), "x") for i in range(200)], "doc_id long, text string, score string"
    )
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    weights = toxicity.fit(docs, labels, model)
    texts = ["word1 1d10t $cum", "word1 i d i o t", "word1 tree", "", None, "idiot " * 100_000]
    more = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    scores = [r.score for r in sorted(toxicity.score(more, model, weights).collect(), key=lambda r: r.doc_id)]
    assert scores[0] > 0.5 and scores[1] > 0.4 and scores[5] > 0.4
    assert max(scores[2:5]) < 0.2 and scores[3] == scores[4]
    assert toxicity.score(more.limit(0), model, weights).collect() == []
    shown = toxicity.restored(more, model).where("doc_id in (0, 4)").orderBy("doc_id").collect()
    assert [r.restored for r in shown] == ["word1 idiot scum", None]


def test_rare_toxic_words_are_weighed(spark, monkeypatch):
    """Words that all texts have are more frequent in toxic ones than those that tell them."""
    monkeypatch.setattr(toxicity, "FEATURES", 1)
    common = " ".join(f"{a}{b}" for a in "abcdefghij" for b in "klmnopqr")
    texts = [(f"{common} zug" if i < 4 else common, int(i < 20)) for i in range(60)]
    rows = spark.createDataFrame([(t.encode(), y) for t, y in texts], "restored binary, toxic int")
    best = toxicity._best_features(rows, 20, 40, limit=1)
    assert best.tolist() == [int(toxicity.word_features([b"zug"])[0][0])]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic int")
    plain = toxicity.CharacterModel(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert toxicity.fit(docs, labels, plain).hashes.tolist() == best.tolist()


def test_labels_of_one_kind_and_none(spark, model):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    for labels, expected in ([(1, 1), (2, 1)], 0.83), ([(1, 0), (1, 0)], 0.25), ([], 0.5):
        table = spark.createDataFrame(labels, "doc_id long, toxic int")
        weights = toxicity.fit(docs, table, model)
        assert toxicity.score(docs, model, weights).first().score == pytest.approx(expected, abs=0.01)


def each_start_anew(restorer: toxicity.Restorer, token: bytes) -> list[bytes] | None:
    """The likeliest known words, by trying every word from every place a word may begin at."""
    best = [(0.0, None), *[None] * len(token)]

    def reach(at, total, words, word):
        if best[at] is None or total < best[at][0]:
            best[at] = (total, (words, word) if word else words)

    for start in range(len(token)):
        if best[start] is None:
            continue
        total, words = best[start]
        if token[start + 1 : start + 2] == b" " or start == len(token) - 1 and token[start - 1 : start] == b" ":
            reach(min(start + 2, len(token)), total + toxicity.UNKNOWN_COST, words, token[start : start + 1])
        paths = {b"": total}
        for at in range(start, len(token)):
            code, step = token[at], {}
            for text, cost in paths.items():
                if toxicity._TABLE[code] == 32 and (not text or text in restorer.words):
                    reach(at + 1, cost + toxicity._split_cost(code) + (restorer.word_cost(text) if text else 0.0), words, text)
                for letters, extra in toxicity._readings(code, token[at - 1] if at > start else None):
                    if not text + letters or text + letters in restorer.beginnings:
                        step[text + letters] = min(cost + extra, step.get(text + letters, np.inf))
            paths = step
        for text, cost in paths.items():
            if text in restorer.words:
                reach(len(token), cost + restorer.word_cost(text), words, text)
    return None if best[-1] is None else toxicity._unwound(best[-1][1])


def test_spelled_words_are_the_best_reading(model):
    known = [b"idiot", b"stupid", b"fool", b"he", b"is", b"a", b"i", b"so", b"toll", b"ill", b"see", b"seal", b"lot"]
    restorer = toxicity.Restorer(model.knowing(known))
    rng = random.Random(2)
    found = 0
    for _ in range(3_000):
        token = bytearray()
        for code in b" ".join(rng.choice(known) for _ in range(rng.randint(1, 3))):
            token += rng.choice([b"%c", b"%c", b"%c%c", b"%c.", b"%c1", b"!%c"]).replace(b"%c", bytes([code]))
            if rng.random() < 0.1:
                token[-1] = rng.choice(b"01345!@$.-*")
        spelled = restorer.spelled(bytes(token))
        found += spelled is not None
        assert spelled == each_start_anew(restorer, bytes(token))
    assert found > 300


@pytest.mark.parametrize("token", [b"a" + b"1" * 10**6, b"a" + b"!" * 10**6, b"a1" * 500_000, b"ab" * 500_000, b"1" * 10**6 + b"a"])
def test_long_tokens_take_work_in_proportion(model, token):
    start = time.perf_counter()
    toxicity.Restorer(model.knowing([b"idiot", b"stupid", b"ill", b"a"])).text(token)
    assert time.perf_counter() - start < 10


def test_known_words_are_measured_in_characters(spark):
    word = "неприкосновенность"  # 36 bytes
    texts = spark.createDataFrame([(f"{word} {i}",) for i in range(toxicity.LEAST_DOCS)] + [("x" * 33,)] * 50, "text string")
    found = toxicity.common_words(texts)
    assert word.encode() in found and b"x" * 33 not in found


def test_known_words_are_counted_in_all_texts(spark, monkeypatch):
    """A word in three of many texts is known, whichever texts it is in; copies and NULL count once."""
    monkeypatch.setattr(toxicity, "SAMPLE", 10)
    texts = [f"all only{i} {'zug' if i % 100 == 7 else ''}" for i in range(300)] + ["copied"] * 50 + [None] * 9
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert toxicity.character_model(docs).words == {b"all", b"only", b"zug"}
    for limit in (0, 1 << 20):
        found, n = toxicity.different_texts(docs, limit)
        assert n == 302 and sorted(found.collect(), key=str) == sorted([(t,) for t in set(texts)], key=lambda r: f"Row(text={r[0]!r})")
    # In 40,000 texts a word must be in six.
    more = spark.range(40_000).selectExpr("concat('all ', translate(cast(id as string), '0123456789', 'abcdefghij'), if(id < 6, ' six', ''), if(id < 5, ' five', '')) as text")
    assert toxicity.character_model(more).words == {b"all", b"six"}
