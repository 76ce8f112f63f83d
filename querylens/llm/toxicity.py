"""Toxicity of texts whose words may be disguised.

Writing is seen as a noisy channel: a word may have reached the page with
digits and signs for letters, with blanks or signs between its letters, or with
letters repeated. A suspicious token, or a run of single characters, becomes a
lattice of the letters each character may stand for and of the places where a
word may end. The likeliest path through known words, the channel's costs
included, gives the restored words; where known words give none, the path that a
character model finds likeliest does (Viterbi). The model counts the words of
all documents, and known words are those of enough of all different documents. The score comes from a logistic model on words and
beginnings of words of the restored text.
"""

from __future__ import annotations

import copy
import functools
import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from querylens.llm.common import add_columns, give_back, keep_nothing, limit_batches, text_bytes, text_chunks
from querylens.operators.joins import BROADCAST_BYTES, measured_bytes
from querylens.sources.scratch import materialize

# Labelled documents of each kind that the logistic model is fitted on, at most; drawn by a hash of their id.
SAMPLE = 10_000
# Words and beginnings that the logistic model weighs, at most, and the toxic documents each must occur in.
FEATURES = 4000
LEAST_DOCS = 3
# Share of the different texts that a known word must occur in; three in twenty thousand.
LEAST_SHARE = 1.5e-4
# Words that a task counts before it sends their sums.
COUNTED = 200_000
BEGINNINGS = (5, 6, 7, 8, 9)  # bytes
PENALTY = 1.0
SYMBOLS = 64

# What a sign may stand for, and the cost of each kind of noise as a negative logarithm.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
LEET_COST = 1.5
REPEAT_COST = 1.0
# Dropping a sign: one that is rarely mere decoration, an exclamation mark, any other, the same once more.
LEET_DROP_COST = 10.0
MARK_DROP_COST = 2.5
DROP_COST = 1.0
AGAIN_COST = 0.5
# Another word, at a sign or a blank; a number after a word; a single character that is no word.
WORD_COST = 2.0
NUMBER_COST = 5.0
UNKNOWN_COST = 12.0
# Known words of one letter; others are rather pieces of a word.
ONE_LETTER_WORDS = (b"a", b"e", b"i", b"o", b"y")
WORD_CHARS = 32
# A word that is shorter than so many bytes once no letter is repeated must be likelier by so much than as written.
SHORT_BYTES = 4
SHORT_GAIN = 10.0
# Tokens whose restored form a worker remembers, and the longest of them.
REMEMBERED = 100_000
REMEMBERED_BYTES = 64

_U = np.uint64


def _letters() -> np.ndarray:
    """Letters in lower case and bytes beyond ASCII as they are, blanks for the rest."""
    table = np.full(256, ord(" "), np.uint8)
    table[128:] = np.arange(128, 256)
    for code in range(ord("a"), ord("z") + 1):
        table[code] = table[code - 32] = code
    return table


_TABLE = _letters()
_SYMBOL = np.where(_TABLE < 128, np.where(_TABLE == 32, 0, _TABLE - 96), 27 + (_TABLE.astype(int) - 128) % 37).astype(np.int64)


def trigram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(code, n): how often three symbols follow each other in the words of all texts.

    A table of at most ``SYMBOLS`` cubed rows; each task sends its sums.
    """

    limit_batches(docs.sparkSession)

    def run(batches):
        keep_nothing()
        sums = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for data, offsets in text_chunks(batch.column(0)):
                symbols = np.insert(_SYMBOL[data], offsets[:-1], 0)
                symbols = np.concatenate([[0], symbols, [0, 0]])
                symbols = symbols[np.concatenate([[True], (symbols[1:] != 0) | (symbols[:-1] != 0)])]
                # A word has two boundaries before it and one after it.
                symbols = np.repeat(symbols, np.where(symbols == 0, 2, 1))
                codes = (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]
                sums += np.bincount(codes, minlength=len(sums))
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(sums[seen])], names=["code", "n"])
        give_back()

    counts = docs.select(F.col(text).alias("text")).mapInArrow(run, "code long, n long")
    return counts.groupBy("code").agg(F.sum("n").alias("n"))


def common_words(texts: DataFrame, least: int = LEAST_DOCS) -> list[bytes]:
    """The words in at least ``least`` of the texts, the only column; longer ones than ``WORD_CHARS`` are none.

    Each task adds up its texts and sends the sums, earlier if it has ``COUNTED`` words.
    """

    limit_batches(texts.sparkSession)

    def sums(seen: Counter[bytes]) -> pa.RecordBatch:
        kept = [x for x in seen if len(x) <= WORD_CHARS or len(x.decode(errors="ignore")) <= WORD_CHARS]
        return pa.RecordBatch.from_arrays([pa.array(kept, pa.binary()), pa.array([seen[x] for x in kept], pa.int64())], names=["word", "n"])

    def run(batches):
        keep_nothing()
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                # No character has more than four bytes.
                seen.update([x for x in set(text.translate(_PLAIN).split()) if len(x) <= 4 * WORD_CHARS])
                if len(seen) >= COUNTED:
                    yield sums(seen)
                    seen.clear()
        yield sums(seen)
        give_back()

    counts = texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(r["word"]) for r in counts.where(F.col("n") >= least).select("word").collect()]


class CharacterModel:
    """Costs of a symbol after the two before it, from trigram counts smoothed by bigrams and single symbols; known words."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, words: Iterable[bytes] = ()):
        self.words = frozenset(x for x in words if len(x) > 1 or x in ONE_LETTER_WORDS)
        three = np.zeros(SYMBOLS**3)
        three[codes] = counts
        three = three.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        single = (one + 1) / (one.sum() + SYMBOLS)
        double = (two + 10 * single) / (two.sum(axis=1, keepdims=True) + 10)
        triple = (three + 10 * double[None]) / (three.sum(axis=2, keepdims=True) + 10)
        self.cost = (-np.log(triple)).astype(np.float32)

    def knowing(self, words: Iterable[bytes]) -> CharacterModel:
        """The same model with more known words."""
        out = copy.copy(self)
        out.words = self.words | frozenset(x for x in words if len(x) > 1 or x in ONE_LETTER_WORDS)
        return out

    def word_cost(self, word: bytes) -> float:
        symbols = [0, 0, *(int(_SYMBOL[x]) for x in word), 0]
        return float(sum(self.cost[x] for x in zip(symbols, symbols[1:], symbols[2:], strict=False)))

    def restore(self, token: bytes) -> bytes:
        """The likeliest word behind a token."""
        cost, paths = self.cost, {(0, 0): (0.0, None)}
        before = None
        for code in token:
            step: dict[tuple[int, int], tuple[float, bytes]] = {}
            for letters, extra in _readings(code, before):
                for (a, b), (total, word) in paths.items():
                    state, sum_ = (a, b), total + extra
                    if letters:
                        symbol = int(_SYMBOL[letters[0]])
                        state, sum_ = (b, symbol), sum_ + float(cost[a, b, symbol])
                    if state not in step or sum_ < step[state][0]:
                        step[state] = (sum_, (word, letters) if letters else word)
            paths, before = step, code
        ends = [(total + float(cost[a, b, 0]), word) for (a, b), (total, word) in paths.items()]
        return b"".join(_unwound(min(ends, key=lambda x: x[0])[1]))


def _unwound(chain: tuple | None) -> list[bytes]:
    """The pieces of a chain that begins with its last one."""
    out = []
    while chain:
        chain, piece = chain
        out.append(piece)
    return out[::-1]


# What stands for the separators of a run of single characters.
_BLANK = ord(" ")


@functools.cache
def _readings(code: int, before: int | None) -> list[tuple[bytes, float]]:
    """What a character may stand for after the one before it: letters, or nothing, and the costs."""
    sign = chr(code)
    if _TABLE[code] != 32:
        kept = (bytes([int(_TABLE[code])]), 0.0)
        return [kept, (b"", REPEAT_COST)] if code == before and code < 128 else [kept]
    if code == _BLANK:
        return [(b"", 0.0)]
    found = [(letter.encode(), LEET_COST) for letter in LEET.get(sign, "")]
    drop = MARK_DROP_COST if sign == "!" else LEET_DROP_COST if sign in LEET else DROP_COST
    return [*found, (b"", AGAIN_COST if code == before else drop)]


@functools.cache
def _split_cost(code: int) -> float:
    """The cost of a word's end at a sign."""
    return MARK_DROP_COST if code == ord("!") else NUMBER_COST if chr(code) in LEET else WORD_COST


# A token with signs before or between letters, or with a letter three times.
_LETTER = rb"[A-Za-z\x80-\xff]"
_NOISY = re.compile(rb"[0-9@$!|+*._\-]" + _LETTER + rb"|([A-Za-z])\1\1", re.IGNORECASE)
# A sign beside a letter, or a letter twice: noise if that gives known words.
_DOUBTFUL = re.compile(rb"[A-Za-z\x80-\xff][^A-Za-z\x80-\xff]|[^A-Za-z\x80-\xff][A-Za-z\x80-\xff]|([A-Za-z])\1", re.IGNORECASE)
# Single characters in a row, whatever separates them.
_SINGLE = rb"[A-Za-z0-9@$!|+]"
_BETWEEN = rb"[^A-Za-z0-9@$!|+\x80-\xff]++"
_SPACED = re.compile(
    rb"(?<![A-Za-z0-9@$\x80-\xff])" + _SINGLE + rb"(?:" + _BETWEEN + _SINGLE + rb"(?![A-Za-z0-9@$|+\x80-\xff])){2,}+"
)
_SEPARATOR = re.compile(_BETWEEN)
_HAS_LETTER = re.compile(rb"[A-Za-z]")
_WHITE = re.compile(rb"(\s+)")
# Marks around a word that stand for no letter.
_EDGES = bytes(x for x in range(128) if _TABLE[x] == 32 and chr(x) not in LEET)
_PLAIN = _TABLE.tobytes()


class Restorer:
    """Restores the suspicious tokens of a text; each distinct token is decoded once while it is remembered."""

    def __init__(self, model: CharacterModel):
        self.model = model
        self.words = model.words
        self.beginnings = {word[:n] for word in model.words for n in range(len(word) + 1)}
        self.decode = functools.lru_cache(REMEMBERED)(model.restore)
        self.word_cost = functools.lru_cache(REMEMBERED)(model.word_cost)
        self.known: dict[bytes, bytes] = {}

    def spelled(self, token: bytes) -> list[bytes] | None:
        """The likeliest known words behind a token, which end at signs and blanks; None if it can't be read so.

        Between blanks a single letter may also stand for itself.
        """
        best: list[tuple[float, tuple | None] | None] = [(0.0, None), *[None] * len(token)]

        def reach(at: int, total: float, words: tuple | None, word: bytes) -> None:
            if best[at] is None or total < best[at][0]:
                best[at] = (total, (words, word) if word else words)

        paths: dict[bytes, tuple[float, tuple | None]] = {}  # beginnings of words that may be under way
        for at, code in enumerate(token):
            begun = best[at]
            if not paths and begun is None:
                continue
            if begun is not None and (token[at + 1 : at + 2] == b" " or at == len(token) - 1 and token[at - 1 : at] == b" "):
                reach(min(at + 2, len(token)), begun[0] + UNKNOWN_COST, begun[1], token[at : at + 1])
            states = [(text, *state, token[at - 1]) for text, state in paths.items()]
            if begun is not None:
                states.append((b"", *begun, None))
            splits, paths = _TABLE[code] == 32, {}
            for text, total, words, before in states:
                if splits and (not text or text in self.words):
                    reach(at + 1, total + _split_cost(code) + (self.word_cost(text) if text else 0.0), words, text)
                for letters, extra in _readings(code, before):
                    made = text + letters
                    if (not made or made in self.beginnings) and (made not in paths or total + extra < paths[made][0]):
                        paths[made] = (total + extra, words)
        for text, (total, words) in paths.items():
            if text in self.words:
                reach(len(token), total + self.word_cost(text), words, text)
        return None if best[-1] is None else _unwound(best[-1][1])

    def _run(self, match: re.Match) -> bytes:
        """The words behind single characters in a row."""
        raw = match[0]
        if not _HAS_LETTER.search(raw):
            return raw
        token = _SEPARATOR.sub(b" ", raw).lower()
        words = self.spelled(token) or []
        unknown = sum(len(x) == 1 and x not in self.words for x in words)
        if words and 6 * unknown <= len(token):
            return b" ".join(words)
        return self._restored(token.replace(b" ", b""))

    def _rather_spelling(self, plain: list[bytes], words: list[bytes]) -> bool:
        """Whether a doubled letter belongs to a word that is only unknown."""
        short = len(plain) == len(words) == 1 and len(words[0]) < SHORT_BYTES and set(plain[0]) == set(words[0])
        return short and self.word_cost(plain[0]) - self.word_cost(words[0]) < SHORT_GAIN

    def _restored(self, token: bytes) -> bytes:
        return self.decode(token) if len(token) <= REMEMBERED_BYTES else self.model.restore(token)

    def _token(self, token: bytes) -> bytes:
        core, out = token.strip(_EDGES), token
        if len(parts := _WHITE.split(token)) > 1:
            out = b"".join([x if x.isspace() else self._token(x) for x in parts])
        elif _DOUBTFUL.search(core):
            plain = core.translate(_PLAIN).split()
            if not self.words.issuperset(plain):
                words = self.spelled(core.lower())
                if words and words != plain and not self._rather_spelling(plain, words):
                    at = token.index(core)
                    out = token[:at] + b" ".join(words) + token[at + len(core) :]
                elif not words and _NOISY.search(token):
                    out = self._restored(token.lower())
            elif _NOISY.search(core) and len(plain) > 1 and all(len(x) == 1 for x in plain):
                out = self._restored(token.lower())
        elif _NOISY.search(token):
            out = self._restored(token.lower())
        if len(token) <= REMEMBERED_BYTES:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[token] = out
        return out

    def text(self, text: bytes) -> bytes:
        parts = _SPACED.sub(self._run, text).split(b" ")
        found = list(map(self.known.get, parts))
        return b" ".join([self._token(part) if x is None else x for part, x in zip(parts, found, strict=True)])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and their beginnings, and the number of the text of each."""
    data = _TABLE[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    inside = data != 32
    at = np.flatnonzero(inside)
    if not len(at):
        return np.empty(0, _U), np.empty(0, np.int64)
    first = np.concatenate([[True], np.diff(at) > 1])
    number = np.cumsum(first) - 1
    starts = at[first]
    place = at - starts[number]
    powers = np.full(int(place.max()) + 1, 0x100000001B3, _U)
    powers[0] = 1
    terms = (data[at].astype(_U) + _U(1)) * np.multiply.accumulate(powers)[place]
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(terms)])
    begin = np.flatnonzero(first)
    length = np.diff(np.concatenate([begin, [len(at)]]))
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, starts, "right")
    hashes, docs = [_mix(sums[begin + length] - sums[begin])], [doc]
    for size in BEGINNINGS:
        long = length >= size
        hashes.append(_mix(sums[begin[long] + size] - sums[begin[long]] + _U(size * 0x9E3779B97F4A7C15 % (1 << 64))))
        docs.append(doc[long])
    return np.concatenate(hashes), np.concatenate(docs)


@dataclass(frozen=True)
class Weights:
    """Sorted feature hashes, their weights, and the intercept; the words known from the labelled texts."""

    hashes: np.ndarray
    weights: np.ndarray
    intercept: float
    words: tuple[bytes, ...] = ()

    def __post_init__(self):
        # Most features are none of these; the table of their first twenty bits rules most of them out.
        table = np.zeros(1 << 20, bool)
        table[(self.hashes >> _U(44)).astype(np.int64)] = True
        object.__setattr__(self, "table", table)

    def found(self, hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The text and feature number of each weighed feature, once for each text."""
        likely = self.table[(hashes >> _U(44)).astype(np.int64)]
        hashes, doc = hashes[likely], doc[likely]
        if not len(self.hashes) or not len(hashes):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        same = self.hashes[place] == hashes
        pairs = np.unique(doc[same] * len(self.hashes) + place[same])
        return pairs // len(self.hashes), pairs % len(self.hashes)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        doc, number = self.found(*word_features(texts))
        margin = np.bincount(doc, self.weights[number], minlength=len(texts)) + self.intercept
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _logistic(doc: np.ndarray, number: np.ndarray, label: np.ndarray, n_features: int, correction: float) -> tuple:
    """Weights and intercept of a logistic model with a quadratic penalty, by accelerated gradient steps.

    ``correction`` is added to the margin of each row while fitting: the logarithm of how much oftener toxic rows were drawn.
    """
    n = len(label)
    degree = np.bincount(doc, minlength=n)
    rate = 4.0 / (max(degree.max(initial=0), 1) + 1 + PENALTY)
    weights, bias = np.zeros(n_features), 0.0
    ahead, ahead_bias = weights, bias
    # Steps are scaled by how often a feature occurs, so rare ones move as far.
    scale = 1 / np.maximum(np.bincount(number, minlength=n_features), 1)
    for step in range(400):
        margin = np.bincount(doc, ahead[number], minlength=n) + ahead_bias + correction
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label
        gradient = np.bincount(number, error[doc], minlength=n_features) + PENALTY * ahead
        old, old_bias = weights, bias
        weights = ahead - rate * scale * gradient
        bias = ahead_bias - rate * error.mean()
        push = step / (step + 3)
        ahead, ahead_bias = weights + push * (weights - old), bias + push * (bias - old_bias)
    return weights, bias


def _drawn(labels: DataFrame, sample: int) -> tuple[DataFrame, float]:
    """At most about ``sample`` labelled ids of each kind, and the logarithm of how much oftener toxic ones are drawn."""
    counts = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {kind: min(1.0, sample / n) for kind, n in counts.items()}
    least = F.when(F.col("toxic") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0))
    drawn = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < least * (1 << 30))
    return drawn, float(np.log(share.get(1, 1.0) / share.get(0, 1.0)))


def _best_features(rows: DataFrame, n_toxic: int, n_clean: int, limit: int = FEATURES) -> np.ndarray:
    """The hashes, in order, of the features of ``rows`` (restored, toxic) that speak most for toxicity, ``limit`` at most."""

    def features(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                hashes, doc = word_features(text_bytes(part.column(0)))
                order = np.lexsort((doc, hashes))
                hashes, doc = hashes[order], doc[order]
                once = np.ones(len(hashes), bool)
                once[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
                found, place = np.unique(hashes[once], return_inverse=True)
                toxic = np.asarray(part.column(1).to_pylist(), bool)[doc[once]]
                sums = [np.bincount(place[x], minlength=len(found)) for x in (toxic, ~toxic)]
                arrays = [pa.array(found.view(np.int64)), *(pa.array(x, pa.int64()) for x in sums)]
                yield pa.RecordBatch.from_arrays(arrays, names=["hash", "t", "c"])
        give_back()

    sums = rows.mapInArrow(features, "hash long, t long, c long").groupBy("hash").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    expected = (F.col("t") + F.col("c")) * n_toxic / (n_toxic + n_clean)
    seen = sums.where(F.col("t") >= LEAST_DOCS).withColumn("surprise", (F.col("t") - expected) / F.sqrt(expected + 1)).where("surprise > 0")
    # Equal ones in the order of their hashes without a sign.
    unsigned = F.col("hash").bitwiseXOR(F.lit(-(1 << 63)))
    kept = seen.orderBy(F.desc("surprise"), unsigned).select("hash").limit(limit).collect()
    return np.sort(np.array([r["hash"] for r in kept], np.int64).view(_U))


def fit(docs: DataFrame, labels: DataFrame, model: CharacterModel, sample: int = SAMPLE) -> Weights:
    """Weights learnt from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    An id with several labels is toxic if any of them says so; NULL ids and
    labels are left out. Without toxic or without clean documents the score is
    the share of toxic ones among the labelled (a half when there are none).
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)")
    known = materialize(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    drawn, correction = _drawn(known, sample)
    # At most twice the sample's size.
    rows = docs.join(F.broadcast(materialize(drawn, "drawn")), "doc_id").select("text", "toxic")
    # Every word that can be weighed as it stands is known.
    words = tuple(sorted(common_words(rows.select("text"))))
    shared = docs.sparkSession.sparkContext.broadcast(model.knowing(words))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        restorer = _restorer(shared)
        return [pa.array([restorer.text(x) for x in text_bytes(batch.column(0))], pa.binary())]

    rows = materialize(add_columns(rows, [T.StructField("restored", T.BinaryType())], compute).drop("text"), "toxic-sample")
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    if not n_toxic or not n_clean:
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
        return Weights(np.empty(0, _U), np.empty(0), float(np.log(share / (1 - share))), words)

    best = _best_features(rows.select("restored", "toxic"), n_toxic, n_clean)
    chosen = Weights(best, np.zeros(len(best)), 0.0)
    all_chosen = docs.sparkSession.sparkContext.broadcast(chosen)

    def numbers(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = text_bytes(batch.column(batch.schema.get_field_index("restored")))
        doc, number = all_chosen.value.found(*word_features(texts))
        ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(number, pa.int32()))]

    fields = [T.StructField("numbers", T.ArrayType(T.IntegerType()))]
    table = add_columns(rows, fields, numbers).select("toxic", "numbers").toPandas()
    lengths = table["numbers"].map(len).to_numpy()
    number = np.concatenate([np.asarray(x, np.int64) for x in table["numbers"]])
    doc = np.repeat(np.arange(len(table)), lengths)
    weights, bias = _logistic(doc, number, table["toxic"].to_numpy(float), len(best), correction)
    return Weights(chosen.hashes, weights, float(bias), words)


_RESTORERS: dict[int, Restorer] = {}


def _restorer(shared) -> Restorer:
    """One restorer in each Python worker for the model it has."""
    key = id(shared.value)
    if key not in _RESTORERS:
        _RESTORERS.clear()
        _RESTORERS[key] = Restorer(shared.value)
    return _RESTORERS[key]


def different_texts(texts: DataFrame, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, int]:
    """Each different text of ``texts``, the only column, once, and their number by hashes.

    Only texts whose hash occurs again are shuffled, unless there are too many such hashes to broadcast.
    """
    hashed = texts.select(F.col(texts.columns[0]).alias("text")).withColumn("hash", F.xxhash64("text"))
    counted = materialize(hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("n")), "text-hashes")
    again = counted.where("n > 1").select("hash")
    if measured_bytes(again) > max_bytes:
        return hashed.select("text").distinct(), counted.count()
    again = F.broadcast(again)
    alone = hashed.join(again, "hash", "left_anti").select("text")
    return alone.unionByName(hashed.join(again, "hash", "left_semi").select("text").distinct()), counted.count()


def character_model(docs: DataFrame, text: str = "text") -> CharacterModel:
    """The character model of the words of all texts, and the known words, counted in all the different texts.

    Copies count once. A word is known if it is in ``LEAST_DOCS`` of the texts and in a share ``LEAST_SHARE`` of them,
    so the list is bounded by the words a text has on average over that share, however many texts there are.
    """
    counts = np.array([tuple(r) for r in trigram_counts(docs, text).collect()], np.int64).reshape(-1, 2)
    texts, n = different_texts(docs.select(text))
    return CharacterModel(counts[:, 0], counts[:, 1], common_words(texts, max(LEAST_DOCS, math.ceil(LEAST_SHARE * n))))


def score(docs: DataFrame, model: CharacterModel, weights: Weights, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability that the restored text is toxic; it replaces a column of that name.

    NULL and empty texts have no features and get the score of such a text.
    Equal texts get equal scores, whatever their other columns.
    """
    context = docs.sparkSession.sparkContext
    shared, weighed = context.broadcast(model.knowing(weights.words)), context.broadcast(weights)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        restorer, out = _restorer(shared), []
        column = batch.column(batch.schema.get_field_index(text))
        for at in range(0, len(column), 256):
            restored = [restorer.text(x) for x in text_bytes(column.slice(at, 256))]
            out.append(weighed.value.scores(restored))
        return [pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())]

    return add_columns(docs, [T.StructField("score", T.DoubleType())], compute)


def restored(docs: DataFrame, model: CharacterModel, text: str = "text") -> DataFrame:
    """``docs`` with ``restored``, the text with its suspicious tokens decoded; NULL stays NULL."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        restorer = _restorer(shared)
        column = batch.column(batch.schema.get_field_index(text))
        found = [None if x is None else restorer.text(x).decode(errors="replace") for x in column.cast(pa.binary()).to_pylist()]
        return [pa.array(found, pa.string())]

    return add_columns(docs, [T.StructField("restored", T.StringType())], compute)
