"""Language identification in two steps: the family first, then the language within it.

Both steps are linear support vector machines on hashed runs of one to three
bytes, one for each pair of classes. Families are far apart and settled by the
first; the second weighs what tells close relatives apart.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F, types as T

from querylens.llm.common import add_columns, text_chunks
from querylens.sources.scratch import materialize

# Labelled documents per language that the machines are fitted on, at most; drawn by a hash beyond it.
SAMPLE = 1000
DIMENSIONS = 2048
ITERATIONS = 30
REGULARIZATION = 0.01
# How steeply a margin becomes a probability: 0.95 at the edge of the margin.
STEEPNESS = 3.0
UNDETERMINED = "und"

# Which family a language code belongs to; codes that aren't listed share one.
FAMILIES = {
    "da": "germanic", "de": "germanic", "en": "germanic", "nl": "germanic", "no": "germanic", "sv": "germanic",
    "ca": "romance", "es": "romance", "fr": "romance", "it": "romance", "pt": "romance", "ro": "romance",
    "bg": "slavic", "cs": "slavic", "pl": "slavic", "ru": "slavic", "sk": "slavic", "uk": "slavic",
}
OTHER_FAMILY = "other"


@dataclass(frozen=True)
class Pairwise:
    """Linear machines between each two classes; margins above 0 speak for the first."""

    classes: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMENSIONS)))
    intercepts: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def duels(self, features: np.ndarray) -> np.ndarray:
        """Mean share of each class in its duels; the likeliest class has a half at least, however many there are."""
        if len(self.classes) == 1:
            return np.ones((len(features), 1))
        first = 1 / (1 + np.exp(-STEEPNESS * (features @ self.weights.T + self.intercepts)))
        shares = np.zeros((len(features), len(self.classes)))
        for i, (a, b) in enumerate(self.pairs):
            shares[:, a] += first[:, i]
            shares[:, b] += 1 - first[:, i]
        return shares / (len(self.classes) - 1)


@dataclass(frozen=True)
class Model:
    """The family step, and the language step of each family."""

    families: Pairwise
    languages: dict[str, Pairwise]

    def predict(self, features: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The likeliest language of the likeliest family, the product of both probabilities, and that of the shares in duels.

        Probabilities add up to 1 over the classes, so the more classes, the smaller they are; shares don't get smaller.
        """
        names, scores, sure = np.empty(len(features), object), np.zeros(len(features)), np.zeros(len(features))
        family = self.families.duels(features)
        best = family.argmax(axis=1)
        for i, name in enumerate(self.families.classes):
            rows = np.flatnonzero(best == i)
            step = self.languages[name]
            shares = step.duels(features[rows])
            chosen = shares.argmax(axis=1)
            names[rows] = np.array(step.classes, object)[chosen]
            won, total = shares[np.arange(len(rows)), chosen], shares.sum(axis=1)
            sure[rows] = family[rows, i] * won
            scores[rows] = family[rows, i] / family[rows].sum(axis=1) * (won / total)
        # Matrix products differ in their last digits with the number of rows.
        return list(names), np.round(scores, 9), np.round(sure, 9)


def _letters_only() -> np.ndarray:
    """Byte by byte: letters in lower case, bytes beyond ASCII as they are, one blank for the rest."""
    table = np.full(256, ord(" "), np.uint8)
    table[128:] = np.arange(128, 256)
    for code in range(ord("a"), ord("z") + 1):
        table[code] = table[code - 32] = code
    return table


_TABLE = _letters_only()


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row for each text: square roots of the frequencies of its hashed runs of one to three bytes, of length 1."""
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    low = _TABLE[data]
    kept = np.ones(len(low), bool)
    kept[1:] = (low[1:] != 32) | (low[:-1] != 32) | (doc[1:] != doc[:-1])
    low, doc = low[kept].astype(np.uint32), doc[kept]
    counts = np.zeros(n * DIMENSIONS)
    code = np.zeros(len(low), np.uint32)
    for size in (1, 2, 3):
        end = len(low) - size + 1
        if end <= 0:
            break
        code = code[:end] * np.uint32(256) + low[size - 1 :]
        hashed = (code * np.uint32(2654435761) + np.uint32(size * 40503)) >> np.uint32(21)
        same = doc[:end] == doc[size - 1 :]
        counts += np.bincount(doc[:end][same] * DIMENSIONS + hashed[same], minlength=len(counts))
    rows = np.sqrt(counts.reshape(n, DIMENSIONS))
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


_LETTER = re.compile(r"[^\W\d_]")


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> Iterator[bool]:
    low = _TABLE[data]
    ascii_ = np.concatenate([[0], np.cumsum((low != 32) & (low < 128))])
    for start, end in zip(offsets[:-1], offsets[1:], strict=True):
        yield bool(ascii_[end] > ascii_[start] or _LETTER.search(data[start:end].tobytes().decode()))


def _drawn(labelled: DataFrame, sample: int) -> DataFrame:
    """At most about ``sample`` different texts of each language, drawn by a hash of the text; copies count once."""
    different = labelled.select("lang", F.xxhash64("text").alias("hash")).distinct()
    counts = {r["lang"]: r["n"] for r in different.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, sample / n)).otherwise(share)
    return labelled.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share * (1 << 30)).distinct()


def _fit_pairs(rows: DataFrame, label: str, classes: list[str]) -> Pairwise:
    pairs = list(itertools.combinations(range(len(classes)), 2))
    weights, intercepts = [], []
    for a, b in pairs:
        both = rows.where(F.col(label).isin(classes[a], classes[b]))
        both = both.withColumn("first", (F.col(label) == classes[a]).cast("double"))
        machine = LinearSVC(labelCol="first", maxIter=ITERATIONS, regParam=REGULARIZATION).fit(both)
        weights.append(machine.coefficients.toArray())
        intercepts.append(machine.intercept)
    return Pairwise(classes, pairs, np.array(weights).reshape(len(pairs), DIMENSIONS), np.array(intercepts))


def fit(
    labelled: DataFrame, families: Mapping[str, str] = FAMILIES, sample: int = SAMPLE
) -> Model | None:
    """A model of the languages of ``labelled`` (text, lang); None without any.

    Rows without a language, and texts without a letter, are left out. At most
    about ``sample`` texts of each language are used, whole.
    """
    rows = _drawn(labelled.where("lang is not null and text is not null").select("text", "lang"), sample)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        out, known = [], []
        for data, offsets in text_chunks(batch.column(0)):
            out.append(features(data, offsets).astype(np.float32))
            known += _has_letter(data, offsets)
        flat = np.concatenate(out).reshape(-1) if out else np.empty(0, np.float32)
        ends = pa.array(np.arange(len(known) + 1) * DIMENSIONS, pa.int32())
        return [pa.ListArray.from_arrays(ends, pa.array(flat)), pa.array(known, pa.bool_())]

    fields = [T.StructField("values", T.ArrayType(T.FloatType())), T.StructField("known", T.BooleanType())]
    rows = materialize(add_columns(rows, fields, compute).where("known").select("lang", "values"), "language-sample")
    names = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not names:
        return None
    by_family: dict[str, list[str]] = {}
    for name in names:
        by_family.setdefault(families.get(name, OTHER_FAMILY), []).append(name)
    family = F.lit(OTHER_FAMILY)
    for name, members in by_family.items():
        family = F.when(F.col("lang").isin(members), name).otherwise(family)
    rows = rows.select("lang", family.alias("family"), array_to_vector(F.col("values").cast("array<double>")).alias("features"))
    steps = {name: _fit_pairs(rows, "lang", members) for name, members in by_family.items()}
    return Model(_fit_pairs(rows, "family", sorted(by_family)), steps)


def predict(docs: DataFrame, model: Model | None, text: str = "text", sure: str | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` from each whole text; they replace columns of these names.

    A NULL text, an empty one, and one without a letter get ``und`` and score
    0; so does every text when there is no model. Other columns are not
    looked at. Equal texts get equal results. ``sure`` names one more column:
    the language's mean share in its duels times its family's, which unlike
    ``score`` doesn't fall with the number of languages.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        names, scores, shares = [], [], []
        for data, offsets in text_chunks(batch.column(batch.schema.get_field_index(text))):
            known = np.array(list(_has_letter(data, offsets)), bool)
            if shared.value is None:
                known[:] = False
                found, likely, share = [UNDETERMINED] * len(known), np.zeros(len(known)), np.zeros(len(known))
            else:
                found, likely, share = shared.value.predict(features(data, offsets))
            names += [x if k else UNDETERMINED for x, k in zip(found, known, strict=True)]
            scores.append(np.where(known, likely, 0.0))
            shares.append(np.where(known, share, 0.0))
        numbers = [scores, shares] if sure else [scores]
        return [pa.array(names, pa.string()), *(pa.array(np.concatenate([np.empty(0), *x]), pa.float64()) for x in numbers)]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    fields += [T.StructField(sure, T.DoubleType())] if sure else []
    return add_columns(docs, fields, compute)


def identified(docs: DataFrame, model: Model | None, text: str = "text", min_score: float = 0.3) -> DataFrame:
    """The documents whose language is determined with at least ``min_score``, with their own columns.

    The measure is ``sure`` of ``predict``, the same for two languages as for many. Cases as in ``predict``. Without a model nothing can be told, and only
    documents without a letter go.
    """
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    name = f"c{docs.columns.index(text)}"
    if model is None:
        kept = numbered.where(F.col(name).rlike(r"\p{L}"))
    else:
        kept = predict(numbered, model, name, "sure").where((F.col("lang_pred") != UNDETERMINED) & (F.col("sure") >= min_score))
    return kept.select(*numbered.columns).toDF(*docs.columns)
