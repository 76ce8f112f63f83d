"""Fill-in-the-middle: texts cut at token boundaries, with their parts in another order.

A token is a run of letters A to Z or any other single character. Each
character's class says whether it is a letter and whether a letter stands
before it, so a token starts at every character but those of the class "letter
after a letter". A wavelet matrix over the classes answers how often a class
occurs before a place; what is left of the place without that class is the
number of tokens that start before it. The place of a cut after so many tokens
is found by bisection on these ranks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from querylens.llm.common import add_columns, text_chunks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # of 100 texts, those from this one on stay as they are
SUFFIX_FIRST_BELOW = 20  # of 100 others, those below begin with the suffix

_AFTER_LETTER, _LETTER = 1, 2  # the two bits of a class
_WORD = 64


class _Bits:
    """A row of bits with the number of ones before each place."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // _WORD + 1) * (_WORD // 8), np.uint8)
        found = np.packbits(bits, bitorder="little")
        packed[: len(found)] = found
        self.words = packed.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, end: np.ndarray) -> np.ndarray:
        """Ones before each of the places ``end``."""
        word, bit = end // _WORD, (end % _WORD).astype(np.uint64)
        below = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Ranks of small numbers in a row of them: one row of bits for each binary digit, the highest first.

    After each digit the numbers are put in order by it, zeros before ones,
    and otherwise as they were.
    """

    def __init__(self, values: np.ndarray, digits: int):
        self.levels: list[tuple[_Bits, int]] = []
        for digit in reversed(range(digits)):
            bit = (values >> digit & 1).astype(bool)
            self.levels.append((_Bits(bit), int(len(bit) - bit.sum())))
            values = np.concatenate([values[~bit], values[bit]])

    def rank(self, value: int, end: np.ndarray) -> np.ndarray:
        """How often ``value`` occurs before each of the places ``end``."""
        start = np.zeros_like(end)
        for i, (bits, zeros) in enumerate(self.levels):
            if value >> (len(self.levels) - 1 - i) & 1:
                start, end = zeros + bits.ones(start), zeros + bits.ones(end)
            else:
                start, end = start - bits.ones(start), end - bits.ones(end)
        return end - start


class Boundaries:
    """Token boundaries of several texts that lie one after the other as UTF-8 in ``data``.

    Places are those of characters, counted over all the texts.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.at = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of each character
        self.texts = np.searchsorted(self.at, offsets)
        low = data[self.at] | 0x20
        letter = (low >= ord("a")) & (low <= ord("z"))
        after = np.concatenate([[False], letter[:-1]])
        after[self.texts[:-1][self.texts[:-1] < len(after)]] = False
        classes = letter.astype(np.uint8) * _LETTER + after.astype(np.uint8) * _AFTER_LETTER
        self.classes = WaveletMatrix(classes, 2)
        self.at = np.append(self.at, len(data))

    def started(self, end: np.ndarray) -> np.ndarray:
        """Tokens that start before each of the places."""
        return end - self.classes.rank(_LETTER + _AFTER_LETTER, end)

    def count(self) -> np.ndarray:
        """Tokens of each text."""
        return np.diff(self.started(self.texts))

    def cut(self, tokens: np.ndarray) -> np.ndarray:
        """The place in each text after its first ``tokens`` tokens.

        That is the last place before which no more tokens start: either the
        next token starts there, or the text ends.
        """
        low, high = self.texts[:-1].copy(), self.texts[1:].copy()
        wanted = self.started(low) + tokens
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            fits = self.started(middle) <= wanted
            low = np.where(open_ & fits, middle, low)
            high = np.where(open_ & ~fits, middle - 1, high)
        return low


def _arranged(text: bytes, first: int, second: int, form: str) -> bytes:
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if form == "plain":
        return text
    if form == "psm":
        return b"".join((p, text[:first], s, text[second:], m, text[first:second]))
    return b"".join((s, text[second:], p, text[:first], m, text[first:second]))


def _draws(doc_id: Column) -> list[Column]:
    """The first four groups of eight hexadecimal digits of the hash of an id, as numbers."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of each row of ``docs``.

    ``n`` counts the tokens of the text and ``output`` is the text in the order
    of ``form``: psm, spm or plain. The cuts and the form follow from the id
    alone, so rows with the same id and text have the same output. A NULL id
    counts as an empty one. A NULL text is empty; empty texts, and those that
    contain a mark, are plain, without numbers of characters. A text is cut
    as a whole, however long. An empty table gives an empty one.
    """
    h1, h2, h3, h4 = _draws(F.col(doc_id))
    chosen = F.when(h3 % 100 >= PLAIN_FROM, "plain").when(h4 % 100 < SUFFIX_FIRST_BELOW, "spm").otherwise("psm")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), h1.alias("h1"), h2.alias("h2"))
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    rows = rows.withColumn("form", F.when((F.col("text") == "") | marked, "plain").otherwise(chosen))
    fields = [
        T.StructField("n", T.LongType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        h1, h2 = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("h1", "h2"))
        forms = np.array(batch.column(batch.schema.get_field_index("form")).to_pylist(), object)
        counts, prefixes, middles, outputs = [], [], [], []
        at = 0
        for data, offsets in text_chunks(batch.column(batch.schema.get_field_index("text"))):
            rows = slice(at, at + len(offsets) - 1)
            at = rows.stop
            texts = Boundaries(data, offsets)
            n = texts.count()
            a, b = h1[rows] % (n + 1), h2[rows] % (n + 1)
            first, second = texts.cut(np.minimum(a, b)), texts.cut(np.maximum(a, b))
            counts.append(n)
            prefixes.append(first - texts.texts[:-1])
            middles.append(second - first)
            raw = data.tobytes()
            for i, form in enumerate(forms[rows]):
                begin = offsets[i]
                ends = texts.at[first[i]] - begin, texts.at[second[i]] - begin
                outputs.append(_arranged(raw[begin : offsets[i + 1]], *ends, form))
        plain = forms == "plain"

        def whole(parts: list[np.ndarray], mask: np.ndarray | None = None) -> pa.Array:
            return pa.array(np.concatenate([np.empty(0, np.int64), *parts]).astype(np.int64), mask=mask)

        output = pa.array(outputs, pa.binary()).cast(pa.string())
        return [whole(counts), whole(prefixes, plain), whole(middles, plain), output]

    made = add_columns(rows, fields, compute)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")


def restored(output: Column, form: Column) -> Column:
    """The text behind an ``output`` of ``fill_in_middle``: no part of it contains a mark, so the marks divide it."""
    part = F.split(output, "<[PSM]>")
    psm = F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2)))
    spm = F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
