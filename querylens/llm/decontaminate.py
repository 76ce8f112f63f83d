"""Benchmark decontamination: one Aho-Corasick automaton over the words of all test items, run once over each text.

The automaton reads words, not characters: its patterns are the windows of
the items, and a match ends at a word's number, which gives the place in the
original text. It is built once per Python worker from the items' texts, whose
size is measured; items beyond ``BLOCK_BYTES`` go into further automata, and
the texts pass them one after the other without a shuffle.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from querylens.llm.common import add_columns, split_words, text_bytes

WINDOW = 10
# Text of the items in one automaton. Its nodes take about a hundred times as much memory.
BLOCK_BYTES = 1 << 20

_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_IDS = T.ArrayType(T.StringType())
_ARROW_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


class Matcher:
    """Finds all windows of a set of items in the words of a text."""

    def __init__(self, items: Iterable[tuple[str | None, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        self.window = window
        patterns: dict[tuple[int, ...], set[str | None]] = {}
        for item_id, text in items:
            found = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in split_words(text)]
            for i in range(max(1, len(found) - window + 1) if found else 0):
                patterns.setdefault(tuple(found[i : i + window]), set()).add(item_id)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for pattern, ids in patterns.items():
            self.automaton.add_word(pattern, (len(pattern), tuple(ids)))
        self.empty = not patterns
        if not self.empty:
            self.automaton.make_automaton()

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Merged ranges of hit words, and the ids of the items that occur."""
        if self.empty or not words:
            return [], set()
        number = self.numbers.get
        hits, ids = [], set()
        for last, (length, items) in self.automaton.iter(tuple([number(w, 0) for w in words])):
            hits.append((last + 1 - length, last + 1))
            ids.update(items)
        return merged(hits), ids


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges without overlap that cover the same places."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_WORD_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def original_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """The characters of the original text from the first to the last word of each range."""
    if not ranges:
        return []
    places = [m.span() for m in _WORD_BYTES.finditer(text)]
    spans, at, chars = [], 0, 0
    for first, end in ranges:
        start, stop = places[first][0], places[end - 1][1]
        chars += len(text[at:start].decode())
        length = len(text[start:stop].decode())
        spans.append({"start": chars, "end": chars + length})
        chars, at = chars + length, stop
    return spans


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> list[list[tuple[str | None, bytes]]]:
    """The items, in lists of bounded size; one list is collected at a time."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("binary").alias("text"))
    items = items.where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [[(r["item"], bytes(r["text"])) for r in items.where(block == b).collect()] for b in range(n)]


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with the benchmark passages found in each whole text.

    A window is ``window`` consecutive words of an item, or all words of a
    shorter one. Added columns: ``n_words``; ``n_hit``, the words inside any
    occurrence of a window; ``items``, the ids of the items that occur, as
    sorted texts; ``spans``, the hit parts of the original text as character
    offsets. They replace columns of ``docs`` with the same names.

    NULL and empty texts have no words and no hits, an item without words
    never occurs, and one without an id makes hits but isn't listed. Repeated
    documents and items change nothing; an empty benchmark finds nothing.
    """
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, item_id, item_text, block_bytes)
    out = docs
    for number, items in enumerate(blocks):
        out = _scan(out, context.broadcast(items), text, window, number == 0, number == len(blocks) - 1)
    return out.drop("_ranges")


_BUILT: dict[str, Matcher] = {}


def _matcher(token: str, items, window: int) -> Matcher:
    """The automaton of a scan, built once in each Python worker."""
    if token not in _BUILT:
        _BUILT.clear()
        _BUILT[token] = Matcher(items.value, window)
    return _BUILT[token]


def _scan(docs: DataFrame, items, text: str, window: int, first: bool, last: bool) -> DataFrame:
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", _IDS),
        T.StructField("spans", _SPAN),
        T.StructField("_ranges", _SPAN),
    ]
    token = uuid.uuid4().hex

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        matcher = _matcher(token, items, window)
        column = {f.name: i for i, f in enumerate(batch.schema)}
        texts = text_bytes(batch.column(column[text]))
        earlier = None if first else batch.column(column["_ranges"]).to_pylist()
        known = None if first else batch.column(column["items"]).to_pylist()
        n_words, n_hit, found, spans, ranges = [], [], [], [], []
        for i, raw in enumerate(texts):
            tokens = split_words(raw)
            places, ids = matcher.find(tokens)
            if not first:
                places = merged([*places, *((r["start"], r["end"]) for r in earlier[i])])
                ids.update(known[i])
            n_words.append(len(tokens))
            n_hit.append(sum(end - start for start, end in places))
            found.append(sorted(x for x in ids if x is not None))
            spans.append(original_spans(raw, places) if last else [])
            ranges.append([{"start": start, "end": end} for start, end in places])
        return [
            pa.array(n_words, pa.int64()),
            pa.array(n_hit, pa.int64()),
            pa.array(found, pa.list_(pa.string())),
            pa.array(spans, _ARROW_SPAN),
            pa.array(ranges, _ARROW_SPAN),
        ]

    return add_columns(docs, fields, compute)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents in which no benchmark passage occurs, with their own columns; cases as in ``find_passages``."""
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    found = find_passages(numbered, benchmark, text=f"c{docs.columns.index(text)}").where("n_hit = 0")
    return found.select(*numbered.columns).toDF(*docs.columns)
