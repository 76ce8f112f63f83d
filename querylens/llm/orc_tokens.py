"""Token ids of documents in ORC files.

Documents are dealt to tasks by ranges of their ids and sorted, so the files
are in ascending order and their order is that of the ranges. A file has one row per
document; ORC keeps the ids run-length encoded in stripes, with the smallest
and largest document id of each stripe and row group, and a Bloom filter on
them. A reader that asks for some ids skips whole files, stripes and row
groups, and stripes are read by different tasks.

A document's place in its file is known when it is encoded; the place of a
file among all files follows from the sums of the files, which a small table
beside them (``files``) holds.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from tokenizers import Tokenizer, pre_tokenizers

from querylens.llm.common import add_columns, give_back, kept_for, limit_batches

END_ID = 1
STRIPE_BYTES = 16 << 20
ROWS_PER_GROUP = 1000
# Pieces between blanks whose ids a worker remembers, half of them the most frequent ones, and the bytes of the longest.
REMEMBERED = 250_000
REMEMBERED_BYTES = 48
# Texts that are encoded together, and their bytes; one longer text is taken alone.
TEXTS = 16384
TEXT_BYTES = 2 << 20
# New pieces that the library encodes in one call, and pieces whose ids are put in place at a time: what a worker holds beside texts and ids.
CALL = 4096
PLACED = 1 << 16

_FIELDS = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("file_start", T.LongType()),
    T.StructField("tokens", T.ArrayType(T.IntegerType())),
]


# A word of letters whose lower case is a single letter too, and a mark after it that no rule joins with letters.
_WORD = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
_BEFORE_MARKS = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~])"
_COMBINING = r"\pM"
_PROBES = ["a b", " a  b ", "it 's", "x \u0301 y", "1 2\n3", "! ?", "<|endoftext|> a", "Ab, cd...", "É ü", "J\u030c, x"]


def _strings(texts: pa.Array) -> list[str]:
    """``texts.to_pylist()``, which makes a scalar for each text, by way of an array of objects made in one go."""
    return texts.to_numpy(zero_copy_only=False).tolist()


class TextEncoder:
    """Token ids of whole texts by the tokenizers library, which sees each repeated piece once.

    A tokenizer that drops white space and marks the ends of words gives a
    text the ids of its pieces between blanks, and a piece of a word and marks
    the ids of the two. So the words that are new in a batch are encoded in
    one call and remembered, all in arrays, without Python objects for those that are known. Whether a tokenizer is of that kind is tried when
    it is loaded; one that is not encodes whole texts.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        self.type = "<u2" if max(vocabulary.values()) < 1 << 16 else "<i4"
        suffix = getattr(self.whole.model, "end_of_word_suffix", None)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        # The same model on words that are clean already.
        self.plain = Tokenizer(self.whole.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        # What begins a special token; those are looked for before anything else.
        self.special = "<|"
        # The pieces that are remembered, how often each was met, their ids one after the other, and how many each has.
        self.known = pa.array([], pa.string())
        self.met, self.ids, self.sizes = np.empty(0, np.int64), np.empty(0, self.type), np.empty(0, np.int64)
        self.exact = bool(suffix) and self._same_by_pieces()

    def _same_by_pieces(self) -> bool:
        tried = (_PROBES, [x for x in _PROBES if self.special not in x])
        starts = all(x.content.startswith(self.special) for x in self.whole.get_added_tokens_decoder().values())
        return starts and all(self._by_pieces(pa.array(x))[0].tobytes() == b"".join(self._all(x)) for x in tried)

    def _all(self, texts: list[str]) -> list[bytes]:
        found = self.whole.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.type).tobytes() for x in found]

    def _ids_of_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.frombuffer(x, self.type) for x in self._all(texts)]
        return np.concatenate([np.empty(0, self.type), *found]), np.array([len(x) for x in found], np.int64)

    def _in_calls(self, ids_of: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``ids_of`` all pieces, ``CALL`` at a time: the library keeps some hundred bytes for each token of a call."""
        found = [ids_of(pieces.slice(at, CALL)) for at in range(0, max(1, len(pieces)), CALL)]
        ids, sizes = zip(*found, strict=True)
        return np.concatenate(ids), np.concatenate(sizes)

    def _ids_of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(words):
            return np.empty(0, self.type), np.empty(0, np.int64)
        text = " ".join(_strings(pc.utf8_lower(words)))
        ids = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.type)
        last = np.flatnonzero(self.ends[ids]) + 1
        return (ids, np.diff(last, prepend=0)) if len(last) == len(words) else self._ids_of_all(_strings(words))

    def _learn(self, new: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The pieces, words first, the ids of all of them, and how many each has."""
        word = pc.match_substring_regex(new, _WORD)
        words, rest = new.filter(word), new.filter(pc.invert(word))
        ids, sizes = self._in_calls(self._ids_of_words, words)
        more, sizes_of_rest = self._in_calls(lambda pieces: self._ids_of_all(_strings(pieces)), rest)
        return pa.concat_arrays([words, rest]), np.concatenate([ids, more]), np.concatenate([sizes, sizes_of_rest])

    def _forget(self) -> None:
        """Let go the longest pieces, and all but the most frequent if there are too many."""
        keep = pc.binary_length(self.known).to_numpy() <= REMEMBERED_BYTES
        if keep.sum() > REMEMBERED:
            keep[np.argsort(np.where(keep, -self.met, 1), kind="stable")[REMEMBERED // 2 :]] = False
            self.met //= 2
        if not keep.all():
            self.ids = self.ids[np.repeat(keep, self.sizes)]
            self.known, self.met, self.sizes = self.known.filter(pa.array(keep)), self.met[keep], self.sizes[keep]

    def _places(self, pieces: pa.DictionaryArray) -> np.ndarray:
        """Where each piece is among those that are remembered; new ones are learnt."""
        distinct, number = pieces.dictionary, pieces.indices.to_numpy()
        place = pc.index_in(distinct, value_set=self.known)
        is_new = place.is_null()
        new, ids, sizes = self._learn(distinct.filter(is_new))
        place = place.fill_null(0).to_numpy().copy()
        # They are remembered with words first.
        place[is_new.to_numpy(zero_copy_only=False)] = len(self.known) + pc.index_in(distinct.filter(is_new), value_set=new).to_numpy()
        self.known = pa.concat_arrays([self.known, new])
        self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])
        self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        self.met[place] += np.bincount(number, minlength=len(distinct))
        return place[number]

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not pc.any(pc.match_substring(texts, self.special)).as_py():
            # None of these changes any id, and more pieces are alike: a mark after a letter begins a piece of its own.
            # Before a combining mark a small letter may be composed where its capital isn't; such texts keep capitals.
            combining = pc.match_substring_regex(texts, _COMBINING)
            texts = pc.if_else(combining, texts, pc.ascii_lower(texts))
            texts = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " "), _BEFORE_MARKS, r"\1 \2")
        lists = pc.split_pattern(texts, " ")
        place = self._places(lists.flatten().dictionary_encode())
        edges = lists.offsets.to_numpy().astype(np.int64)
        del texts, lists
        ends = np.concatenate([[0], np.cumsum(self.sizes[place])])
        before = np.cumsum(self.sizes) - self.sizes
        flat = np.empty(ends[-1], self.type)
        for at in range(0, len(place), PLACED):
            some, edge = place[at : at + PLACED], ends[at : at + PLACED + 1]
            flat[edge[0] : edge[-1]] = self.ids[np.repeat(before[some] - edge[:-1], np.diff(edge)) + np.arange(edge[0], edge[-1])]
        self._forget()
        return flat, np.diff(ends[edges - edges[0]])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and how many each has."""
        if self.exact:
            return self._by_pieces(texts.cast(pa.string()))
        return self._ids_of_all(texts.to_pylist())


def _one_core_encoder(path: str) -> TextEncoder:
    """An encoder for a worker, which has one core; threads of the library would each keep memory of their own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return TextEncoder(path)


def _together(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[list[pa.RecordBatch]]:
    """The rows in lists of batches with up to ``TEXTS`` texts of ``TEXT_BYTES``; one longer text is alone."""
    parts, texts, size = [], 0, 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            fit = min(int(np.searchsorted(ends, before + TEXT_BYTES - size, "right")), at + TEXTS - texts)
            if fit <= at and parts:
                yield parts
                parts, texts, size = [], 0, 0
                continue
            part = batch.slice(at, max(1, fit - at))
            at += part.num_rows
            parts, texts, size = [*parts, part], texts + part.num_rows, size + int(ends[at - 1]) - before
    if parts:
        yield parts


def encode(docs: DataFrame, tokenizer: str, text: str = "text", end_id: int = END_ID) -> DataFrame:
    """``docs`` with ``tokens`` in place of the text, ``n_tokens``, and ``file_start``: the tokens before it in its task.

    ``tokenizer`` is the path of a tokenizer file on every machine. NULL is
    encoded as an empty text, so each document has at least its end id.
    """
    kept = [f for f in docs.schema.fields if f.name != text and f.name not in {x.name for x in _FIELDS}]
    schema = T.StructType([*kept, *_FIELDS])
    limit_batches(docs.sparkSession)

    def run(batches):
        encoder, start = kept_for(f"encoder of {tokenizer}", lambda: _one_core_encoder(tokenizer)), 0
        for parts in _together(batches, text):
            column = pa.concat_arrays([x.column(text) for x in parts])
            ids, lengths = encoder.encode(column.fill_null(""))
            values = np.insert(ids.astype(np.int32), np.cumsum(lengths), end_id)
            offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
            tokens = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
            made, at = [pa.array(lengths + 1), pa.array(start + offsets[:-1]), tokens], 0
            for part in parts:
                columns = [*[part.column(f.name) for f in kept], *[x.slice(at, part.num_rows) for x in made]]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                at += part.num_rows
            start += int(offsets[-1])
            # What is remembered lies between the pieces of what isn't, which the process would hold as free memory.
            give_back()

    return docs.mapInArrow(run, schema)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    stripe_bytes: int = STRIPE_BYTES,
    rows_per_group: int = ROWS_PER_GROUP,
) -> None:
    """Encode whole texts and write them to ORC files under ``path`` in ascending order of their ids.

    A NULL id comes first, rows with the same id in order of a hash of their
    texts, which also spreads an id that many rows share over several files. A
    NULL text is an empty one; an empty table makes files without rows. Other
    columns are not written.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    (
        encode(ordered, tokenizer)
        .write.option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", rows_per_group)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(f"{path}/tokens")
    )
    spark = docs.sparkSession
    name = F.regexp_extract("_metadata.file_path", r"([^/]*)$", 1)
    sums = spark.read.orc(f"{path}/tokens").groupBy(name.alias("file")).agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.count(F.lit(1)).alias("n_docs"),
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"),
    )
    # One row per file; names start with the number of the range.
    earlier = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    files = sums.withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    files.write.parquet(f"{path}/files")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents as written: (doc_id, start, n_tokens, tokens); ``start`` counts the tokens of all documents before it.

    A filter on ``doc_id`` reaches the files' indexes and Bloom filters.
    """
    name = F.regexp_extract("_metadata.file_path", r"([^/]*)$", 1)
    tokens = spark.read.orc(f"{path}/tokens").withColumn("file", name)
    files = spark.read.parquet(f"{path}/files").select("file", "start")
    joined = tokens.join(files, "file")
    return joined.select("doc_id", (F.col("start") + F.col("file_start")).alias("start"), "n_tokens", "tokens")


def with_checksum(rows: DataFrame) -> DataFrame:
    """``ids_crc32`` in place of ``tokens``: the unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        tokens = batch.column(batch.schema.get_field_index("tokens"))
        values, offsets = tokens.values.to_numpy(zero_copy_only=False).astype("<u4"), tokens.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return [pa.array(sums, pa.int64())]

    return add_columns(rows, [T.StructField("ids_crc32", T.LongType())], compute, keep=True).drop("tokens")
