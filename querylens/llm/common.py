"""Helpers shared by the operators: reading tables, rules for folds, columns made by Arrow code."""

from __future__ import annotations

import ctypes
import functools
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Words of the operators that compare texts: runs of digits, lower-case letters and anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Texts that vectorised code takes together, and their bytes; one longer text is taken alone.
CHUNK_TEXTS = 512
CHUNK_BYTES = 1 << 20

# Bytes of the batches that Spark hands to Arrow code; a worker and Spark's side of it hold a few of them at a time.
BATCH_BYTES = 2 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """``crc32`` of the key's text modulo ``folds``; NULL for a NULL key."""
    return F.crc32(F.col(key).cast("string")) % folds


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text, in order; none for NULL."""
    found = F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), 1)
    return F.coalesce(found, F.array().cast("array<string>"))


@functools.cache
def byte_words() -> bytes:
    """The table that turns the UTF-8 bytes of a text into lower-case words between spaces."""
    kept = re.compile(WORD)
    out = bytearray(range(256))
    for code in range(128):
        low = chr(code).lower()
        out[code] = ord(low) if kept.fullmatch(low) else ord(" ")
    return bytes(out)


def split_words(text: bytes) -> list[bytes]:
    """``words`` on the UTF-8 bytes of a text."""
    return text.translate(byte_words()).split()


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; no bytes for NULL."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def _texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts, and where each text begins; NULL is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def text_chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts of a column in chunks of whole texts: all their bytes, and where each begins."""
    data, offsets = _texts_of(column)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        end = min(end, at + CHUNK_TEXTS, len(column))
        yield data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


# What a worker process keeps from one task to the next, for one operator at a time.
_KEPT: dict[str, object] = {}


def kept_for(owner: str, make: Callable[[], object]) -> object:
    """What this worker keeps for ``owner``, made if it isn't there; what it keeps for others is let go."""
    for other in [*_KEPT]:
        if other != owner:
            del _KEPT[other]
    if owner not in _KEPT:
        _KEPT[owner] = make()
    return _KEPT[owner]


def keep_nothing() -> None:
    """Let go what this worker keeps. Workers outlive the operator they worked for."""
    if _KEPT:
        _KEPT.clear()
        give_back()


def give_back() -> None:
    """Return free memory to the machine at the end of a task; an idle worker holds it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def limit_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session end at ``BATCH_BYTES``, or sooner if the session says so.

    Spark reads the setting when a result is computed, so it stays as it is
    now. A batch of 10,000 rows may hold any number of long texts otherwise.
    """
    number, unit = re.fullmatch(r"(\d+)([a-z]?).*", spark.conf.get(_BATCH_SETTING).lower()).groups()
    if int(number) << 10 * "bkmgt".index(unit or "b") > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)


def add_columns(
    df: DataFrame,
    fields: Sequence[T.StructField],
    compute: Callable[[pa.RecordBatch], Sequence[pa.Array]],
    keep: bool = False,
) -> DataFrame:
    """``df`` with the columns ``compute`` makes of each Arrow batch.

    Workers let go what they keep for other operators, unless ``keep`` says
    that this is a step of the same one. A column of ``df`` with the name of a new one is replaced, as ``withColumn`` does.
    """
    limit_batches(df.sparkSession)
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    schema = T.StructType([*kept, *fields])
    names = [f.name for f in kept]

    def run(batches):
        if not keep:
            keep_nothing()
        for batch in batches:
            made = compute(batch)
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, *made], names=[*names, *(f.name for f in fields)])
        give_back()

    return df.mapInArrow(run, schema)
