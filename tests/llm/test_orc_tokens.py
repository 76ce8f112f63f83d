from __future__ import annotations

import glob
import subprocess
import sys
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.orc as orc
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from querylens.llm import orc_tokens
from querylens.sources.scratch import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODER = orc_tokens.TextEncoder(PATH)
WHOLE = Tokenizer.from_file(PATH)


def expected(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abzAZéÉßİΣ'.,!_ \t\ń ½1<|>中"), max_size=60), max_size=4))
def test_pieces_give_the_ids_of_whole_texts(texts):
    assert ENCODER.exact
    ids, lengths = ENCODER.encode(pa.array(texts, pa.string()))
    assert list(lengths) == [len(expected(x)) for x in texts]
    assert list(ids) == [i for x in texts for i in expected(x)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("HTWYJAhtwyja .,'\u0331\u0308\u030a\u030c\u0301\u0338<É"), max_size=20), max_size=4))
def test_combining_marks_are_composed_before_lowering(texts):
    texts = ["J\u030c", "Plain Text", *texts]
    ids, lengths = ENCODER.encode(pa.array(texts, pa.string()))
    assert list(lengths) == [len(expected(x)) for x in texts]
    assert list(ids) == [i for x in texts for i in expected(x)]


def test_special_tokens_and_long_pieces():
    texts = ["<|endoftext|>abc x<|startoftext|>", "<|ENDOFTEXT|> a.", "y" * 500 + " z", "", "don't 'S it's"]
    ids, _ = ENCODER.encode(pa.array(texts))
    assert list(ids) == [i for x in texts for i in expected(x)]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(orc_tokens, "REMEMBERED", 5)
    encoder = orc_tokens.TextEncoder(PATH)
    for k in range(6):
        texts = [f"alpha beta{k} gamma, delta{k - 1} epsilon", "alpha gamma"]
        ids, _ = encoder.encode(pa.array(texts))
        assert list(ids) == [i for x in texts for i in expected(x)]


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, whole = orc_tokens.TextEncoder(path), Tokenizer.from_file(path)
    texts = ["a  b", " it's", "", "c\nd"]
    ids, lengths = encoder.encode(pa.array(texts))
    assert not encoder.exact
    assert list(ids) == [i for x in texts for i in whole.encode(x, add_special_tokens=False).ids]
    assert len(lengths) == 4


def test_round_trip(spark):
    rows = [(i * 37 % 501, f"text number {i}, word{i % 7}! " * (i % 5), "x") for i in range(500)]
    rows += [(None, "no id", "x"), (600, None, "x"), (600, "twice", "x"), (600, "twice", "x"), (-5, "long " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens string").repartition(5)
    path = scratch_path(spark, "test-tokens")
    orc_tokens.write_tokens(docs, path, PATH)
    got = orc_tokens.read_tokens(spark, path)
    found = sorted(got.collect(), key=lambda r: r.start)
    assert len(found) == len(rows)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert keys == sorted(keys)
    at, texts = 0, {}
    for i, text, _ in rows:
        texts.setdefault(i, []).append([*expected(text), 1])
    for r in found:
        assert (r.start, r.n_tokens) == (at, len(r.tokens))
        texts[r.doc_id].remove(r.tokens)
        at += r.n_tokens
    sums = {r.start: r.ids_crc32 for r in orc_tokens.with_checksum(got).collect()}
    assert all(sums[r.start] == zlib.crc32(np.array(r.tokens, "<u4").tobytes()) for r in found)


def test_files_have_indexes_and_filters_are_pushed(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(3000)], "doc_id long, text string")
    path = scratch_path(spark, "test-tokens")
    orc_tokens.write_tokens(docs, path, PATH, rows_per_group=1000)
    (file, *_) = [f for f in glob.glob(f"{path}/tokens/*.orc") if orc.ORCFile(f).nrows]
    assert orc.ORCFile(file).row_index_stride == 1000
    one = orc_tokens.read_tokens(spark, path).where(F.col("doc_id") == 77)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,77)" in plan
    assert [r.doc_id for r in one.collect()] == [77]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = scratch_path(spark, "test-tokens")
    orc_tokens.write_tokens(docs, path, PATH)
    assert orc_tokens.read_tokens(spark, path).collect() == []


def test_pieces_become_strings_without_a_scalar_each():
    odd = pa.array(["", "a", "É中", "x\0y", "\U0001f600"]).slice(1)
    assert orc_tokens._strings(odd) == odd.to_pylist()
    assert orc_tokens._strings(pa.array([], pa.string())) == []
    many = pa.array([f"piece {i}" for i in range(200_000)])

    def least(run):
        times = []
        for _ in range(3):
            begun = time.process_time()
            run()
            times.append(time.process_time() - begun)
        return min(times)

    assert least(lambda: orc_tokens._strings(many)) < least(many.to_pylist) / 2


def test_a_new_line_parts_words_as_a_blank_does():
    encoder, seen = orc_tokens.TextEncoder(PATH), []
    encoder._all, encode_all = lambda texts: seen.extend(texts) or encode_all(texts), encoder._all
    texts = [f"word{'abc'[i % 3] * (i + 1)}.\nÉcole\n\nnext{'xyz'[i % 3]}" for i in range(30)]
    ids, _ = encoder.encode(pa.array(texts))
    assert list(ids) == [i for x in texts for i in expected(x)]
    assert not [x for x in seen if "\n" in x]


def test_batches_are_encoded_together(monkeypatch):
    monkeypatch.setattr(orc_tokens, "TEXTS", 5)
    monkeypatch.setattr(orc_tokens, "TEXT_BYTES", 20)
    texts = [["ab"], ["cd", None], [], ["x" * 19, "y", "z" * 50, "w"], ["", "a", "b", "c", "d", "e"]]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(x, pa.string())}) for x in texts]
    got = [[x for part in parts for x in part.column("text").to_pylist()] for parts in orc_tokens._together(batches, "text")]
    assert got == [["ab", "cd", None], ["x" * 19, "y"], ["z" * 50], ["w", "", "a", "b", "c"], ["d", "e"]]


_PEAK = """
import sys
import numpy as np, pyarrow as pa
from querylens.llm import orc_tokens
from querylens.llm.common import give_back

def held(kind):
    return next(int(x.split()[1]) for x in open("/proc/self/status") if x.startswith(kind)) >> 10

random = np.random.default_rng(0)
words = np.array(["".join(map(chr, 97 + random.integers(0, 26, 1 + n % 9))) for n in range(60_000)])
picked = words[(len(words) * random.random((24_000, 80)) ** 3).astype(int)]
batches = [pa.RecordBatch.from_pydict({"text": [" ".join(x) for x in picked[at : at + 2000]]}) for at in range(0, len(picked), 2000)]
encoder = orc_tokens._one_core_encoder(sys.argv[1])
del picked
give_back()
open("/proc/self/clear_refs", "w").write("5")  # the peak so far is forgotten
before = held("VmRSS")
for parts in orc_tokens._together(iter(batches), "text"):
    encoder.encode(pa.concat_arrays([x.column("text") for x in parts]))
    give_back()
print(held("VmHWM") - before, sum(x.nbytes for x in batches) >> 20)
"""


def test_a_worker_holds_little_beside_the_text():
    done = subprocess.run([sys.executable, "-c", _PEAK, PATH], capture_output=True, text=True, check=True)
    peak, text = map(int, done.stdout.split())
    assert text >= 8
    assert peak < 120


def test_many_new_pieces_are_encoded_in_several_calls(monkeypatch):
    monkeypatch.setattr(orc_tokens, "CALL", 3)
    monkeypatch.setattr(orc_tokens, "PLACED", 4)
    encoder = orc_tokens.TextEncoder(PATH)
    texts = [f"a{k}b word{'xyz'[k % 3] * k}, É{k} <{k}>" * (k % 4) for k in range(20)]
    ids, lengths = encoder.encode(pa.array(texts))
    assert encoder.exact
    assert list(ids) == [i for x in texts for i in expected(x)]
    assert list(lengths) == [len(expected(x)) for x in texts]
