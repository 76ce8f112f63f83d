from __future__ import annotations

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from querylens.llm import fingerprint, queries


def hashes(text, size=5):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) if w]
    out = set()
    for i in range(max(1, len(words) - size + 1) if words else 0):
        seed = 42
        for word in words[i : i + size]:
            seed = xxhash.xxh64(word.encode(), seed=seed).intdigest()
        out.add(seed - (1 << 64) if seed >= 1 << 63 else seed)
    return out


def kept(text, fraction=fingerprint.FRACTION):
    return {h for h in hashes(text) if h < int(fraction * (1 << 64)) - (1 << 63)}


def share(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_force(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        a, b, c = kept(text), kept(new), kept(following)
        as_text = ["".join(f"{h % (1 << 64):016X}" for h in sorted(s)) for s in (a, b)]
        near = [share(a, s) for s in (b, c)]
        yield (i, len(text), hashlib.sha256(new.encode()).hexdigest(), *as_text, *near)


def run(spark, tmp_path, rows):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, sketch string, bucket string")
    docs.repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r)[:7] for r in queries.QUERIES["op8_fingerprint"](spark, str(tmp_path)).collect()]


def test_query_equals_brute_force(spark, tmp_path):
    text = "The quick, brown föx jumps over 😀 the lazy dog and runs away again and again. "
    rows = [(i * 31 % 997, (text * (i % 6))[i % 5 : -(i % 7) or None]) for i in range(300)]
    rows += [(5000, None), (None, "no id"), (-1, ""), (4000, text * 3000), (4001, text)]
    assert sorted(run(spark, tmp_path, rows), key=str) == sorted(brute_force(rows), key=str)


@pytest.mark.parametrize("rows", [[], [(1, "only one document here, of nine words")], [(1, None), (2, None)]])
def test_few_rows(spark, tmp_path, rows):
    assert sorted(run(spark, tmp_path, rows)) == sorted(brute_force(rows))


def test_repeated_ids_follow_each_other(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(20)] + [(2, "b"), (0, "a")], "doc_id long, text string")
    rows = fingerprint.with_next(docs).collect()
    following = {r.text: r.next_text for r in rows}
    at, seen = "b", []
    for _ in range(len(rows)):
        seen.append(at)
        at = following[at]
    assert at == "b" and len(set(seen)) == 22 and seen[-1] == "a"


def test_sketches_merge_and_estimate_containment(spark):
    words = [f"w{i}" for i in range(4000)]
    whole, part, other = " ".join(words), " ".join(words[1000:1400]), " ".join(f"v{i}" for i in range(400))
    df = spark.createDataFrame([(whole, part, other)], "a string, b string, c string")
    a, b, c = (fingerprint.sketch(F.col(x)) for x in "abc")
    row = df.select(
        fingerprint.containment(b, a).alias("b_in_a"),
        fingerprint.containment(a, b).alias("a_in_b"),
        fingerprint.containment(c, fingerprint.merged(a, c)).alias("c_in_both"),
        fingerprint.containment(c, a).alias("c_in_a"),
        fingerprint.merged(a, c).alias("both"),
    ).first()
    assert row.b_in_a == 1.0 and row.c_in_both == 1.0 and row.c_in_a == 0.0
    assert row.a_in_b == pytest.approx(0.1, abs=0.03)
    assert set(row.both) == kept(whole) | kept(other)
