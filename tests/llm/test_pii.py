from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from querylens.llm import pii

TEXTS = [
    "Mr. John Smith and Mr. Smith met Maria Lopez; mail John.Smith@Mail3.Example.com or john.smith@mail3.example.com, jane@mail3.example.com",
    "call +1 (017) 555-7713 or 017-555-7713 from 10.0.0.255, card 4111 1111 1111 1111 / 4111111111111111 / 4952935900253052",
    'token = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!! ssn 123-45-6789 iban DE89 3704 0044 0532 0130 00 and DE89370400440532013000',
    "г-жа Анна Иванова и Иван Петров",
    "",
    None,
    "no data 3.14 here 12:30 v2.0, 1234 and 12345678",
    "a@b.co",
]


def replaced(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, entities string")
    return sorted(pii.replace_entities(docs, **options).collect(), key=lambda r: r.doc_id)


@pytest.fixture(scope="module")
def rows(spark):
    return replaced(spark, TEXTS)


def luhn(number: str) -> bool:
    digits = [int(c) for c in number][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def test_only_entities_change(rows):
    for row, text in zip(rows, TEXTS, strict=True):
        if text is None:
            assert row.text is None and row.entities is None
            continue
        at, built = 0, ""
        for e in row.entities:
            place = text.index(e.entity, at)
            built += text[at:place] + e.surrogate
            at = place + len(e.entity)
            assert e.surrogate != e.entity and e.entity not in row.text
        assert built + text[at:] == row.text
    assert [len(r.entities or []) for r in rows] == [6, 6, 4, 2, 0, 0, 0, 1]


def test_kind_and_format_are_kept(rows):
    shape = lambda s: re.sub(r"[a-zа-я]", "a", re.sub(r"[A-ZА-Я]", "A", re.sub(r"[0-9]", "0", s)))
    for row in rows:
        for e in row.entities or []:
            assert re.fullmatch(pii.PATTERNS[e.kind].replace(r"\p{Lu}", "[A-ZА-Я]").replace(r"\p{Ll}", "[a-zа-я]").replace(r"\p{L}", "[A-Za-zА-Яа-я]"), e.surrogate)
            if e.kind == "ip":
                assert all(0 <= int(x) <= 255 for x in e.surrogate.split("."))
            elif e.kind == "secret":
                assert re.fullmatch("[0-9A-F]{40}", e.surrogate)
            elif e.kind != "name":
                assert shape(e.entity) == shape(e.surrogate)
            if e.kind == "card":
                numbers = [re.sub("[^0-9]", "", x) for x in (e.entity, e.surrogate)]
                assert luhn(numbers[0]) == luhn(numbers[1])


def test_names_keep_gender_and_script(rows):
    given = {n: k for k, names in pii.GIVEN_NAMES.items() for n in names}
    entities = {e.entity: e.surrogate for r in rows for e in r.entities or []}
    assert entities["Mr. John Smith"].startswith("Mr. ")
    for original, name, at in (("Mr. John Smith", "John", 1), ("Maria Lopez", "Maria", 0), ("г-жа Анна Иванова", "Анна", 1), ("Иван Петров", "Иван", 0)):
        new = entities[original].split(" ")[at]
        assert given[new] == given[name] and new != name
    assert entities["г-жа Анна Иванова"].endswith("ова") and entities["Иван Петров"].endswith("ов")
    assert entities["Mr. John Smith"].split(" ")[-1] == entities["Mr. Smith"].split(" ")[-1]


def test_coreference(rows):
    e = [x for r in rows for x in r.entities or []]
    by_canonical = {}
    for x in e:
        by_canonical.setdefault((x.kind, x.canonical), set()).add(re.sub("[^0-9a-z@.]", "", x.surrogate.lower())[-10:])
    assert all(len(v) == 1 for v in by_canonical.values())
    mails = [x.surrogate for x in e if x.kind == "email"][:3]
    assert mails[0].lower() == mails[1] and mails[2].split("@")[1] == mails[1].split("@")[1]


def test_images_are_one_to_one(spark):
    numbers = spark.range(20_000).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("t"))
    images = numbers.select(pii.permuted(F.col("t"), "k").alias("i"))
    assert images.distinct().count() == 20_000
    octets = spark.range(65_536).select(F.concat(F.lit("1.2."), F.floor(F.col("id") / 256).cast("string"), F.lit("."), (F.col("id") % 256).cast("string")).alias("t"))
    assert octets.select(pii._ip(F.col("t"), "k").alias("i")).distinct().count() == 65_536


def test_keys_differ_and_runs_agree(spark, rows):
    again = replaced(spark, TEXTS)
    assert [r.text for r in again] == [r.text for r in rows]
    other = replaced(spark, TEXTS, key="another")
    assert all(a.text != b.text for a, b in zip(other, rows, strict=True) if a.entities)


def test_collisions_are_found(spark):
    entity = "kind string, entity string, canonical string, surrogate string"
    schema = f"entities array<struct<{entity.replace(' string', ':string')}>>"
    clash = [([("ip", "1.1.1.1", "1.1.1.1", "9.9.9.9")],), ([("ip", "2.2.2.2", "2.2.2.2", "9.9.9.9")],)]
    same = [([("ip", "1.1.1.1", "1.1.1.1", "1.1.1.1")],)]
    fine = [([("ip", "1.1.1.1", "1.1.1.1", "9.9.9.9")],)] * 2
    counts = [pii.collisions(spark.createDataFrame(x, schema)).count() for x in (clash, same, fine)]
    assert counts == [1, 1, 0]


def test_no_name_keeps_its_own_and_none_fails_the_table(spark):
    short = [f"Mr. {a}{b}" for a in "BCDFGHJKLMNPQRSTVWXYZ" for b in "aeiou"]
    texts = [*short, "Mr. Đỗ", "Dr. Աբգար", "Mr. Йова", *(f"Mr. {n}" for n in pii.GIVEN_NAMES["latin", "male"])]
    rows = replaced(spark, texts)
    entities = [r.entities[0] for r in rows]
    assert [e.entity for e in entities] == texts and all(e.surrogate != e.entity for e in entities)
    assert len({e.surrogate for e in entities}) == len(texts)
    assert {e.surrogate for e in entities[: len(short)]} <= {*short}
    assert re.fullmatch("Dr. [Ա-Ֆ][ա-ֆ]{4}", entities[len(short) + 1].surrogate)
    assert re.fullmatch("Mr. [^\\W\\d_A-Za-z]{2}", entities[len(short)].surrogate)


def test_only_entities_that_meet_are_drawn_again(spark, monkeypatch):
    first = pii.surrogate

    def meeting(entity, kind, key=pii.KEY):
        again = F.when(entity.isin("10.0.0.1", "10.0.0.2"), "9.9.9.9").when(entity == "10.0.0.3", entity)
        return first(entity, kind, key) if "#0#" in key else F.coalesce(again, first(entity, kind, key))

    texts = ["10.0.0.1 and 10.0.0.2", "10.0.0.3", "10.0.0.4 a@b.co 10.0.0.2", "none", None]
    before = replaced(spark, texts)
    monkeypatch.setattr(pii, "surrogate", meeting)
    rows = replaced(spark, texts)
    new = {e.entity: e.surrogate for r in rows for e in r.entities or []}
    old = {e.entity: e.surrogate for r in before for e in r.entities or []}
    assert new["10.0.0.1"] == "9.9.9.9" and all(new[x] == old[x] for x in ("10.0.0.4", "a@b.co"))
    assert len(set(new.values())) == len(new) and all(k != v for k, v in new.items())
    assert rows[2].text == " ".join(new[x] for x in texts[2].split(" ")) and rows[3].text == "none" and rows[4].entities is None


def test_long_texts_and_empty_tables(spark):
    text = "word " * 100_000 + "x@example.com " + "tail " * 1000
    (row,) = replaced(spark, [text])
    assert len(row.entities) == 1 and row.text.startswith("word word") and "x@example.com" not in row.text
    assert replaced(spark, []) == []
