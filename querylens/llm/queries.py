"""The operators on the given tables: one query each, (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from querylens.llm import (
    dartminhash,
    decontaminate,
    fill_in_middle,
    fingerprint,
    langid,
    mixing,
    orc_tokens,
    pii,
    preference,
    toxicity,
    url_filter,
    whitening,
    wrappers,
)
from querylens.llm.common import fold, read_table
from querylens.sources.scratch import scratch_path

TOKENIZER = "word_bpe_49k.json"


def token_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write ``docs`` to token files, read them back, and describe each document."""
    path = scratch_path(spark, "tokens")
    orc_tokens.write_tokens(docs, path, public_tokenizers.path(TOKENIZER))
    return orc_tokens.with_checksum(orc_tokens.read_tokens(spark, path))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    model = langid.fit(docs.where(~held_out).select("text", "lang"))
    found = langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op2_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(spark, read_table(spark, sf_dir, "documents"))


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.replace_entities(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_entities = F.coalesce(F.size("entities"), F.lit(0)).cast("long").alias("n_entities")
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("entities", lambda e: e["kind"]))), ",")
    return rows.select("doc_id", "text", n_entities, kinds.alias("kinds"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    model = toxicity.character_model(docs)
    weights = toxicity.fit(docs, labels.where(~held_out), model)
    scored = toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model, weights)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    pairs = preference.preference_pairs(turns, preference.with_shortened_reply(turns))

    def as_text(mask: str):
        return F.array_join(F.transform(mask, lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias(mask)

    return pairs.select("pair_id", "n_common", "prompt", "chosen", "rejected", as_text("chosen_mask"), as_text("rejected_mask"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages")).drop("url")


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprint.with_next(read_table(spark, sf_dir, "documents"))
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), size - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    rows = rows.withColumn("edited_sketch", fingerprint.sketch(F.col("edited")))

    return rows.select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprint.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprint.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprint.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        fingerprint.containment(F.col("sketch"), F.col("edited_sketch")).alias("contained_in_edited"),
        fingerprint.containment(F.col("sketch"), F.col("next_sketch")).alias("contained_in_next"),
    )


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(read_table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return plan.select("doc_id", "size", "source_size", "target", taken)


def op10_dartminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(read_table(spark, sf_dir, "documents"))
    again = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(again, 256).alias("restored_sha256"),
    )


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = wrappers.main_texts(read_table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_orc_tokens": op2_orc_tokens,
    "op3_surrogates": op3_surrogates,
    "op4_decontaminate": op4_decontaminate,
    "op5_toxicity": op5_toxicity,
    "op6_preference": op6_preference,
    "op7_url_filter": op7_url_filter,
    "op8_fingerprint": op8_fingerprint,
    "op9_mix_sources": op9_mix_sources,
    "op10_dartminhash": op10_dartminhash,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_main_text": op12_main_text,
    "op13_whitening": op13_whitening,
}
