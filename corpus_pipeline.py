"""From raw documents to token files: five stages, each on all that the one before it kept.

Every stage is a function (spark, docs, sf_dir) -> DataFrame. Its result is
written as Parquet and read again as the next one's input, so a lost executor
costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from querylens.llm import dartminhash, decontaminate, langid, mixing
from querylens.llm.common import read_table
from querylens.llm.queries import token_rows
from querylens.sources.scratch import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; those without a letter and those no language fits go.

    So NULL and empty texts go. Equal texts stay or go together, each row for
    itself. If no row has a language to learn from, all with a letter stay. An
    empty table stays empty.
    """
    return langid.identified(docs, langid.fit(docs.select("text", "lang")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Documents without an id or without words stay. Rows with the same id and
    text are one document; the one whose other columns come first when written
    as JSON stays, whatever their types. Rows with the same id and different
    texts stay or go together, and stay if one of them stands for its group.
    An empty table stays empty.
    """
    classes = dartminhash.near_duplicates(docs).where("doc_id is not null")
    ids = classes.groupBy("doc_id").agg(F.bool_and(F.col("doc_id") != F.col("class_id")).alias("copy"), F.count(F.lit(1)).alias("n"))
    ids = materialize(ids.where("copy or n > 1"), "near-copies")
    kept = docs.join(ids.where("copy").select("doc_id"), "doc_id", "left_anti")
    repeated = ids.where("not copy").select("doc_id")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    several = kept.join(repeated, "doc_id", "left_semi")
    if rest:
        others = F.struct(*rest)
        several = several.groupBy("doc_id", "text").agg(F.min_by(others, F.to_json(others)).alias("others"))
    else:
        several = several.distinct()
    several = several.select(*[F.col(c) if c in ("doc_id", "text") else F.col("others").getField(c).alias(c) for c in docs.columns])
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(several)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark occurs.

    NULL and empty texts hold none and stay, rows with the same id each for
    itself. With an empty benchmark all stay.
    """
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as their source's target takes them.

    Documents without a word, NULL texts included, count nothing. A NULL
    source is a source like the others. Rows with equal ids and texts are
    taken as often as each other. An empty table stays empty.
    """
    return mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the token files, as read back from them, a row for each time the mix takes one.

    A NULL or empty text is its end token alone. NULL ids come first. An empty
    table makes no rows.
    """
    return token_rows(spark, docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing_sources", mixing_sources),
    ("token_files", token_files),
]

# Support vector machines, hashed signatures and a tokenizer's merges can't be written in SQL; tests/llm compare each
# stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
