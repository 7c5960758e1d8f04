"""Stages of the corpus pipeline: quality rules, language ID, line dedup, near copies, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder, settle
from . import jaccard_join, langid, line_dedup, packing, quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Least probability of the language that a document is taken for.
LEAST_SCORE = 0.5


def as_documents(rows: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail their rules are removed; documents that lose too much or fail the base rules go."""
    return as_documents(quality.clean_lines(docs).filter("kept"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not told with a probability of a half go. Labels stay as they are."""
    told = langid.predict(docs, langid.fit(langid.learnable(docs)))
    return as_documents(told.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents of a source carry are removed. Every document stays, and copies keep what only they share:
    the next stage chooses among them."""
    return as_documents(line_dedup.drop_boilerplate(docs, spare_copies=True))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays.

    Documents are told apart by id and text: where an id repeats with different texts, each text is linked by itself, and of
    texts of one id that are linked, the one with the smaller hash stays. Rows alike in both are one. Rows without an id stay.
    """
    rows = docs.filter("doc_id IS NOT NULL").withColumn("_key", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    linked = jaccard_join.linked_components(rows, "_key", size=5, percent=80).select("_key", "component_id").distinct()
    named = linked.join(rows.select("_key", "doc_id").distinct(), "_key")
    firsts = settle(named.groupBy("component_id").agg(F.min(F.struct("doc_id", "_key")).alias("first")).select("first._key"))
    one_each = rows.join(firsts, "_key", "left_semi").dropDuplicates(["_key"])
    return as_documents(one_each.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_stage),
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("packing", packing_stage),
]

#: Language identification and near copies cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
