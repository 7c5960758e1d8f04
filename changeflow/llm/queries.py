"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversation_repair, html_text, jaccard_join, langid, line_dedup, merkle, oracles, packing, quality, sentence_pieces, sharding, topk, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = oracles.ORACLES


def query(build: Callable[[SparkSession, str], DataFrame]):
    """Registers a function under its name."""
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    documents = table(spark, folder, "documents")
    model = langid.fit(langid.learnable(documents))
    told = langid.predict(documents.select("doc_id", "text"), model)
    return told.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the lines that many documents of their source carry."""
    return line_dedup.drop_boilerplate(table(spark, folder, "documents").select("doc_id", "source", "text"))


@query
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(documents, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op5_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    embeddings = table(spark, folder, "embeddings")
    return topk.search(embeddings, embeddings.filter("vec_id % 50 = 0"), k=5)


@query
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents on eight shards whose counts are at most one apart."""
    placed = sharding.assign(table(spark, folder, "documents"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home_shard")


@query
def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents that share 85 % of their 4-word shingles."""
    return jaccard_join.linked_components(table(spark, folder, "documents"), size=4, percent=85)


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Line-first cleaning of all documents."""
    cleaned = quality.clean_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lost_words", "n_punctuation", "n_navigation", "n_boilerplate",
    )


@query
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to archives and read back through the index."""
    return warc.archived(table(spark, folder, "pages"))


@query
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    told = bpe.encode_texts(documents, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep=["doc_id"])
    return told.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query
def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of all documents, and which of them still fit it after a third has been tampered with."""
    documents = table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(c) for c in documents.columns]
    lowered = F.translate("text", oracles.CAPITALS, oracles.CAPITALS.lower())
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = documents.select("doc_id", "lang", merkle.leaf_digest(fields).alias("original"), F.when(tampered, merkle.leaf_digest([*fields[:-1], lowered])).alias("found"))
    told = merkle.manifest(leaves, "lang", ["doc_id"], "original")
    told = told.withColumn("folded_root", merkle.verify(F.coalesce("found", "leaf"), F.col("proof")))
    return told.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_siblings(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations damaged by a rule, and the cheapest repair of each."""
    conversations = table(spark, folder, "conversations")
    repaired = conversation_repair.repair(conversation_repair.damage(conversations))
    digests = conversation_repair.text_digests(repaired.messages)
    told, every = repaired.reports, conversations.select("conv_id").distinct()
    joined = every.join(told, every.conv_id.eqNullSafe(told.conv_id), "left").join(digests, every.conv_id.eqNullSafe(digests.conv_id), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        every.conv_id,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op13_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in pieces, with begin and end, and decoded."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    told = sentence_pieces.encode_texts(documents, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"], packed=True)
    return told.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
