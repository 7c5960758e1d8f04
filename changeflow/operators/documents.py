"""Scanned documents: what to send, its payload, and the replies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import plain_base64
from ..schemas import DOCUMENT_REPLY

# Fixed value: document type of a client image.
CLIENT_IMAGE = "0002"


def pending_documents(images: DataFrame, scanner: str | None = None, ordered: bool = True) -> DataFrame:
    """Images not sent yet, oldest first; of one scanning branch, or of all.

    Leave the order out before the bytes are joined, or they are sorted with the rows.
    """
    rows = images.filter(F.col("cImgeStat") == "0")
    if scanner is not None:
        rows = rows.filter(F.col("sScanndID") == scanner)
    return rows.orderBy("dImgeDate", "sClientID", "sImageNme") if ordered else rows


def document_payload(pending: DataFrame) -> DataFrame:
    """Upload fields of each image with its bytes (column ``content``); the hash is computed only if blank."""
    given = F.when(F.coalesce("sMD5Hashx", F.lit("")) != "", F.col("sMD5Hashx"))
    empty = F.lit("")
    return pending.select(
        F.lit(CLIENT_IMAGE).alias("g-edoc-type"), F.col("sClientID").alias("g-edoc-ownr"),
        empty.alias("g-edoc-srcd"), empty.alias("g-edoc-srno"), F.col("sImageNme").alias("g-edoc-file"),
        F.col("sScanndID").alias("g-edoc-scnr"), plain_base64(F.col("content")).alias("g-edoc-imge"),
        F.coalesce(given, F.md5("content")).alias("g-edoc-hash"),
    )


def parse_replies(replies: DataFrame) -> DataFrame:
    """Reply texts (column ``value``) to result, file name, bytes and error message."""
    parsed = replies.select(F.from_json("value", DOCUMENT_REPLY).alias("r"))
    success = F.lower(F.col("r.result")) == "success"
    return parsed.select(
        F.coalesce(success, F.lit(False)).alias("bSuccessx"),
        F.when(success, F.col("r.payload.filename")).alias("sImageNme"),
        F.when(success, F.unbase64(F.col("r.payload.data"))).alias("content"),
        F.when(~F.coalesce(success, F.lit(False)), F.col("r.error.message")).alias("sMessagex"),
    )


def decode_payload(replies: DataFrame) -> DataFrame:
    """File name and bytes of the successful replies."""
    return parse_replies(replies).filter("bSuccessx").select("sImageNme", "content")


def failed_replies(replies: DataFrame) -> DataFrame:
    """Messages of the other replies."""
    return parse_replies(replies).filter("not bSuccessx").select("sMessagex")


def mark_documents_sent(images: DataFrame, sent: DataFrame) -> DataFrame:
    """New image table: images accepted by the receiver (sClientID, sImageNme) get cImgeStat '1'."""
    keys = ["sClientID", "sImageNme"]
    done = sent.select(*keys, F.lit(True).alias("_done")).distinct()
    return (
        images.join(done, keys, "left")
        .withColumn("cImgeStat", F.when(F.col("_done"), "1").otherwise(F.col("cImgeStat")))
        .select(*images.columns)
    )
