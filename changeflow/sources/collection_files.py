"""Collection documents and field entries as JSON texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.outbox import LINES_PER_PART, listed_parts
from ..schemas import FIELD_ENTRY, FIELD_ENTRY_FIELDS

KEEP_NULLS = {"ignoreNullFields": "false"}


def collection_docs(nested: DataFrame) -> DataFrame:
    """Nested transactions to one ``{"master":{},"detail":[]}`` text for each part."""
    return nested.select("sTransNox", "nPartxxxx", F.to_json(F.struct("master", "detail"), KEEP_NULLS).alias("value"))


def write_collection_doc(nested: DataFrame, path: str) -> None:
    """Documents as text, one per line, in a folder for each part number; the line's master names its transaction."""
    collection_docs(nested).select("nPartxxxx", "value").write.partitionBy("nPartxxxx").text(path)


def read_collection_docs(spark: SparkSession, path: str) -> DataFrame:
    """Written documents with their part numbers."""
    return spark.read.schema("value string, nPartxxxx int").text(path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as sFileName and value."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("sFileName"), "value")


def _parsed(texts: DataFrame, member: str) -> DataFrame:
    """Texts with ``entries``, and ``_good``: an array is there and every entry number is a whole number."""
    schema = T.StructType([T.StructField("result", T.StringType()), T.StructField(member, T.ArrayType(FIELD_ENTRY))])
    parsed = texts.withColumn("_doc", F.from_json("value", schema)).withColumn("entries", F.col(f"_doc.{member}"))
    whole = F.forall("entries", lambda e: e["nEntryNox"].rlike(r"^[+-]?\d+$") & e["nEntryNox"].try_cast("int").isNotNull())
    good = F.coalesce(whole, F.lit(False))
    if member == "detail":
        good = good & (F.coalesce(F.col("_doc.result"), F.lit("")) == "success")
    return parsed.withColumn("_good", good)


def parse_field_entries(texts: DataFrame, member: str = "android") -> DataFrame:
    """Entry rows of texts (sFileName, value). One bad entry rejects its whole text, judged inside the row.

    ``member`` is 'android' for files and 'detail' for service replies.
    """
    rows = _parsed(texts, member).filter("_good").select("sFileName", F.explode("entries").alias("e"))
    return rows.select(
        "sFileName",
        *[(F.col(f"e.{n}").cast("int") if n == "nEntryNox" else F.col(f"e.{n}")).alias(n) for n in FIELD_ENTRY_FIELDS],
    )


def rejected_field_files(texts: DataFrame, member: str = "android") -> DataFrame:
    """Names of the texts that were rejected."""
    return _parsed(texts, member).filter(~F.col("_good")).select("sFileName")


def read_field_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entry rows of all good files below a path."""
    return parse_field_entries(read_texts(spark, path))


def export_field_entries(entries: DataFrame, masters: DataFrame, per_part: int = LINES_PER_PART) -> DataFrame:
    """One ``{"android":[...]}`` text for each part of a transaction that has a header and entries, parts cut by count."""
    known = entries.join(masters.select("sTransNox"), "sTransNox", "left_semi")
    ties = [n for n in FIELD_ENTRY_FIELDS if n not in ("sTransNox", "nEntryNox")]
    lists = listed_parts(known, ties, per_part)
    key = F.col("sTransNox")
    android = F.transform(
        "lines", lambda x: F.struct(*[(key if n == "sTransNox" else x[n]).cast("string").alias(n) for n in FIELD_ENTRY_FIELDS])
    )
    return lists.select("sTransNox", "nPartxxxx", F.to_json(F.struct(android.alias("android")), KEEP_NULLS).alias("value"))
