"""Operators that pass the caller's columns through, with names that are hard to pass."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from changeflow.llm import bpe, html_text, line_dedup, packing, quality, sentence_pieces
from llm_helpers import prose

HARD = ["a.b", "_row", "_host", "_drop", "_each", "_keep", "_text", "_lines", "_key", "x y", "1", "ids", "html2", "ns:name", "pages", "_none"]

OPERATORS = {
    "quality": lambda df: quality.clean_lines(df),
    "html": lambda df: html_text.extract(df.withColumn("html", F.col("text")).drop("text")),
    "bpe": lambda df: bpe.encode_texts(df.drop("ids"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN),
    "pieces": lambda df: sentence_pieces.encode_texts(df.drop("ids"), public_tokenizers.path("piece_bpe_32k.model")),
    "packing": lambda df: packing.pack(df, public_tokenizers.path("byte_bpe_50k.json")),
    "line_dedup": lambda df: line_dedup.drop_boilerplate(df),
    "line_dedup_beside_copies": lambda df: line_dedup.drop_boilerplate(df, spare_copies=True),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_hard_names_come_back_with_their_values(spark, name):
    common = "menu one two\n"
    data = [(i, "s", common + prose("en", 60, i), *[f"{i} {c}" for c in HARD]) for i in range(12)]
    df = spark.createDataFrame(data, ["doc_id", "source", "text", *HARD])
    out = OPERATORS[name](df)
    kept = [c for c in HARD if c != "ids" or name in ("quality", "html", "packing", "line_dedup", "line_dedup_beside_copies")]
    for r in out.collect():
        assert [r[c] for c in kept] == [f"{r['doc_id']} {c}" for c in kept]
    if name == "line_dedup":
        assert out.filter("n_dropped = 1").count() == 12
