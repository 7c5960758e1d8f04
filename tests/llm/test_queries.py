"""The registered queries of the training-data operators, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from changeflow.llm import oracles
from checks.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"

# What the contracts ask for; further columns may follow.
COLUMNS = {
    "op1_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op2_line_dedup": {"doc_id": "bigint", "source": "string", "text": "string"},
    "op3_packing": dict.fromkeys(["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"], "bigint"),
    "op4_html": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op5_topk": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op6_sharding": {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int",
    },
    "op7_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op8_quality": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
    },
    "op9_warc": {
        "page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint",
    },
    "op10_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op11_merkle": {
        "doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean",
    },
    "op12_conversation_repair": {
        **dict.fromkeys(["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"], "bigint"), "audit": "string", "repaired_sha256": "string",
    },
    "op13_sentencepiece": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
}


@pytest.mark.parametrize("key", COLUMNS)
def test_query(spark, key):
    df = contract.queries()[key](spark, FOLDER)
    assert COLUMNS[key].items() <= dict(df.dtypes).items()
    if key in oracles.ORACLES:
        count, problem = compare(df, duck(FOLDER), contract.oracle_sql()[key])
        assert problem is None and count > 0
    else:
        table, column = ("pages", "page_id") if key == "op4_html" else ("documents", "doc_id")
        given = spark.read.parquet(f"{FOLDER}/{table}.parquet").select(column)
        assert sorted(r[0] for r in df.select(column).distinct().collect()) == sorted(r[0] for r in given.collect())


def test_one_query_for_each_operator():
    names = [k for k in contract.queries() if k.startswith("op")]
    assert sorted(names, key=lambda k: int(k[2:].split("_")[0])) == list(COLUMNS) and "pipeline" in contract.queries()
