"""The queries' columns and rows on the smallest tables."""

import zlib

import pytest

from dialoom.llm import queries, urlfilter

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_ngram_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op2_fingerprints": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op3_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op4_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op5_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op6_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op8_hilbert_shards": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op9_decontamination": {"doc_id": "bigint", "item_id": "bigint"},
    "op10_tool_calls": {"conv_id": "bigint", "call_id": "string", "depth": "bigint", "valid": "boolean", "canonical": "string"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    got = queries.QUERIES[name](spark, SF).cache()
    kinds = dict(got.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    if name in ("op9_decontamination", "op5_packing", "op10_tool_calls"):
        assert got.count() > 0
    else:
        table, key = ("pages", "page_id") if name.startswith("op7") else ("documents", "doc_id")
        source = spark.read.parquet(f"{SF}/{table}.parquet")
        assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in source.select(key).collect())
    if "held_out" in kinds:
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got.collect())
    got.unpersist()


def test_held_out_languages_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = queries.op4_language(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out AND lang_pred <> 'und'").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.98


def test_rule_urls_have_their_rules_verdict(spark):
    by_name = {r.name: r.verdict for r in urlfilter.RULES}
    for r in queries.op7_url_filter(spark, SF).where("rule IS NOT NULL").collect():
        assert r["verdict"] == by_name[r["rule"]]
