"""The registered queries: SQL twins where there are any, contract columns for all."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare
from wideflow.llm.queries import ORACLE, QUERIES

COLUMNS = {
    "op1_jaccard": ["doc_id", "n_shingles", "component_id"],
    "op2_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op3_source_mix": ["doc_id", "size", "source_size", "target", "taken"],
    "op4_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op5_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op6_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op7_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op8_nearest": ["query_id", "rank", "vec_id", "score"],
    "op9_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op10_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op11_word_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op12_vector_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    "op13_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck_small, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], ORACLE[name], duck_small)
    assert r["ok"], r


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, name):
    got = QUERIES[name](spark, SF_SMALL)
    assert [c for c in COLUMNS[name] if c not in got.columns] == []
    key, rows = {"op7_warc": ("page_id", "pages"), "op12_vector_codes": ("vec_id", "embeddings")}.get(name, ("doc_id", "documents"))
    if name not in ("op6_packing", "op8_nearest"):
        ids = [r[0] for r in got.select(key).collect()]
        want = [r[0] for r in spark.read.parquet(f"{SF_SMALL}/{rows}.parquet").select(key).collect()]
        assert sorted(ids) == sorted(want)
