"""The pipeline's stages, each on its own input, against plain versions; and a whole run."""

import collections

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from conftest import SF_SMALL
from data import WORD, rows, shingles
from test_jaccard import brute
from test_text_operators import dedup
from wideflow.llm.queries import QUERIES

import hashlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(r[0], r[1], "en", r[2], len(r[1]) if r[1] else None) for r in rows()], SCHEMA).repartition(3)


def test_order_and_columns():
    assert [f for _, f in P.STAGES] == [P.quality_rules, P.line_dedup, P.near_duplicates, P.mix_sources, P.pack_sequences]
    assert P.ORACLE_SQL is None


def test_quality_stage_keeps_what_the_query_keeps(spark, documents):
    kept = {r.doc_id for r in QUERIES["op2_quality"](spark, SF_SMALL).collect() if r.kept}
    got = P.quality_rules(spark, documents, SF_SMALL)
    assert got.columns == P.COLUMNS and {r.doc_id for r in got.collect()} == kept and 0 < len(kept) < documents.count()


def test_line_stage_drops_repeated_lines(spark, documents):
    got = P.line_dedup(spark, documents, SF_SMALL).collect()
    plain = [(r.doc_id, r.text) for r in documents.collect()]
    lines = {r.doc_id: (r.text or "").count("\n") + 1 for r in documents.collect()}
    want = {i: h for (i, _, dropped, h) in dedup(plain)}
    left = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in got}
    assert left.items() <= want.items() and len(left) == len(got)
    # Gone are the documents whose worded lines all stand in earlier ones, and no others.
    dropped = {i: n for (i, _, n, _) in dedup(plain)}
    blank = [hashlib.sha256(("\n" * k).encode()).hexdigest() for k in range(50)]
    gone = want.keys() - left.keys()
    assert gone and all(dropped[i] for i in gone) and all(want[i] in blank for i in gone)
    assert not [r for r in got if dropped[r.doc_id] and not WORD.search(r.text)]
    assert all(r.n_chars == len(r.text) for r in got if (r.text or "").count("\n") + 1 < lines[r.doc_id])


@pytest.mark.parametrize("which", ["documents", "hard"])
def test_near_duplicate_stage_keeps_one_of_each_group(spark, documents, hard, which):
    docs = documents if which == "documents" else hard
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    root = brute(plain, 5, 4, 5)
    want = collections.Counter(i for i, _ in plain if i is None or root[i] == i)
    assert collections.Counter(r.doc_id for r in P.near_duplicates(spark, docs, SF_SMALL).collect()) == want
    assert any(len(shingles(t, 5)) == 0 for _, t in plain) or which == "documents"


def test_mix_stage_repeats_rows(spark, documents):
    copies = {r.doc_id: r.taken // r["size"] for r in QUERIES["op3_source_mix"](spark, SF_SMALL).collect() if r["size"]}
    got = P.mix_sources(spark, documents, SF_SMALL)
    assert got.columns == P.COLUMNS
    n = collections.Counter(r.doc_id for r in got.collect())
    assert {i: n[i] for i in copies} == copies


def test_packing_stage_holds_every_token(spark, documents):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = collections.Counter()
    for r in P.pack_sequences(spark, documents, SF_SMALL).collect():
        total[r.doc_id] += r.length
    assert total == {r.doc_id: len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in documents.collect()}


def test_whole_run_and_hard_rows(spark, hard):
    got = P.run(spark, SF_SMALL)
    assert got.count() > 50 and got.agg({"length": "max"}).first()[0] <= 1024
    docs = hard
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.columns[0] == "doc_id" and docs.count() >= 0
    for _, stage in P.STAGES[1:]:
        assert stage(spark, hard.limit(0), SF_SMALL).count() == 0
