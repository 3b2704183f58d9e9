from collections import Counter

import duckdb
import pytest
from conftest import plan_of
from llm.llm_brute import near_brute

import corpus_pipeline
from compare import connect, differences
from footfall.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_matches_sql(spark, name):
    assert differences(spark, connect(SF_DIR), name, SF_DIR) == []


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_near_query(spark):
    rows = [r[:2] for r in duckdb.connect().execute(
        f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' WHERE doc_id IS NOT NULL"
    ).fetchall()]
    wanted = near_brute(rows, 2, 80)
    found = queries.QUERIES["op3_minhash_near_dedup"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


@pytest.mark.parametrize("name", ["op4_trie_token_counts", "op5_hash_tree_sharding", "op6_personal_data", "op8_byte_bpe", "op10_language_id"])
def test_a_row_per_document(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = queries.QUERIES[name](spark, SF_DIR)
    assert Counter(found.select("doc_id").collect()) == Counter(docs.select("doc_id").collect())


def test_language_query_is_right_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    found = queries.QUERIES["op10_language_id"](spark, SF_DIR).filter("held_out")
    both = found.join(docs, "doc_id")
    assert both.filter("lang = lang_pred").count() >= 0.95 * both.count()


def test_license_plan_is_native(spark):
    plan = plan_of(queries.QUERIES["op9_license_scan"](spark, SF_DIR))
    for slow in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"):
        assert slow not in plan


def test_pipeline_stages(spark, docs, empty, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "exact dedup", "MinHash near-dedup", "mixing", "byte-level BPE"]
    for frame, start in ((docs, "docs"), (empty, "empty")):
        now = frame
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, now, SF_DIR)
            if i < 4:
                assert out.columns == frame.columns, name
            path = str(tmp_path / f"{start}{i}")
            out.write.parquet(path)
            now = spark.read.parquet(path)
    assert now.count() == 0


def test_pipeline(spark):
    texts = {}
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        texts.setdefault(" ".join((r.text or "").split()), r.doc_id)
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    uses = Counter(r.doc_id for r in rows)
    assert max(uses.values()) <= 2
    # one document of each group of equal texts; near copies are what is missing
    assert set(uses) <= set(texts.values()) and len(uses) >= 0.9 * len(texts)
