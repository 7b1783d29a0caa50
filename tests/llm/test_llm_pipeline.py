import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gradeloom.llm.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert {n.split("_")[0] for n in ORACLES} == {"op1", "op3", "op8", "op11", "op12", "op13"}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    key = 'token = "4f9d8c7b6a5e4d3c2b1a0f9e8d7c6b5a4f3e2d1c"'
    text = " ".join(f"plain{i}" for i in range(50))
    extra = [(10_001, f"{text} {key}", "en", "src1", 0), (10_002, f"{text} {key} end", "en", "src1", 0), (10_003, None, None, None, None)]
    docs.unionByName(spark.createDataFrame(extra, docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    before = now
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        before, now = now, spark.read.parquet(f"{tmp_path}/{name}")
        if name != "token_ids":
            assert now.columns == docs.columns
        if name == "near_duplicates":
            assert now.filter("doc_id = 10002").count() == 0
        if name == "secret_scan":
            assert now.count() == before.count() and now.filter(F.col("text").contains("4f9d8c7b")).count() == 0
            assert now.filter("n_chars <> length(text)").count() == 0
    assert now.count() == before.count() and now.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_pieces"]


@pytest.mark.parametrize("name", ["op2_plane_files", "op5_quality_mil", "op6_byte_bpe", "op7_hypergeometric", "op9_mixing", "op10_token_counts"])
def test_queries_have_a_row_per_document(spark, name):
    ids = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(r.doc_id for r in QUERIES[name](spark, SF).collect()) == sorted(ids)


def test_secret_query_points_into_the_texts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op4_secret_forest"](spark, SF).collect()
    assert rows and all(hashlib.sha256(texts[r.doc_id][r.start : r.start + r.length].encode()).hexdigest() == r.candidate_sha256 for r in rows)


@pytest.mark.parametrize("name", ["op11_spelling", "op12_filter_audit", "op13_chat_masks"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    rows = QUERIES[name](spark, SF).select(*sorted(QUERIES[name](spark, SF).columns)).collect()
    found = con.execute(ORACLES[name])
    order = sorted(range(len(found.description)), key=lambda i: found.description[i][0])
    assert sorted(repr(tuple(r)) for r in rows) == sorted(repr(tuple(r[i] for i in order)) for r in found.fetchall())
