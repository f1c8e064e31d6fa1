"""The corpus pipeline: every stage on edge rows, and the contracts of the registered queries on small tables."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import helpers as H


def test_stages_on_edge_rows(spark, tmp_path):
    docs = H.documents(spark)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(24)] + [(104, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
        rows = out.collect()
        if k == 1:
            ids = [r["doc_id"] for r in rows]
            links = H.shingle_links({r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None})
            assert sorted(i for i in ids if i is not None) == sorted({c for _, c, _ in links.values()}) and ids.count(None) == 1
        if k == 2:
            assert len(rows) == docs.count()


def test_run_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    kept = corpus_pipeline.quality_filter(spark, docs, SF_SMALL).join(labels, "doc_id")
    assert kept.filter("quality = 0").count() <= 0.1 * labels.filter("quality = 0").count()
    assert kept.filter("quality = 1").count() >= 0.97 * labels.filter("quality = 1").count()
    assert out.count() > 0.6 * docs.count() and out.select("doc_id").distinct().count() == out.count()


def test_ngram_query_against_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in entry.queries()["op5_ngram_join"](spark, SF_SMALL).collect()}
    assert got == H.shingle_links(docs)


def test_url_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_SMALL}/pages.parquet'")
    cols = ["page_id", "host", "path", "rule", "strict_hits", "soft_hits", "verdict"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({entry.oracle_sql()['op3_url_filter']}) ORDER BY 1").fetchall()
    got = entry.queries()["op3_url_filter"](spark, SF_SMALL).select(*cols).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == want


@pytest.mark.parametrize("name, rows", [("op8_source_mix", 200), ("op10_kd_shards", 200), ("op7_html_text", 50), ("op9_secret_scan", None)])
def test_contract_columns(spark, name, rows):
    out = entry.queries()[name](spark, SF_SMALL)
    kinds = dict(out.dtypes)
    want = {"op8_source_mix": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
            "op10_kd_shards": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
            "op7_html_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
            "op9_secret_scan": {"doc_id": "bigint", "start": "bigint", "candidate": "string"}}[name]
    assert {c: kinds[c] for c in want} == want
    found = out.count()
    assert found == rows if rows else found > 0


def test_secrets_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    planted = docs.filter(F.col("text").rlike('(?i)token = "[0-9a-f]{40}"')).select("doc_id")
    found = entry.queries()["op9_secret_scan"](spark, SF_SMALL).filter("is_secret").select("doc_id")
    assert {r[0] for r in planted.collect()} == {r[0] for r in found.collect()}
