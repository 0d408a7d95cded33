"""A cross-section of the registered queries against DuckDB on the smallest tables; check.py runs them all."""

import duckdb
import pytest

from check import TABLES, compare
from tamra.plans import QUERIES

SF = "/root/testdata/sf0.001"
PICKED = ("s2_social_jsonl s8_split_sink p6_interleave c3_boilerplate c5_language_gate c7_minhash_pairs c8_simhash_pairs c9_dedup_clusters "
          "c18_decontaminate r8_pii_hits r9_redact t1_tokenise t4_pack_by_source k2_chunk x1_embed q1_dense_topk q3_bm25_topk q8_as_of "
          "q9_to_intervals e1_e2_retrieval_scores e12_frontier v1_render v3_v4_tools w2_resume w6_stream_upsert "
          "c13_bayes_quality q2_ann_ivf q4_hybrid w4_dedup_watermark w5_monitor_late x3_upsert_vectors").split()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", PICKED)
def test_query(spark, con, name):
    status, note, _ = compare(spark, con, name, QUERIES[name].run, QUERIES[name].sql, SF)
    assert status == "ok", note
