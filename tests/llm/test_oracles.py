"""Queries with SQL against DuckDB at sf0.001; the others' rows and columns."""

import duckdb
import pytest

from gapwise.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality": {"doc_id", "held_out", "score", "predicted"},
    "op4_fingerprints": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                         "near_next"},
    "op7_byte_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op8_token_counts": {"doc_id", "n_tokens"},
    "op9_main_text": {"page_id", "url", "text", "n_chars"},
    "op10_shards": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op11_periodic_runs": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"},
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op13_packing"}))
def test_rows_and_columns(spark, name):
    got = QUERIES[name](spark, SF)
    table = "pages" if name.startswith("op9") else "documents"
    assert COLUMNS[name] <= set(got.columns)
    assert got.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
