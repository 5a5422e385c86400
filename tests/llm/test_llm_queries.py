"""Registered corpus queries over the smallest tables: against their SQL, or their rows and columns."""

import os

import pytest

from genoeval.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}, "op5_license_scans": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op6_sentencepiece": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}, "op7_media_columns": {"doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"},
    "op8_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"}, "op9_suffix_array_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"}, "op10_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op11_periodic_runs": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
    "op13_toxicity": {"doc_id", "held_out", "score", "predicted"},
}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    import duckdb

    got = QUERIES[name](spark, FOLDER)
    rows = [tuple(r[c] for c in sorted(got.columns)) for r in got.collect()]
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    if name in ORACLE_SQL:
        found = con.execute(ORACLE_SQL[name])
        names = [d[0] for d in found.description]
        expected = [tuple(v for _, v in sorted(zip(names, r, strict=True))) for r in found.fetchall()]
        assert sorted(names) == sorted(got.columns) and sorted(rows, key=repr) == sorted(expected, key=repr)
    else:
        assert COLUMNS[name] <= set(got.columns) and len(rows) == con.execute("SELECT count(*) FROM documents").fetchone()[0]
        assert got.groupBy(sorted(COLUMNS[name])[0]).count().count()
