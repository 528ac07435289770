"""Registered queries at the smallest scale: columns, rows, and SQL answers where there are any."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from snapfold.llm.queries import ANSWERS, QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(entry.SMOKE_DIR), reason="driver tables are not here")

COLUMNS = {
    "op1": "doc_id start n_tokens ids_crc32",
    "op2": "doc_id fingerprint component_id",
    "op3": "doc_id n_words n_removed kept_sha256",
    "op4": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op5": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op6": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op7": "doc_id n_bytes n_removed n_spans kept_sha256 kept_text",
    "op8": "doc_id piece start length ids_crc32 sequence_id offset",
    "op9": "page_id url text n_chars",
    "op10": "vec_id n_links component_id kept",
    "op11": "vec_id component n deviation whitened explained identity_error",
    "op12": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "op13": "doc_id size text_crc32 law shard slot grown_shard",
}


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == set(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ANSWERS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    found = QUERIES[name](spark, entry.SMOKE_DIR)
    assert found.columns == COLUMNS[name.split("_")[0]].split()
    rows = [tuple(r) for r in found.collect()]
    table = {"page_id": "pages", "vec_id": "embeddings"}.get(found.columns[0], "documents")
    ids = {r[0] for r in spark.read.parquet(f"{entry.SMOKE_DIR}/{table}.parquet").select(found.columns[0]).collect()}
    assert {r[0] for r in rows} == ids and (len(rows) == len(ids) or name.startswith(("op8", "op11")))
    if name in ANSWERS:
        duck = duckdb.connect()
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{entry.SMOKE_DIR}/{table}.parquet'")
        answer = duck.execute(ANSWERS[name])
        assert [d[0] for d in answer.description] == found.columns
        assert sorted(answer.fetchall()) == sorted(rows)
