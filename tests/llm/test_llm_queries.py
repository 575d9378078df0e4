"""The registered queries over a driver table: against their SQL where there is one, else what their contract promises."""

from collections import Counter

import pytest
from check_engine import compare, connect
from conftest import SF_DIR

from subrev.llm import queries
from subrev.llm.sql import ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, con, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), con, ORACLE_SQL[name]) is None


COLUMNS = {
    "op1_mix_sources": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op2_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op3_shard": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op5_html_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op6_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op8_token_counts": {"doc_id": "bigint", "section": "bigint", "n_tokens": "bigint"},
    "op9_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_whole_tables(spark, con, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    kinds = dict(df.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    table, key = ("pages", "page_id") if name == "op5_html_text" else ("documents", "doc_id")
    ids = Counter(x for (x,) in con.execute(f"SELECT {key} FROM {table}").fetchall())
    got = Counter(r[key] for r in df.select(key).collect())
    assert set(got) == set(ids) if name == "op8_token_counts" else got == ids
