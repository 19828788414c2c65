"""Addresses of the shared range 100.64.0.0/10 beyond 100.64, by the queries and by their SQL."""

import duckdb
import pytest
from test_oracles import rows

import __spark_entry__ as entry

TEXTS = ("peer 100.65.3.9 and 100.127.0.1, 100.64.1.2, 100.128.0.1 a@b.org", "10.1.2.3 8.8.8.8 100.63.9.9 100.99.1.1", "100.100.1.1 only", "none")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shared"))
    values = ", ".join(f"({i}, '{t}')" for i, t in enumerate(TEXTS))
    duckdb.execute(f"COPY (SELECT CAST(i AS BIGINT) AS doc_id, t AS text FROM (VALUES {values}) x(i, t)) TO '{path}/documents.parquet' (FORMAT parquet)")
    return path


@pytest.mark.parametrize("name", ["a2_registry_stats", "t1_registry_stream", "v1_address_leaks", "v3_public_addresses", "v4_token_collisions", "z13_sanitize_documents", "z2_registry"])
def test_query(spark, folder, name):
    df = entry.queries()[name](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    sql = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in sql.description]
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, sql.fetchall())
