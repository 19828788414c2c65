"""Every query with SQL against DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def shown(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(shown(r[i]) for i in order) for r in data)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    sql = duck.sql(entry.oracle_sql()[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(sql.columns, sql.fetchall())
