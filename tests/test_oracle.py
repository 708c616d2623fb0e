"""Every registered query against its DuckDB oracle, at the smallest scale."""

import os

import duckdb
import pytest

from tools.oracle_check import TABLES, rows_key, type_mismatches

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _names():
    from __spark_entry__ import queries
    return list(queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    duck_rows = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert type_mismatches(df.schema, con, sql) == []
    assert rows_key(rows, df.columns) == rows_key(duck_rows, cols)


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    out = entry(spark)
    assert out.columns == ["sentiment", "label_rank", "n"]
    assert [r["sentiment"] for r in out.collect()] == ["Positive", "Negative", "Neutral"]
