"""Every registered query with an oracle equals DuckDB on the same tables
(row count, column names, order-insensitive values)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if math.isinf(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[key])
    want = res.fetchall()
    want_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(want_cols)
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(want_cols, want)


def test_every_query_has_rows_or_oracle(spark):
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(sqls) >= 30


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "js_divergence" in df.columns
