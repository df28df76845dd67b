"""Every registered query against its DuckDB oracle on the smallest scale."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from cadenza.sources.tables import TABLES

from .conftest import SMALL

QUERIES = E.queries()
ORACLES = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["year", "p_type", "value"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    sql = ORACLES.get(name)
    if not sql:
        assert rows and len(set(cols)) == len(cols)          # values are tested in test_numeric.py and tests/llm
        return
    cur = duck.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _digest(cols, rows) == _digest(dcols, drows)
