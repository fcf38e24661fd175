"""Every registered query against its DuckDB oracle on the smallest driver scale."""

import datetime as dt
import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.sources.testdata import TABLES

from .conftest import SF_SMALL

SQL = entry.oracle_sql()
#: The corpus operators' SQL is run by their own tests.
NAMES = sorted(n for n in SQL if not re.match(r"op\d+_", n))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows):
    return sorted("|".join(_canon(r[i]) for i in range(len(cols))) for r in rows)


def test_every_query_has_callable():
    qs = entry.queries()
    assert set(SQL) <= set(qs)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["transicao_nome", "transicao", "count"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = [tuple(r[c] for c in cols) for r in sdf.collect()]
    cur = duck.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(r[i] for i in idx) for r in cur.fetchall()]
    assert _rows(cols, srows) == _rows(cols, drows)
