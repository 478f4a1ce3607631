"""Registered queries against their DuckDB oracle on the driver's tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tickwise.plans import catalog

from conftest import SF_SMALL

KEYS = list(catalog.queries())


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        t = []
        for i in order:
            v = r[i]
            if isinstance(v, float) and math.isnan(v):
                v = "NaN"
            t.append(v)
        out.append(tuple(t))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("part", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(rows, df.columns) == _canon(orows, ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 124          # FIXTURES.md: final rows of profile A at sf0.001
    assert "recommendation" in df.columns
    assert entry.entry(spark).schema == df.schema
