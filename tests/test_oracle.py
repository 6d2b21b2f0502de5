"""Every query of the library against its DuckDB oracle (the driver's correctness gate), at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from donorlens.plans.catalog import QUERIES
from donorlens.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "events", "lineitem", "customer"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLE) >= set(QUERIES)
    assert all(E.oracle_sql()[k] == ORACLE[k] for k in QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    spark_rows = [tuple(r) for r in df.collect()]
    res = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows(spark_rows, df.columns) == _rows(res.fetchall(), res.columns)
