"""Driver contract and a DuckDB oracle comparison on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from ledgerline.sources.tables import TABLES

# A spread of query families; the full set runs in tools/oracle_check.py.
ORACLE_SAMPLE = [
    "sales_report", "dq_metrics", "dq_flags", "clean_sales", "fact_sales", "constraint_checks",
    "describe_numeric", "rating_histogram", "pivot_avg_rating", "upsert_fact", "csv_roundtrip",
]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.date) and not isinstance(v, dt.datetime):
        return dt.datetime(v.year, v.month, v.day)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=str)


def test_registry_is_consistent():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 34


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["branch_code", "city", "product_line"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ORACLE_SAMPLE)
def test_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(s_cols) == sorted(d_cols)
    assert _rows(s_cols, s_rows) == _rows(d_cols, res.fetchall())
