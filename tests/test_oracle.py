"""Every registered query with an oracle SQL agrees with DuckDB at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from promptwatt.session import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF).toPandas()
    d = con.execute(E.oracle_sql()[name]).df()
    assert _rows(s) == _rows(d)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_joules" in df.columns
