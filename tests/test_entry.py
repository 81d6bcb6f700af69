"""The driver contract: entry() runs, and every query matches its SQL twin at sf0.001."""
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from fleetlake.sources.star import TABLES

SF = "/root/testdata/sf0.001"


def norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):  # a column of integers with nulls is one of floats in pandas
        return str(int(v)) if v.is_integer() else round(v, 6)
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["host", "orgPrevalence", "organizationPrevalence", "orgFirstSeen", "orgLastSeen"]


def test_every_query_has_sql():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = rows(E.queries()[name](spark, SF).toPandas())
    exp = rows(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == exp[0]
    assert got[1] == exp[1]
