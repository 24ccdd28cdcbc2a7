"""Every registered query against its DuckDB oracle on the smallest fixture."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "documents", "embeddings", "labels"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() and abs(v) < 2**53 else float(f"{v:.10g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if getattr(v, "hour", 0) == 0 else v.isoformat()
    return v


def _canon(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    assert _canon(got) == _canon(want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "arrival_delay_rate" in df.columns
