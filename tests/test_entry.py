"""Driver contract: entry runs, every query has an oracle or is a model, and every
query equals its DuckDB oracle at sf0.001."""

import math
import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as se

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"ml_classify", "ml_cluster"}


def own(names):
    """Without the queries of the optional training-data part, which has its own tests."""
    return {n for n in names if n != "pipeline" and not re.match(r"op\d+_", n)}


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.columns[:2] == ["ano", "l_returnflag"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    assert own(se.queries()) - set(se.oracle_sql()) == ROWS_ONLY
    assert set(se.oracle_sql()) <= set(se.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "supplier", "nation", "region", "documents"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, int) and not isinstance(v, bool):
        return round(float(v), 9)  # a column with a NULL comes back as double from one side
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


@pytest.mark.parametrize("name", sorted(own(se.oracle_sql())))
def test_query_equals_its_oracle(spark, duck, name):
    got = se.queries()[name](spark, SF).toPandas()
    want = duck.execute(se.oracle_sql()[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows_got = sorted((tuple(_norm(v) for v in r) for r in got[cols].itertuples(index=False, name=None)), key=repr)
    rows_want = sorted((tuple(_norm(v) for v in r) for r in want[cols].itertuples(index=False, name=None)), key=repr)
    assert rows_got == rows_want
