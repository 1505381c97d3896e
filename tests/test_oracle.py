"""Every registered query against its DuckDB oracle at sf0.001 (the driver runs sf0.01)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd
import pytest

from flowmart.plans.registry import REGISTRY

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
ORACLE = oracle_sql()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else float(f"{v:.9g}")
    if hasattr(v, "as_tuple"):
        return _norm(float(v))
    return v


def _rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"create view events as select * from read_parquet('{SF}/events.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "service_name" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    no_oracle = set(REGISTRY) - set(ORACLE)
    assert no_oracle == set()


@pytest.mark.parametrize("name", sorted(set(ORACLE) & set(REGISTRY)))
def test_query_matches_oracle(spark, con, name):
    got = queries()[name](spark, SF).toPandas()
    want = con.sql(ORACLE[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
