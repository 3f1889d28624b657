"""Every catalogue query against its DuckDB oracle on the smallest tables."""

import datetime as dt

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from clickstream.plans.catalog import QUERIES
from helpers import SF_SMALL

TABLES = ["nation", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _canon(df: pd.DataFrame):
    rows = []
    for r in df[sorted(df.columns)].itertuples(index=False):
        out = []
        for v in r:
            if v is None or pd.isna(v):
                out.append(None)
            elif isinstance(v, (pd.Timestamp, dt.datetime)):
                out.append(pd.Timestamp(v).value // 1000)
            elif isinstance(v, dt.date):
                out.append(pd.Timestamp(v).value // 1000)
            elif isinstance(v, float):
                out.append(int(v) if v == int(v) else round(v, 6))
            else:
                out.append(v if not hasattr(v, "item") else v.item())
        rows.append(tuple(str(x) for x in out))
    return sorted(rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "cnt"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _canon(got) == _canon(want)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())
