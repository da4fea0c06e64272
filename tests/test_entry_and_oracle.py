"""Every query key against its SQL statement in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tunefold.plans.queries import all_queries
from tunefold.sources.testdata import TABLES

from .conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


def _bag(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def test_keys_have_oracles():
    assert set(all_queries()) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "album_track_popularity_rnk" in df.columns


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = df.collect()
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, got) == _bag(ocols, want)


def test_coverage_map_names_every_key():
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "COVERAGE.md")
    text = open(path).read()
    missing = [k for k in all_queries() if f"`{k}`" not in text]
    assert not missing, missing
