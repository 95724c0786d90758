"""Driver contract: entry() smoke run and every query against its DuckDB oracle at sf0.001."""

import hashlib
import json
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "alpha_5" in df.columns


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return repr(round(v, 6)) if isinstance(v, float) else str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted(json.dumps([_norm(r[i]) for i in order]) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    srows, scols = [tuple(r) for r in sdf.collect()], sdf.columns
    res = duck.sql(entry.oracle_sql()[name])
    drows, dcols = res.fetchall(), res.columns
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, scols) == _digest(drows, dcols)


@pytest.mark.parametrize("name", sorted(set(entry.catalog.QUERIES) - set(entry.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    assert entry.queries()[name](spark, SF).count() >= 0
