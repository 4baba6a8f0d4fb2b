"""Registered queries against their SQL, on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from tickforge.plans.catalogue import QUERIES
from tickforge.plans.oracle import ORACLE

TABLES = "region nation customer events documents".split()
ROWS_ONLY = {"gbt_metrics", "gbt_predictions", "gbt_importance"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_but_the_models_has_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


#: Whole chains, which check.py compares; test_medallion and test_refresh run their parts.
CHAINS = {"medallion_daily", "medallion_features", "refreshed_sentiment", "refreshed_features", "refreshed_days"}


@pytest.mark.parametrize("name", sorted(set(ORACLE) - CHAINS))
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = df.collect()
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = [tuple(row[names.index(c)] for c in df.columns) for row in cursor.fetchall()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
