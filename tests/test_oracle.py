"""Every registered query against its DuckDB oracle on the smallest tables (the driver's gate, locally)."""
import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _canon(df):
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from check_oracle import canon
    return canon(df)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


SLOW = {"train_random_forest", "train_boosted_trees"}


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql())))
def test_query_matches_oracle(spark, con, name):
    got = _canon(E.queries()[name](spark, SF_SMALL).toPandas())
    want = _canon(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_every_query_has_callable_and_entry_runs(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0
