"""Every registered query against its DuckDB oracle on the small data set.

Same check as the driver's: row count, column names, and an
order-insensitive digest of the values.
"""

import os

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as E
from tools.check_oracle import TABLES, _digest

QUERIES = dict(E.registry.QUERIES)
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    want_cols, want = rel.columns, rel.fetchall()
    assert sorted(got_cols) == sorted(want_cols)
    assert len(got) == len(want)
    assert _digest(got_cols, got)[0] == _digest(want_cols, want)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["primary_subgenre", "band_count", "total_concerts",
                          "avg_concerts_per_band"]
    assert df.count() > 0
