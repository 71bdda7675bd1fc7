"""Every query with SQL gives what DuckDB gives over the same tables."""

import os

import duckdb
import pandas as pd
import pytest

from ledgerloom.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    def one(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "NULL"
        if isinstance(v, float) and v == int(v):
            return str(int(v))
        return str(v).replace(" 00:00:00", "")

    out = frame[sorted(frame.columns)].map(one)
    return out.sort_values(list(out.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = canonical(catalogue.queries()[name](spark, SF).toPandas())
    want = canonical(duck.sql(catalogue.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    pd.testing.assert_frame_equal(got, want)


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert catalogue.queries()[name](spark, SF).count() > 0
