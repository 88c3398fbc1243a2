"""Every query with SQL gives the same rows as the SQL, on the smallest tables."""

import math

import pytest

from leafmill import catalog

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
catalog.load()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    plain = lambda x: None if x is None or isinstance(x, float) and math.isnan(x) else repr(float(x)) if isinstance(x, float) else str(x)
    return sorted((tuple(plain(x) for x in r) for r in frame.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, sql, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), sql.sql(catalog.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_without_sql(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
