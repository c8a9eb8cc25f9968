"""Every query against its SQL on the smallest tables; queries without SQL give rows of a stable schema."""

import duckdb
import pytest

import __spark_entry__ as entry
from pagemill import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    frame = frame.astype(object).where(frame.notna(), None)
    return sorted(repr([round(x, 6) if isinstance(x, float) else x for x in r]) for r in frame.to_numpy().tolist())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, SF).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns)
    else:
        want = duck.execute(sql).fetchdf()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(registry.queries()) <= set(entry.queries()) and set(registry.oracle_sql()) <= set(entry.oracle_sql())
