"""Every query against its SQL counterpart on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    answer = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(columns)
    got = ordered(tuple(r[c] for c in columns) for r in df.collect())
    assert got == ordered(answer.fetchall())
    assert got


def test_entry(spark):
    assert entry.entry(spark).count() == 200
