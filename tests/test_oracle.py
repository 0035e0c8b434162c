"""Every query that has SQL gives the same rows in Spark and in DuckDB."""

import datetime
import decimal
import math

import duckdb
import pytest

from parcelog.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 9)
    return x.replace(tzinfo=None) if isinstance(x, datetime.datetime) else x


def rows(columns, values):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(v[i]) for i in order) for v in values), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    result = oracle.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
