"""Every registered query against its SQL on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}
TABLES = "orders documents embeddings pages labels".split()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM read_parquet('{SF_DIR}/{table}.parquet')")
    return con


def assert_no_pair_joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF_DIR)
    assert_no_pair_joins(df)
    got = rows_of(df.columns, df.collect())
    answer = duck.execute(SQL[name])
    columns = [c[0] for c in answer.description]
    want = rows_of(columns, answer.fetchall())
    assert sorted(df.columns) == sorted(columns)
    types = {c[0]: str(c[1]) for c in answer.description}
    assert {n: TYPES[t] for n, t in df.dtypes} == types
    assert len(got) == len(want)
    assert [(g, w) for g, w in zip(got, want) if g != w][:3] == []


@pytest.mark.parametrize("name", sorted(registry.queries().keys() - SQL.keys()))
def test_runs_without_sql(spark, name):
    df = registry.queries()[name](spark, SF_DIR)
    assert_no_pair_joins(df)
    assert df.count() > 0
