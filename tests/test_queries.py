"""Every registered query against its SQL, over whole tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(comparable(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.columns, got.collect()) == rows_of(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)) or [None])
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert name is None or QUERIES[name](spark, sf_dir).count() > 0


def test_reloaded_models_agree(spark, sf_dir):
    assert QUERIES["model_roundtrip"](spark, sf_dir).where("NOT same").count() == 0


def test_entry(spark):
    assert driver.entry(spark).columns == ["date", "percent_pos", "percent_neg"]


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
