import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract


def key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob("/root/testdata/sf0.001/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return connection


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_sql(spark, data, db, name):
    df = contract.queries()[name](spark, data)
    columns = sorted(df.columns)
    got = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=key)
    cursor = db.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = sorted((tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()), key=key)
    assert got == expected


def test_flagship_has_rows(spark):
    assert contract.entry(spark).count() == 200
