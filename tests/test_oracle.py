"""Every registered query against its SQL on DuckDB, whole tables, all rows."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events".split()

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "double": "DOUBLE",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def _plain(value):
    return value.isoformat() if isinstance(value, datetime.date) else value


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_an_oracle():
    assert set(spark_entry.core_queries()) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(spark_entry.core_queries()))
def test_same_rows(spark, duck, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    cursor = duck.execute(spark_entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(df.columns) == sorted(names)
    assert {c: DUCK_TYPES[t] for c, t in df.dtypes} == types
    expected = _rows(names, cursor.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert expected, "an empty oracle proves nothing"
    assert actual == expected


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
