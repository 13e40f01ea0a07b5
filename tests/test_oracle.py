"""Every registered query against its SQL in DuckDB, over whole tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def normal(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return repr(value)


def by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield connection
    connection.close()


def test_every_query_of_the_lake_has_sql():
    corpus, checks = contract._corpus()
    assert set(contract.queries()) - set(corpus) == set(contract.oracle_sql()) - set(checks)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


DUCK_TYPES = {
    "string": "VARCHAR",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query(spark, db, name):
    result = contract.queries()[name](spark, SF_DIR)
    expected = db.sql(contract.oracle_sql()[name])
    want_types = dict(zip(expected.columns, map(str, expected.types)))
    assert {f.name: DUCK_TYPES[f.dataType.simpleString()] for f in result.schema} == want_types
    got = by_name(result.columns, [tuple(r) for r in result.collect()])
    want = by_name(expected.columns, expected.fetchall())
    assert len(got) > 0
    assert got == want
