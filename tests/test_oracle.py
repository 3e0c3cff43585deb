"""Every registered query with an oracle, compared value by value."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

ORACLE = entry_point.oracle_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, sf, duck, name):
    df = entry_point.queries()[name](spark, sf)
    cursor = duck.execute(ORACLE[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    columns = sorted(df.columns)
    assert columns == sorted(types)
    assert {c: TYPES.get(t) for c, t in df.dtypes} == types
    place = {d[0]: i for i, d in enumerate(cursor.description)}
    expected = sorted(tuple(repr(row[place[c]]) for c in columns) for row in cursor.fetchall())
    assert sorted(tuple(repr(row[c]) for c in columns) for row in df.collect()) == expected


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
    assert os.path.exists("/root/testdata/sf0.001")
