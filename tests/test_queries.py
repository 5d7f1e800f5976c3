"""Every query with SQL gives the SQL's rows on the smallest tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
CHECKED = sorted(set(entry.oracle_sql()) & set(entry.queries()))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, int):
        return f"{float(value):.9g}" if abs(value) < 10**8 else str(value)
    return str(value)


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(v[i]) for i in order) for v in values)


@pytest.mark.parametrize("name", CHECKED)
def test_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER)
    want = duck.sql(entry.oracle_sql()[name])
    names = list(want.columns)
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
