"""Every registered query against its SQL, on whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from registry.duckdb_sql import ORACLES
from registry.spark_queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"create view {name} as from '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def canonical(rows):
    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else f"{value:.6f}"
        return repr(value)

    return sorted(tuple(cell(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", ORACLES)
def test_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    result = duck.execute(ORACLES[name])
    sql_types = {c[0]: str(c[1]) for c in result.description}
    names = [c[0] for c in result.description]
    assert columns == sorted(names)
    assert {c: TYPES[t] for c, t in got.dtypes} == sql_types
    order = [names.index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in result.fetchall()]
    assert canonical(got.select(*columns).collect()) == canonical(expected)
    assert expected


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_without_sql(spark, name):
    got = QUERIES[name](spark, FOLDER).collect()
    assert {r.topic for r in got} == {1, 2}
    assert all(0 < r.beta < 1 for r in got)


def test_entry_points(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    flagship = entry_module.entry(spark)
    assert flagship.columns == ["country", "word1", "word2", "n", "rank"]
    assert flagship.count() > 0
