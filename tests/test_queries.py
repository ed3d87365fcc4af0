"""Every registered query against its SQL on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry_point
from pulsemill.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return repr(value)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    result = entry_point.queries()[name](spark, FOLDER)
    columns = sorted(result.columns)
    rows = sorted(tuple(shown(r[c]) for c in columns) for r in result.collect())
    assert rows
    kinds = dict(result.dtypes)
    assert not any(kinds[c].startswith(("map", "array", "struct", "timestamp")) for c in columns)

    relation = duck.sql(entry_point.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    places = [relation.columns.index(c) for c in columns]
    expected = sorted(tuple(shown(r[i]) for i in places) for r in relation.fetchall())
    assert rows == expected


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["id", "line"] and result.count() > 0
