"""Every registered query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def ordered(rows):
    plain = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows]
    return sorted(plain, key=str)


#: The training-data queries have tests of their own.
OWN = [name for name in registry.queries() if not name.startswith("op") and name != "pipeline"]


def test_every_query_has_sql():
    assert set(OWN) <= registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, database, name):
    found = registry.queries()[name](spark, FOLDER)
    result = database.execute(registry.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(found.columns) == sorted(columns)
    assert ordered(map(tuple, found.select(*columns).collect())) == ordered(result.fetchall())


def test_entry(spark):
    assert registry.entry(spark).count() == 20
