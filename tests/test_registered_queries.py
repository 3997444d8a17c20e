from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from check import compare
from tidemark.suite import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.oracle


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    outcome = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert outcome.startswith("ok") and "TYPES" not in outcome, outcome


def test_entry_runs(spark):
    assert entry(spark).count() > 0
