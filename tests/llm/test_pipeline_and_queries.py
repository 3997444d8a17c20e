from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from check import compare
from __spark_entry__ import oracle_sql, queries
from tidemark.llm.common import documents
from tidemark.llm.suite import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES if n != "pipeline"} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) and "pipeline" in queries()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n != "pipeline"))
def test_query_runs_over_the_whole_table(spark, con, name):
    outcome = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert not outcome.startswith("FAIL") and "TYPES" not in outcome, outcome


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before and after each stage."""
    docs = [documents(spark, SF)]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(_kept(stage(spark, docs[-1], SF)))
    return docs


def _kept(df):
    from tidemark.session import materialise

    return materialise(df, "stage")


def test_stages_keep_the_columns_and_only_drop_rows(spark, stages):
    for before, after in zip(stages[:4], stages[1:5]):
        assert after.columns == COLUMNS and after.dtypes == before.dtypes
        assert after.join(before, "doc_id", "left_anti").count() == 0
    assert stages[4].count() == stages[3].count()  # the scan replaces, it drops nothing


def test_every_kept_document_is_packed(spark, stages):
    assert stages[5].select("doc_id").distinct().count() == stages[4].count()


def test_run_equals_the_stages(spark, stages):
    rows = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert rows == sorted(map(tuple, stages[5].collect()))


def test_stages_of_an_empty_table(spark):
    docs = documents(spark, SF).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []
