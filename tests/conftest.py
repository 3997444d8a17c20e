import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false",
        spark_driver_memory="6g", spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    def collect(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return collect


@pytest.fixture(scope="session")
def plan():
    """The physical plan of a DataFrame as text."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()


CATALOG = ("id long, gender string, masterCategory string, subCategory string, articleType string, "
           "baseColour string, season string, year int, usage string, productDisplayName string")


def catalog_row(id, name="Blue Shirt", year=2012, category="Apparel", colour="Blue", season="Fall", usage="Casual",
                article="Shirts", gender="Men", sub="Topwear"):
    return (id, gender, category, sub, article, colour, season, year, usage, name)
