"""Plain file outputs."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import run_together


# Quotes are doubled inside quoted fields and blanks are kept, as other programs expect.
CSV_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_report(report: DataFrame, path: str, single: bool = True) -> None:
    """A report as JSON: one file for a row or a few, else as many as there are tasks."""
    (report.coalesce(1) if single else report).write.mode("overwrite").json(path)


def export_tables(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write every table as delimited text under `folder`; returns the paths."""
    paths = {name: f"{folder}/{name}" for name in tables}
    if tables:
        spark = next(iter(tables.values())).sparkSession
        run_together(spark, {name: partial(write_csv, df, paths[name]) for name, df in tables.items()})
    return paths


def create_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Register tables for `spark.sql`."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
