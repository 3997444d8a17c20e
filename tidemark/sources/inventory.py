"""What sources and tables hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def source_inventory(sources: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """(name, type, row_count, columns) per source; counting reads no column."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("name"), F.lit(kind).alias("type"), "row_count",
            F.lit(",".join(df.columns)).alias("columns"),
        )
        for name, (kind, df) in sources.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def table_inventory(spark: SparkSession, name_contains: str | None = None) -> DataFrame:
    """(table_name, row_count, column_name, data_type, ordinal) for the session's tables and views."""
    frames = []
    for table in spark.catalog.listTables():
        if name_contains and name_contains.lower() not in table.name.lower():
            continue
        df = spark.table(table.name)
        counted = df.agg(F.count(F.lit(1)).alias("row_count"))
        fields = F.array(*[
            F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"))
            for i, f in enumerate(df.schema.fields, 1)
        ])
        frames.append(counted.select(F.lit(table.name).alias("table_name"), "row_count", F.inline(fields)))
    if not frames:
        return spark.createDataFrame([], "table_name string, row_count long, ordinal int, column_name string, data_type string")
    return reduce(DataFrame.unionByName, frames)


def first_rows(tables: dict[str, tuple[DataFrame, list]], n: int = 5) -> DataFrame:
    """(table_name, position, row): the first n rows of each table in the given order, as JSON objects.

    Every task keeps n rows before any of them meet.
    """
    frames = []
    for name, (df, order) in tables.items():
        top = df.orderBy(*order).limit(n)
        place = F.row_number().over(Window.orderBy(*order))
        frames.append(top.select(F.lit(name).alias("table_name"), place.alias("position"),
                                 F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row")))
    return reduce(DataFrame.unionByName, frames)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
