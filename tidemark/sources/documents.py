"""JSON document collections and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.collections import read_objects

REVIEW_SCHEMA = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("review_count", T.IntegerType()),
])


def read_collection(spark: SparkSession, path: str, document: T.StructType = REVIEW_SCHEMA,
                    table: str = "_default", one_per_line: bool = False) -> DataFrame:
    """Documents stored as {"<table>": {"<number>": {…}, …}}.

    A file is split whether it is one line or many (`collections.read_objects`).
    `one_per_line` takes one such object per line, which needs no pass before.
    """
    if one_per_line:
        stored = spark.read.schema(T.StructType([T.StructField(table, T.MapType(T.StringType(), document))])).json(path)
        members = stored.select(F.col(f"`{table}`").alias("members"))
    else:
        member = F.concat(F.lit("{"), F.regexp_replace("text", r"^[\s,]+", ""), F.lit("}"))
        members = read_objects(spark, path, table).select(F.from_json(member, T.MapType(T.StringType(), document)).alias("members"))
    return members.select(F.explode("members").alias("doc_key", "doc")).filter("doc IS NOT NULL").select("doc.*")


def read_document_lines(spark: SparkSession, path: str, document: T.StructType = REVIEW_SCHEMA) -> DataFrame:
    """The splittable form of a collection: one document per line."""
    return spark.read.schema(document).json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)
