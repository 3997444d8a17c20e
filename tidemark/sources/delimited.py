"""Delimited text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import na_to_null, strip
from tidemark.operators.dedupe import first_per_key_in_file
from tidemark.sources.quoted import FIELD, read_records


def read_typed(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None,
               limit: int | None = None, multi_line: bool = False) -> DataFrame:
    """Well-formed delimited files with declared types, optionally some columns or a preview.

    Quoted line breaks need `multi_line`, which reads each file in one task.
    """
    df = spark.read.schema(schema).options(header=True, escape='"', multiLine=multi_line).csv(path)
    if columns is not None:
        df = df.select(*columns)
    return df if limit is None else df.limit(limit)


def read_lenient(spark: SparkSession, path: str, schema: T.StructType,
                 na_texts: list[str] | None = None, quoted_breaks: bool = True) -> DataFrame:
    """Files with ragged records: too many fields drop the record, too few are padded with NULL.

    Works on whole records, so the decision does not depend on which columns a
    query reads. Records may go on over line breaks inside quotes; files are split
    all the same (`quoted.read_records`, which reads them once more to find where
    splits begin). `quoted_breaks=False` saves that where no field has any. Texts
    that mean "missing" become NULL and values that do not fit their type do too. A field with
    text behind its closing quote is kept as it stands.
    """
    header = ",".join(schema.fieldNames())
    records = read_records(spark, path) if quoted_breaks else spark.read.text(path)
    lines = records.filter((F.col("value") != "") & (F.col("value") != header)).filter(
        F.regexp_count("value", F.lit(FIELD)) <= len(schema))
    texts = ", ".join(f"`{n}` STRING" for n in schema.fieldNames())
    parsed = lines.select(F.from_csv("value", texts, {"escape": '"'}).alias("r"))
    return parsed.select(*[
        na_to_null(F.col("r")[f.name], na_texts).try_cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def read_folder(spark: SparkSession, folder: str, schema: T.StructType, key: str, order_by: list[str],
                trim: list[str], unknown: list[str], pattern: str = "*.csv", scope: str = "file") -> DataFrame:
    """All matching files of a folder as one table with `source_file`.

    Texts are stripped, gaps in `unknown` columns filled, and repeated keys
    dropped inside each file (`scope="file"`) or across files (`scope="all"`).
    """
    raw = (
        spark.read.schema(schema).options(header=True, escape='"', pathGlobFilter=pattern).csv(folder)
        .select("*", F.col("_metadata.file_name").alias("source_file"))
    )
    clean = raw.withColumns({c: strip(c) for c in trim}).na.fill("Unknown", subset=unknown)
    if scope == "all":
        return first_per_key_in_file(clean.withColumn("__all", F.lit(1)), [key], ["source_file", *order_by], "__all").drop("__all")
    return first_per_key_in_file(clean, [key], order_by)
