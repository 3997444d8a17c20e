"""Facts about image files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_image_facts(spark: SparkSession, folder: str) -> DataFrame:
    """(file, width, height, channels) of the readable images of a folder."""
    images = spark.read.format("image").option("dropInvalid", True).load(folder)
    return images.select(
        F.element_at(F.split("image.origin", "/"), -1).alias("file"),
        F.col("image.width").alias("width"),
        F.col("image.height").alias("height"),
        F.col("image.nChannels").alias("channels"),
    )


def read_file_facts(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(file, bytes) without reading the content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))
