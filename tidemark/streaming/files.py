"""Ingesting files as they appear in a folder, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import merge
from tidemark.operators.clean import CatalogRules, clean_catalog, repair
from tidemark.operators.quality import BatchRules, split_batch
from tidemark.session import temporary
from tidemark.sinks.published import PublishedTable


def stream_files(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.csv",
                 max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).options(header=True, escape='"', pathGlobFilter=pattern)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(folder).select("*", F.col("_metadata.file_name").alias("source_file"))


def ingest_new_files(spark: SparkSession, folder: str, schema: T.StructType, table: PublishedTable,
                     checkpoint: str, quarantine: PublishedTable, order_by: list[str],
                     rules: CatalogRules | None = None, checks: BatchRules | None = None,
                     max_files: int | None = None) -> list[dict]:
    """Clean every new file's rows, check what is clean, merge it by key, and keep the bad rows with their reasons.

    The checkpoint remembers processed files. Rows of several new files are taken
    together, so none replaces another; a product of a later file replaces the
    published one. `table` has the key of the catalogue. The quarantine gets the
    rows that fail the checks after their gaps were filled, as nothing else
    about them could be mended.
    """
    results: list[dict] = []

    def take(df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():
            return
        # the mark belongs to this checkpoint: a new one counts its batches from 0 again
        mark = f"batch:{spark.read.json(f'{checkpoint}/metadata').first()['id']}"
        done = {"batch_id": batch_id}
        with temporary(df, "new-files") as new:
            bad = split_batch(repair(new, rules), order_by, checks or BatchRules())[1]
            if quarantine.state()["marks"].get(mark, -1) < batch_id:
                done["quarantined"] = quarantine.append(bad, {mark: batch_id})["rows_written"]
            good = split_batch(clean_catalog(new, order_by, rules), order_by, checks or BatchRules())[0]
            if table.state()["marks"].get(mark, -1) < batch_id:
                done["published"] = table.merge(good, lambda old, rows: merge.upsert(old, rows, table.key), {mark: batch_id})["rows_in_batch"]
        results.append(done)

    query = (
        stream_files(spark, folder, schema, max_files=max_files)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return results
