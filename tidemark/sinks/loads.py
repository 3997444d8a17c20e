"""Load strategies on top of published tables."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import merge
from tidemark.operators.dedupe import latest_per_key
from tidemark.sinks.published import Constraints, PublishedTable, PublishRejected


RUN_LOG = "run_id string, rows_upserted long, ran_at timestamp"


def load_full(table: PublishedTable, df: DataFrame) -> dict:
    started = time.monotonic()
    result = table.replace(df)
    return {"strategy": "full_load", "rows_written": result["rows_written"],
            "seconds": round(time.monotonic() - started, 4)}


def load_incremental(table: PublishedTable, df: DataFrame, mark_column: str) -> dict:
    """Append rows above the high-water mark; rows and new mark appear together.

    No mark yet means every row is new. The filter reaches the source scan.
    """
    started = time.monotonic()
    kind = df.schema[mark_column].dataType
    previous = table.state()["marks"].get(mark_column)
    new = df if previous is None else df.filter(F.col(mark_column) > F.lit(previous).cast(kind))
    # marks are kept as whole numbers or as text that Spark reads back in the same time zone
    top = F.max(mark_column) if isinstance(kind, T.IntegralType) else F.max(mark_column).cast("string")
    top = new.agg(top).first()[0]
    result = {"strategy": "incremental_load", "prev_watermark": previous, "rows_written": 0}
    if top is not None:
        # bounded above as well: rows that arrive in between wait for the next load
        bounded = new.filter(F.col(mark_column) <= F.lit(top).cast(kind))
        result["rows_written"] = table.append(bounded, {mark_column: top})["rows_written"]
    return {**result, "seconds": round(time.monotonic() - started, 4)}


def load_and_verify(table: PublishedTable, df: DataFrame) -> dict:
    """Replace the table, then compare the rows handed over with those that a reader sees."""
    loaded = df.count()
    table.replace(df)
    verified = table.read().count()
    return {"rows_loaded": loaded, "rows_verified": verified, "match": loaded == verified}


def load_atomic(table: PublishedTable, df: DataFrame) -> dict:
    """Replace the table as a whole or leave it as it was."""
    before = table.state()["rows"]
    try:
        result = table.replace(df)
    except PublishRejected as problem:
        return {"outcome": "ROLLED_BACK", "error": str(problem), "final_row_count": before}
    return {"outcome": "COMMITTED", "error": None, "final_row_count": result["rows_total"]}


def load_upsert(table: PublishedTable, df: DataFrame, run_id: str, last_by: list[str] | None = None) -> dict:
    """Merge a batch by the table's key and report how many keys were new.

    With `last_by` the row with the greatest such tuple wins for a repeated
    key; without it a repeated key rejects the batch.
    """
    before = table.state()["rows"]
    batch = df if last_by is None else latest_per_key(df, table.key, last_by)
    result = table.merge(
        batch.withColumn("loaded_by_run", F.lit(run_id)),
        lambda old, new: merge.upsert(old, new, table.key),
        {"run_id": run_id},
    )
    return {"run_id": run_id, "row_count_before": before, "row_count_after": result["rows_total"],
            "net_new_rows": result["rows_total"] - before, "rows_in_batch": result["rows_in_batch"]}


def log_run(spark, path: str, run_id: str, rows: int) -> None:
    """One row per run in the run log; a run that is logged again replaces its row."""
    row = [(run_id, rows, datetime.now(timezone.utc))]
    spark.createDataFrame(row, RUN_LOG).coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("run_id").parquet(path)


def read_run_log(spark, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)


def verify_idempotent(table: PublishedTable, df: DataFrame, run_ids: tuple[str, str]) -> dict:
    """Load the same batch twice; the second load must add nothing."""
    first = load_upsert(table, df, run_ids[0])
    second = load_upsert(table, df, run_ids[1])
    return {"first_run": first, "second_run": second, "idempotent_confirmed": second["net_new_rows"] == 0}


def rebuild_range(df: DataFrame, path: str, partition: list[str]) -> None:
    """Rewrite exactly the partitions that `df` holds; others keep their files."""
    df.hint("rebalance", *partition).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partition).parquet(path)


def require_rollback(report: DataFrame) -> None:
    """Fail unless every rejected load left no row behind."""
    rolled_back = (F.col("outcome") == "ROLLED_BACK") & (F.col("final_row_count") == F.col("row_count_before"))
    bad = report.filter(F.col("inject_failure") & ~rolled_back)
    if not bad.isEmpty():
        raise AssertionError(f"a failed load left rows behind: {bad.limit(5).collect()}")


PRODUCT_CONSTRAINTS = Constraints(not_null=["id", "productDisplayName"], unique=["id"])
