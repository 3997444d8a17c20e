"""Batch validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.session import scratch_path
from tidemark.suite import inputs
from tidemark.suite.inputs import CATALOG_SQL, RAW_SQL
from tidemark.suite.registry import query


@query("validate_batch", f"""WITH {RAW_SQL}, c AS (SELECT count(*) AS row_count,
  count(*) - count(id) AS null_id, count(*) - count(productDisplayName) AS null_productDisplayName,
  count(*) - count(masterCategory) AS null_masterCategory, CAST(0 AS BIGINT) AS not_numeric,
  CAST(count_if(NOT coalesce(year BETWEEN 1990 AND 2026, false)) AS BIGINT) AS outliers,
  count(*) - count(DISTINCT id) AS duplicate_count FROM raw_catalog)
SELECT *, true AS schema_valid, row_count > 0 AS not_empty,
  null_id + null_productDisplayName + null_masterCategory = 0 AS null_check_passed, true AS numeric_check_passed,
  outliers = 0 AS outlier_check_passed, duplicate_count = 0 AS duplicate_check_passed, false AS all_passed FROM c""")
def validate_batch(spark, sf):
    return quality.validate(inputs.raw_catalog(spark, sf)).drop("missing_columns")


@query("validate_missing_column", f"""WITH {CATALOG_SQL}
SELECT count(*) AS row_count, 'season,year' AS missing, false AS schema_valid, false AS outlier_check_passed, false AS all_passed
FROM catalog""")
def validate_missing_column(spark, sf):
    report = quality.validate(inputs.catalog(spark, sf).drop("season", "year"))
    return report.select("row_count", F.array_join("missing_columns", ",").alias("missing"), "schema_valid",
                         "outlier_check_passed", "all_passed")


# A row repeats its key when an earlier row stays: the first good one, or the first one if none is good.
_JUDGED = f"""{RAW_SQL},
judged AS (SELECT *, productDisplayName IS NOT NULL AND coalesce(year BETWEEN 1990 AND 2026, false) AS fine FROM raw_catalog),
placed AS (SELECT *, coalesce(min(delivery) FILTER (fine) OVER (PARTITION BY id), min(delivery) OVER (PARTITION BY id)) AS first FROM judged)"""


@query("quarantine_rows", f"""WITH {_JUDGED}
SELECT id, delivery, concat_ws(',', CASE WHEN productDisplayName IS NULL THEN 'null:productDisplayName' END,
  CASE WHEN NOT coalesce(year BETWEEN 1990 AND 2026, false) THEN 'range:year' END,
  CASE WHEN delivery > first THEN 'duplicate:id' END) AS reasons
FROM placed WHERE NOT fine OR delivery > first""")
def quarantine_rows(spark, sf):
    _, bad = quality.split_batch(inputs.raw_catalog(spark, sf), ["delivery"])
    return bad.select("id", "delivery", F.array_join("reject_reasons", ",").alias("reasons"))


@query("accepted_rows", f"WITH {_JUDGED} SELECT * EXCLUDE (fine, first) FROM placed WHERE fine AND delivery = first")
def accepted_rows(spark, sf):
    return quality.split_batch(inputs.raw_catalog(spark, sf), ["delivery"])[0]


@query("stage_gate", f"""WITH {_JUDGED}
SELECT 'accepted' AS batch, true AS promoted, count(*) AS row_count FROM placed WHERE fine AND delivery = first
UNION ALL SELECT 'raw', false, count(*) FROM raw_catalog""")
def stage_gate(spark, sf):
    raw = inputs.raw_catalog(spark, sf)
    staging = scratch_path(spark, "staging")
    rows = []
    for name, batch in (("accepted", quality.split_batch(raw, ["delivery"])[0]), ("raw", raw)):
        try:
            _, report = quality.stage_and_validate(batch, name, staging)
        except quality.BatchRejected as rejected:
            report = rejected.report
        rows.append((name, report["all_passed"], report["row_count"]))
    return spark.createDataFrame(rows, "batch string, promoted boolean, row_count long")
