"""Validation of a batch and separation of bad rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.clean import outside
from tidemark.operators.combine import missing_columns
from tidemark.session import materialise, scratch_path

# The columns a catalogue batch must have.
CATALOG_COLUMNS = [
    "id", "gender", "masterCategory", "subCategory", "articleType",
    "baseColour", "season", "year", "usage", "productDisplayName",
]


class BatchRejected(Exception):
    """A staged batch failed its checks; it stays in staging."""

    def __init__(self, report: dict):
        super().__init__(f"batch failed validation: {report}")
        self.report = report


@dataclass(frozen=True)
class BatchRules:
    required: list[str] = field(default_factory=lambda: list(CATALOG_COLUMNS))
    mandatory: list[str] = field(default_factory=lambda: ["id", "productDisplayName", "masterCategory"])
    key: str = "id"
    numeric: str = "year"
    valid_range: tuple[int, int] = (1990, 2026)


def validate(df: DataFrame, rules: BatchRules | None = None) -> DataFrame:
    """One report row. A check whose column is absent fails instead of raising.

    Grouping by the key first gives row checks and duplicate check in a single
    pass over the batch with map-side partial sums.
    """
    rules = rules or BatchRules()
    missing = missing_columns(df, rules.required)
    per_row = {"n": F.lit(1)}
    for c in rules.mandatory:
        if c in df.columns:
            per_row[f"null_{c}"] = F.col(c).isNull().cast("int")
    if rules.numeric in df.columns:
        numeric = isinstance(df.schema[rules.numeric].dataType, T.NumericType)
        number = F.col(rules.numeric) if numeric else F.col(rules.numeric).try_cast("double")
        per_row["not_numeric"] = (F.col(rules.numeric).isNotNull() & number.isNull()).cast("int")
        per_row["outliers"] = (~F.coalesce(number.between(*rules.valid_range), F.lit(False))).cast("int")
    flags = df.select(*[c for c in [rules.key] if c in df.columns], *[v.alias(k) for k, v in per_row.items()])
    if rules.key in df.columns:
        flags = flags.groupBy(rules.key).agg(*[F.sum(k).alias(k) for k in per_row])
        extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    else:
        extra = F.lit(None).cast("long")
    totals = flags.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in per_row if k != "n"],
        extra.alias("duplicate_count"),
    )
    null_columns = [f"null_{c}" for c in rules.mandatory if c in df.columns]
    checks = {
        "schema_valid": F.lit(not missing),
        "not_empty": F.col("row_count") > 0,
        "null_check_passed": _all_zero(null_columns, complete=len(null_columns) == len(rules.mandatory)),
        "numeric_check_passed": F.col("not_numeric") == 0 if "not_numeric" in per_row else F.lit(False),
        "outlier_check_passed": F.col("outliers") == 0 if "outliers" in per_row else F.lit(False),
        "duplicate_check_passed": F.coalesce(F.col("duplicate_count") == 0, F.lit(False)),
    }
    report = totals.withColumns(checks)
    passed = F.lit(True)
    for name in checks:
        passed = passed & F.col(name)
    return report.select(
        "row_count",
        F.lit(missing).cast("array<string>").alias("missing_columns"),
        *[F.col(c) if c in report.columns else F.lit(None).cast("long").alias(c)
          for c in [*[f"null_{m}" for m in rules.mandatory], "not_numeric", "outliers", "duplicate_count"]],
        *checks,
        passed.alias("all_passed"),
    )


def _all_zero(columns: list[str], complete: bool):
    result = F.lit(complete)
    for c in columns:
        result = result & (F.col(c) == 0)
    return result


def with_reject_reasons(df: DataFrame, order_by: list[str], rules: BatchRules | None = None) -> DataFrame:
    """Every row with `reject_reasons`; an empty array means the row is good.

    A row repeats its key when an earlier row of the key (by `order_by`, unique
    within a key) stays: the first row without another reason, or the first row of
    a key that has none. Only keys that occur more than once are joined back. A
    checked column that is absent is a reason for every row.
    """
    rules = rules or BatchRules()
    absent = missing_columns(df, [*rules.mandatory, rules.numeric])
    reasons = [*[F.when(F.col(c).isNull(), F.lit(f"null:{c}")) for c in rules.mandatory if c not in absent],
               *[F.lit(f"missing:{c}") for c in absent]]
    if rules.numeric not in absent:
        number = F.col(rules.numeric).try_cast("double")
        reasons += [
            F.when(F.col(rules.numeric).isNotNull() & number.isNull(), F.lit(f"not_numeric:{rules.numeric}")),
            F.when(~F.coalesce(number.between(*rules.valid_range), F.lit(False)), F.lit(f"range:{rules.numeric}")),
        ]
    own = F.array_compact(F.array(*reasons))
    if rules.key not in df.columns:
        return df.withColumn("reject_reasons", own)
    rank = F.struct(*order_by)
    repeated = materialise(
        df.groupBy(F.col(rules.key).alias("__key"))
        .agg(F.count(F.lit(1)).alias("__n"), F.min(F.when(F.size(own) == 0, rank)).alias("__good"), F.min(rank).alias("__any"))
        .filter(F.col("__n") > 1).select("__key", F.coalesce("__good", "__any").alias("__first")),
        "repeated-keys",
    )
    again = F.when(F.col("__first").isNotNull() & (rank > F.col("__first")), F.array(F.lit(f"duplicate:{rules.key}")))
    joined = df.join(repeated, F.col(rules.key).eqNullSafe(F.col("__key")), "left")
    return joined.withColumn("reject_reasons", F.concat(own, F.coalesce(again, F.array().cast("array<string>")))).drop("__key", "__first")


def split_batch(df: DataFrame, order_by: list[str], rules: BatchRules | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with their reasons)."""
    judged = with_reject_reasons(df, order_by, rules)
    good = judged.filter(F.size("reject_reasons") == 0).drop("reject_reasons")
    return good, judged.filter(F.size("reject_reasons") > 0)


def stage_and_validate(df: DataFrame, batch_id: str, staging: str | None = None,
                       rules: BatchRules | None = None) -> tuple[DataFrame, dict]:
    """Write the batch to its own staging folder, check what was written, and return it.

    Raises BatchRejected when a check fails; the staged files stay for inspection.
    """
    spark = df.sparkSession
    root = staging or scratch_path(spark, "staging")
    path = f"{root}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    report = {**validate(staged, rules).first().asDict(recursive=True), "batch_id": batch_id, "staging_path": path}
    if not report["all_passed"]:
        raise BatchRejected(report)
    return staged, report
