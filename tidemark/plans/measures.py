"""Business measures: totals, ranks, shares and period comparisons.

Windows run over totals per day or per category, never over sales rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import quarter_start, revenue_sum, safe_ratio
from tidemark.functions.numeric import MONEY_TOTAL
from tidemark.operators.ids import ranked


def core_measures(fact: DataFrame) -> DataFrame:
    """Revenue, units, transactions and revenue per order.

    Orders are counted per order first, which also sums their lines early.
    """
    per_order = fact.groupBy("order_id").agg(
        revenue_sum(fact).alias("revenue"), F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("n")
    )
    totals = per_order.agg(
        F.sum("revenue").cast("double").alias("total_revenue"),
        F.sum("quantity").cast("long").alias("total_units"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_transactions"),
        F.count("order_id").alias("orders"),
    )
    return totals.select(
        "total_revenue", "total_units", "total_transactions",
        safe_ratio("total_revenue", "orders").alias("average_order_value"),
    )


def key_counts(columns: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row of distinct counts, each over its own table."""
    names = list(columns)
    df, column = columns[names[0]]
    result = df.agg(F.countDistinct(column).alias(names[0]))
    for name in names[1:]:
        df, column = columns[name]
        result = result.withColumn(name, df.agg(F.countDistinct(column)).scalar())
    return result


def totals_by(fact: DataFrame, column: str) -> DataFrame:
    return fact.groupBy(column).agg(revenue_sum(fact).cast("double").alias("revenue"))


def revenue_rank(totals: DataFrame, measure: str = "revenue") -> DataFrame:
    """Rank by the measure, highest first, with gaps after ties. Input: one row per category."""
    return ranked(totals, measure, "revenue_rank")


def top_row(totals: DataFrame, name: str, measure: str = "revenue") -> DataFrame:
    return totals.orderBy(F.desc(measure), name).limit(1)


def revenue_share(totals: DataFrame, measure: str = "revenue") -> DataFrame:
    whole = totals.agg(F.sum(F.col(measure).cast("decimal(38,2)")))
    return totals.withColumn("share", safe_ratio(F.col(measure), whole.scalar()))


def year_to_date(fact: DataFrame, date: str = "order_date") -> DataFrame:
    """Running revenue within the year, per day that has sales."""
    daily = fact.groupBy(date).agg(revenue_sum(fact).alias("day_revenue"))
    year = Window.partitionBy(F.year(date)).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        date, F.col("day_revenue").cast("double").alias("day_revenue"),
        F.sum("day_revenue").over(year).cast("double").alias("revenue_ytd"),
    )


def quarter_over_quarter(fact: DataFrame, date: str = "order_date") -> DataFrame:
    """Revenue per quarter, that of the quarter before, and the change in per cent.

    Each total is sent to its own quarter and to the next one, so one grouping
    pairs them and a missing quarter is not skipped over.
    """
    totals = fact.groupBy(quarter_start(F.col(date)).alias("q")).agg(revenue_sum(fact).alias("r"))
    value, none = F.col("r"), F.lit(None).cast(MONEY_TOTAL)
    paired = totals.select(F.inline(F.array(
        F.struct(F.col("q").alias("quarter_start"), value.alias("now"), none.alias("before")),
        F.struct(F.add_months("q", 3).alias("quarter_start"), none.alias("now"), value.alias("before")),
    )))
    return (
        paired.groupBy("quarter_start").agg(F.max("now").alias("now"), F.max("before").alias("before"))
        .filter(F.col("now").isNotNull())
        .select(
            "quarter_start", F.col("now").cast("double").alias("revenue"),
            F.col("before").cast("double").alias("previous_revenue"),
            safe_ratio(F.col("now") - F.col("before"), F.col("before")).alias("qoq_change"),
        )
    )


def same_period_last_year(fact: DataFrame, date: str = "order_date") -> DataFrame:
    """Revenue per day and of the same day a year earlier (29 February looks at the 28th)."""
    daily = fact.groupBy(date).agg(revenue_sum(fact).cast("double").alias("revenue"))
    earlier = daily.select(F.col(date).alias("__day"), F.col("revenue").alias("revenue_last_year"))
    return daily.join(earlier, F.add_months(date, -12) == F.col("__day"), "left").drop("__day")


def quality_scorecard(report: DataFrame) -> DataFrame:
    """Rows after cleaning, duplicates removed and out-of-range rows removed, from a cleaning report."""
    wanted = ["rows_after", "duplicates_removed", "noisy_rows_removed"]
    return report.filter(F.col("metric").isin(wanted))
