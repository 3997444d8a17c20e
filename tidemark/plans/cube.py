"""Cube queries over the star schema.

`star_join` attaches only the dimensions a result depends on; the queries work
on its rows or on their `grain`. Sums are exact decimals, shown as doubles with
two places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import revenue_sum
from tidemark.session import materialise
from tidemark.sources.inventory import first_rows

CALENDAR = ["year", "quarter", "month"]


def star_join(fact: DataFrame, product: DataFrame | None = None, store: DataFrame | None = None,
              time: DataFrame | None = None) -> DataFrame:
    """Sales with the attributes of the given dimensions.

    Year, quarter and month follow from a yyyymmdd `time_id` without a join;
    `time` is for keys that do not.
    """
    if product is not None:
        fact = fact.join(product, "product_id")
    if store is not None:
        fact = fact.join(store, "store_id")
    if time is not None:
        fact = fact.join(time.select("time_id", *CALENDAR), "time_id")
    elif "time_id" in fact.columns:
        month = F.floor(F.col("time_id") / 100) % 100
        fact = fact.withColumns({
            "year": F.floor(F.col("time_id") / 10000).cast("int"),
            "quarter": F.ceil(month / 3).cast("int"),
            "month": month.cast("int"),
        })
    return fact


def _shown(sales: DataFrame) -> Column:
    return F.round(revenue_sum(sales), 2).cast("double").alias("revenue")


def _sales_count(df: DataFrame) -> Column:
    return F.sum("txns") if "txns" in df.columns else F.count(F.lit(1))


def grain(sales: DataFrame, attributes: list[str]) -> DataFrame:
    """Sales summed per combination of attributes; every cube query gives the same result on it."""
    return sales.groupBy(*attributes).agg(
        revenue_sum(sales).alias("revenue"), F.sum("quantity").alias("quantity"), _sales_count(sales).alias("txns")
    )


def revenue_by_category_month(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("category_name", "month").agg(_shown(sales))
        .orderBy(F.desc("revenue"), "category_name", "month")
    )


def top_article_types(sales: DataFrame, n: int = 10) -> DataFrame:
    return (
        sales.groupBy("article_type_name")
        .agg(F.sum("quantity").cast("long").alias("units_sold"), _shown(sales))
        .orderBy(F.desc("revenue"), "article_type_name").limit(n)
    )


def revenue_by_region(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("region")
        .agg(_shown(sales), _sales_count(sales).alias("transactions"))
        .orderBy(F.desc("revenue"), "region")
    )


def quarterly_trend(sales: DataFrame) -> DataFrame:
    return sales.groupBy("year", "quarter").agg(_shown(sales)).orderBy("year", "quarter")


def gender_by_category(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("gender", "category_name")
        .agg(_sales_count(sales).alias("txns"), _shown(sales))
        .orderBy("gender", F.desc("revenue"), "category_name")
    )


def revenue_cube(sales: DataFrame) -> DataFrame:
    """All subtotals of category, region and quarter.

    The finest grain is aggregated first: the eightfold row expansion of the
    cube then works on groups, not on sales. `level` tells a subtotal from a
    NULL in the data.
    """
    axes = ["category_name", "region", "quarter"]
    groups = sales.groupBy(*axes).agg(revenue_sum(sales).alias("revenue"), _sales_count(sales).alias("txns"))
    return (
        groups.cube(*axes)
        .agg(_shown(groups), F.sum("txns").alias("txns"),
             F.grouping_id().cast("int").alias("level"))
        .orderBy(F.desc_nulls_last("revenue"), "level", *axes)
    )


def run_all(sales: DataFrame) -> dict[str, DataFrame]:
    """Every cube query by name.

    Sales are read once: their common grain is written and all queries work on it.
    """
    attributes = ["category_name", "article_type_name", "gender", "region", *CALENDAR]
    common = materialise(grain(sales, attributes), "grain")
    return {
        "revenue_by_category_month": revenue_by_category_month(common),
        "top_article_types": top_article_types(common),
        "revenue_by_region": revenue_by_region(common),
        "quarterly_trend": quarterly_trend(common),
        "gender_by_category": gender_by_category(common),
        "revenue_cube": revenue_cube(common),
    }


#: What the results are sorted by when their first rows are shown.
PREVIEW_ORDER = {
    "revenue_by_category_month": ["category_name", "month"], "top_article_types": ["article_type_name"],
    "revenue_by_region": ["region"], "quarterly_trend": ["year", "quarter"],
    "gender_by_category": ["gender", "category_name"], "revenue_cube": ["level", "category_name", "region", "quarter"],
}


def previews(results: dict[str, DataFrame], n: int = 5) -> DataFrame:
    """(table_name, position, row): the first n rows of each result, greatest revenue first."""
    def order(name: str, df: DataFrame) -> list:
        return [F.desc_nulls_last("revenue")] * ("revenue" in df.columns) + [c for c in PREVIEW_ORDER.get(name, df.columns) if c in df.columns]

    return first_rows({name: (df, order(name, df)) for name, df in results.items()}, n)


def result_sizes(results: dict[str, DataFrame]) -> DataFrame:
    """(query, row_count), one aggregate per result."""
    frames = [df.agg(F.lit(name).alias("query"), F.count(F.lit(1)).alias("row_count")) for name, df in results.items()]
    sizes = frames[0]
    for f in frames[1:]:
        sizes = sizes.unionByName(f)
    return sizes
