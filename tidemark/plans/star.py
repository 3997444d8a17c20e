"""Normalised, star and snowflake forms of the sales model.

Dimensions carry no broadcast hint: Spark broadcasts a side whose measured
size is under its threshold and otherwise joins by sort-merge, where adaptive
execution splits a hot key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import calendar_columns, cents, from_cents
from tidemark.functions.dates import date_key
from tidemark.functions.numeric import MONEY
from tidemark.operators.ids import surrogate_keys, with_positions
from tidemark.session import materialise


@dataclass(frozen=True)
class NormalForm:
    master_categories: DataFrame
    sub_categories: DataFrame
    article_types: DataFrame
    products: DataFrame


def normalise(catalog: DataFrame) -> NormalForm:
    """Look-up tables with ids in natural order, and products that refer to them.

    A sub-category is identified by its name within its master category. The
    catalogue is read once for its distinct names and once for the products.
    """
    names = materialise(catalog.select(
        F.col("masterCategory").alias("category_name"), F.col("subCategory").alias("sub_category_name"),
        F.col("articleType").alias("article_type_name"),
    ).distinct(), "names")

    def keyed(columns: list[str], key: str) -> DataFrame:
        return surrogate_keys(names.select(*columns).na.drop(), columns, key)

    categories = keyed(["category_name"], "category_id")
    subs = keyed(["category_name", "sub_category_name"], "sub_category_id")
    articles = keyed(["article_type_name"], "article_type_id")
    products = (
        catalog.withColumnsRenamed({"masterCategory": "category_name", "subCategory": "sub_category_name",
                                    "articleType": "article_type_name"})
        .join(categories, "category_name", "left")
        .join(subs, ["category_name", "sub_category_name"], "left")
        .join(articles, "article_type_name", "left")
        .select(
            "product_id", F.col("productDisplayName").alias("product_name"), "gender",
            F.col("category_id").alias("master_category_id"), "sub_category_id", "article_type_id",
            F.col("baseColour").alias("base_colour"), "season", "usage", F.col("year").alias("catalog_year"),
        )
    )
    sub_categories = subs.join(categories, "category_name").select(
        "sub_category_id", "sub_category_name", "category_id"
    )
    return NormalForm(categories, sub_categories, articles, products)


def dim_product(tables: NormalForm) -> DataFrame:
    """One flat row per product."""
    return (
        tables.products
        .join(tables.master_categories, F.col("master_category_id") == F.col("category_id"))
        .join(tables.sub_categories.drop("category_id"), "sub_category_id")
        .join(tables.article_types, "article_type_id")
        .select("product_id", "product_name", "gender", "category_name", "sub_category_name",
                "article_type_name", "base_colour", "season", "usage")
    )


def dim_time(orders: DataFrame, date: str = "order_date", consecutive: bool = False) -> DataFrame:
    """One row per order date.

    The key is yyyymmdd, which facts compute without a look-up; `consecutive`
    numbers the dates 1..n instead.
    """
    days = orders.select(F.col(date).cast("date").alias("order_date")).na.drop().distinct()
    keyed = (
        with_positions(days, ["order_date"], "time_id") if consecutive
        else days.withColumn("time_id", date_key("order_date"))
    )
    return keyed.select("time_id", "order_date", *calendar_columns("order_date"))


def sales_lines(items: DataFrame) -> DataFrame:
    """Order lines with their revenue in whole cents."""
    return items.withColumn("revenue_cents", cents(F.col("quantity") * F.col("unit_price")))


def fact_sales(items: DataFrame, orders: DataFrame, time: DataFrame | None = None) -> DataFrame:
    """Order lines with the keys of their order and its day.

    `time` is needed only for consecutive time ids. Revenue follows after the join,
    so that it is not shuffled with the lines.
    """
    joined = sales_lines(items.join(orders, "order_id"))
    if time is None:
        joined = joined.withColumn("time_id", date_key("order_date"))
    else:
        joined = joined.join(time.select("time_id", "order_date"), "order_date")
    return joined.select("order_item_id", "order_id", "product_id", "customer_id", "store_id", "time_id",
                         "quantity", F.col("unit_price").cast(MONEY).alias("unit_price"),
                         from_cents("revenue_cents").alias("revenue"))


def write_by_month(fact: DataFrame, path: str) -> None:
    """Facts in one folder a month; large months are split over tasks and files."""
    month = F.floor(F.col("time_id") / 100).cast("int")
    fact.withColumn("month_id", month).hint("rebalance", F.col("month_id")).write.partitionBy("month_id").parquet(path)


def sales_of_days(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Facts written by month, of some rows of the time dimension.

    The month is part of the join, so Spark reads the folders of the months that
    `days` turns out to hold and no others.
    """
    days = days.withColumn("month_id", F.floor(F.col("time_id") / 100).cast("int"))
    return fact.join(days, ["month_id", "time_id"]).drop("month_id")


def snowflake_product(tables: NormalForm) -> DataFrame:
    return tables.products.select("product_id", "product_name", "gender", "base_colour", "season", "usage",
                                  "master_category_id", "sub_category_id", "article_type_id")


def snowflake_tables(tables: NormalForm) -> dict[str, DataFrame]:
    return {
        "snowflake_dim_category": tables.master_categories,
        "snowflake_dim_subcategory": tables.sub_categories,
        "snowflake_dim_article_type": tables.article_types,
        "snowflake_dim_product": snowflake_product(tables),
    }
