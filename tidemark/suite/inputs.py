"""The driver tables in the roles of the domain.

Where a role needs expressions, Spark and the checking SQL share their text;
everything computed from a role is written independently on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.star import dim_time, sales_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_day(df: DataFrame, column: str) -> DataFrame:
    """Results show the day of a date that is stored as a timestamp."""
    return df.withColumn(column, F.col(column).cast("date"))


GENDER = (
    "CASE WHEN p_retailprice < 920 THEN 'Men' WHEN p_retailprice < 940 THEN 'Women' "
    "WHEN p_retailprice < 960 THEN 'Unisex' WHEN p_retailprice < 980 THEN 'Boys' ELSE 'Girls' END"
)

# A catalogue with the defects real ones have: missing and padded texts, unknown
# seasons, missing and impossible years.
RAW_COLUMNS = {
    "id": "p_partkey",
    "gender": GENDER,
    "masterCategory": "p_type",
    "subCategory": "split_part(p_name, ' ', 2)",
    "articleType": "p_brand",
    "baseColour": "CASE WHEN p_size = 13 THEN NULL ELSE concat(' ', split_part(p_name, ' ', 1)) END",
    "season": "CASE WHEN p_size <= 12 THEN 'Spring' WHEN p_size <= 24 THEN 'Summer' WHEN p_size <= 36 THEN 'Fall' "
              "WHEN p_size <= 44 THEN 'Winter' WHEN p_size <= 46 THEN 'Monsoon' ELSE NULL END",
    "year": "CASE WHEN p_size = 23 THEN NULL ELSE 1985 + p_size END",
    "usage": "CASE WHEN p_retailprice >= 990 THEN NULL WHEN p_retailprice >= 950 THEN 'Casual' ELSE 'Sports-wear' END",
    "productDisplayName": "CASE WHEN p_size = 17 THEN NULL WHEN p_type = 'PROMO' THEN concat('  ', p_name, ' ') ELSE p_name END",
}

_FIRST = ", ".join(f"{e} AS {c}" for c, e in RAW_COLUMNS.items())
_AGAIN = ", ".join(f"{'1986 + p_size' if c == 'year' else e} AS {c}" for c, e in RAW_COLUMNS.items())
# parts of one type are delivered a second time with another year
RAW_SQL = (
    f"raw_catalog AS (SELECT {_FIRST}, 1 AS delivery FROM part UNION ALL "
    f"SELECT {_AGAIN}, 2 AS delivery FROM part WHERE p_type = 'SMALL')"
)
CATALOG_SQL = f"catalog AS (SELECT {_FIRST} FROM part)"


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part, with gaps."""
    return table(spark, sf_dir, "part").selectExpr(*[f"{e} AS {c}" for c, e in RAW_COLUMNS.items()])


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue with repeated deliveries; `delivery` gives their order."""
    part = table(spark, sf_dir, "part")
    first = catalog(spark, sf_dir).withColumn("delivery", F.lit(1))
    again = part.filter("p_type = 'SMALL'").selectExpr(
        *[f"{'1986 + p_size' if c == 'year' else e} AS {c}" for c, e in RAW_COLUMNS.items()], "2 AS delivery"
    )
    return first.unionByName(again)


# Stock of a part: what was ordered of it and not returned. Reviews: events of the user who has the part's number.
SOURCES_SQL = """inventory AS (SELECT l_partkey AS id, CAST(sum(l_quantity) AS INTEGER) AS stock_qty FROM lineitem
  WHERE l_returnflag = 'N' GROUP BY 1),
reviews AS (SELECT user_id AS product_id, round(5.0 * CAST(count_if(event_type = 'purchase') AS DOUBLE) / count(*), 2) AS rating,
  CAST(count(*) AS INTEGER) AS review_count FROM events GROUP BY 1)"""


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").filter("l_returnflag = 'N'").groupBy(F.col("l_partkey").alias("id")).agg(
        F.sum("l_quantity").cast("int").alias("stock_qty"), F.max("l_shipdate").alias("updated_at"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    rating = F.round(F.lit(5.0) * F.count_if(F.col("event_type") == "purchase") / F.count(F.lit(1)), 2)
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("product_id")).agg(
        rating.alias("rating"), F.count(F.lit(1)).cast("int").alias("review_count"))


# Cleaned catalogue in SQL: the checks that start from clean rows build on it.
CLEAN_SQL = RAW_SQL + """,
named AS (SELECT * FROM raw_catalog WHERE productDisplayName IS NOT NULL),
middle AS (SELECT CAST(trunc(median(year)) AS INTEGER) AS m FROM named),
repaired AS (SELECT id, trim(gender) AS gender, trim(masterCategory) AS masterCategory,
  trim(subCategory) AS subCategory, trim(articleType) AS articleType,
  trim(coalesce(baseColour, 'Unknown')) AS baseColour, trim(coalesce(season, 'Unknown')) AS season,
  coalesce(year, m) AS year, trim(coalesce(usage, 'Unknown')) AS usage,
  trim(productDisplayName) AS productDisplayName, delivery FROM named, middle),
firsts AS (SELECT * FROM repaired QUALIFY row_number() OVER (PARTITION BY id ORDER BY delivery) = 1),
clean AS (SELECT * FROM firsts WHERE year BETWEEN 1990 AND 2026)"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with revenue, for results that need no order columns."""
    return sales_lines(items(spark, sf_dir))


def dated_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the day of their order and its time key."""
    days = orders(spark, sf_dir).select(
        "order_id", "order_date", F.expr("year(order_date) * 10000 + month(order_date) * 100 + day(order_date)").alias("time_id")
    )
    return sales(spark, sf_dir).join(days, "order_id")


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id", "p_type AS category_name", "p_brand AS article_type_name", f"{GENDER} AS gender"
    )


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"),
                F.col("r_name").alias("region"))
    )


def time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_time(orders(spark, sf_dir))


SALES_SQL = f"""sales AS (SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS store_id,
  l_quantity AS quantity,
  CAST(l_quantity AS DECIMAL(10,0)) * CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue FROM lineitem),
days AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date FROM orders),
dated AS (SELECT * FROM sales JOIN days USING (order_id)),
product AS (SELECT p_partkey AS product_id, p_type AS category_name, p_brand AS article_type_name, {GENDER} AS gender FROM part),
store AS (SELECT s_suppkey AS store_id, r_name AS region FROM supplier
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User events as changes of a row per user; `event_ts` is a time-zone timestamp."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS event_type",
        "user_id AS product_id", "value", "event_type AS source_type",
        "CAST(ts AS TIMESTAMP) AS event_ts",
    )


CHANGES_SQL = """changes AS (SELECT CAST(event_id AS VARCHAR) AS event_id,
  CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS event_type,
  user_id AS product_id, value, event_type AS source_type, ts AS event_ts FROM events)"""
