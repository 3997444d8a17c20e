"""Dimensional model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.clean import clean_catalog
from tidemark.operators.ids import with_positions
from tidemark.plans import star
from tidemark.session import scratch_path
from tidemark.suite import inputs
from tidemark.suite.inputs import CLEAN_SQL
from tidemark.suite.registry import query

_CALENDAR = """CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  dayname(d) AS day_of_week"""
_DAYS = "days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"


def _catalog(spark, sf):
    return clean_catalog(inputs.raw_catalog(spark, sf), ["delivery"]).withColumnRenamed("id", "product_id")


_NORMAL = f"""{CLEAN_SQL},
cats AS (SELECT row_number() OVER (ORDER BY c) AS category_id, c AS category_name FROM (SELECT DISTINCT masterCategory AS c FROM clean)),
subs AS (SELECT row_number() OVER (ORDER BY c, s) AS sub_category_id, c, s AS sub_category_name
  FROM (SELECT DISTINCT masterCategory AS c, subCategory AS s FROM clean)),
arts AS (SELECT row_number() OVER (ORDER BY a) AS article_type_id, a AS article_type_name FROM (SELECT DISTINCT articleType AS a FROM clean)),
products AS (SELECT id AS product_id, productDisplayName AS product_name, gender, category_id AS master_category_id, sub_category_id,
  article_type_id, baseColour AS base_colour, season, usage, year AS catalog_year
  FROM clean JOIN cats ON masterCategory = category_name JOIN subs ON subCategory = sub_category_name AND masterCategory = c
  JOIN arts ON articleType = article_type_name)"""


@query("dim_time", f"WITH {_DAYS} SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS time_id, d AS order_date, {_CALENDAR} FROM days")
def dim_time(spark, sf):
    return star.dim_time(inputs.orders(spark, sf))


@query("dim_time_consecutive", f"WITH {_DAYS} SELECT row_number() OVER (ORDER BY d) AS time_id, d AS order_date, {_CALENDAR} FROM days")
def dim_time_consecutive(spark, sf):
    return star.dim_time(inputs.orders(spark, sf), consecutive=True)


@query("normalise_3nf", f"WITH {_NORMAL} SELECT * FROM products")
def normalise_3nf(spark, sf):
    return star.normalise(_catalog(spark, sf)).products


@query("normalise_sub_categories", f"""WITH {_NORMAL}
SELECT sub_category_id, sub_category_name, category_id FROM subs JOIN cats ON c = category_name""")
def normalise_sub_categories(spark, sf):
    return star.normalise(_catalog(spark, sf)).sub_categories


@query("dim_product_star", f"""WITH {CLEAN_SQL}
SELECT id AS product_id, productDisplayName AS product_name, gender, masterCategory AS category_name,
  subCategory AS sub_category_name, articleType AS article_type_name, baseColour AS base_colour, season, usage FROM clean""")
def dim_product_star(spark, sf):
    return star.dim_product(star.normalise(_catalog(spark, sf)))


@query("snowflake_equivalence", f"""WITH {CLEAN_SQL}
SELECT masterCategory AS category_name, articleType AS article_type_name, count(*) AS star_rows, count(*) AS snowflake_rows
FROM clean GROUP BY 1, 2""")
def snowflake_equivalence(spark, sf):
    """Product counts by two attributes, over the flat dimension and over the snowflake tables."""
    tables = star.normalise(_catalog(spark, sf))
    flake = star.snowflake_tables(tables)
    axes = ["category_name", "article_type_name"]
    flat = star.dim_product(tables).groupBy(*axes).agg(F.count(F.lit(1)).alias("star_rows"))
    hops = (
        flake["snowflake_dim_product"]
        .join(flake["snowflake_dim_subcategory"], "sub_category_id")
        .join(flake["snowflake_dim_category"], "category_id")
        .join(flake["snowflake_dim_article_type"], "article_type_id")
        .groupBy(*axes).agg(F.count(F.lit(1)).alias("snowflake_rows"))
    )
    return flat.join(hops, axes, "full_outer")


@query("dim_store_customer", """SELECT 'customer' AS dimension, c_custkey AS member_id, c_name AS member_name, c_mktsegment AS attribute FROM customer
UNION ALL SELECT 'store', s_suppkey, s_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""")
def dim_store_customer(spark, sf):
    customers = inputs.table(spark, sf, "customer").select(
        F.lit("customer").alias("dimension"), F.col("c_custkey").alias("member_id"), F.col("c_name").alias("member_name"),
        F.col("c_mktsegment").alias("attribute"))
    stores = inputs.store(spark, sf).select(
        F.lit("store").alias("dimension"), F.col("store_id").alias("member_id"), F.col("store_name").alias("member_name"),
        F.col("region").alias("attribute"))
    return customers.unionByName(stores)


@query("fact_sales", """WITH numbered AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_quantity, l_extendedprice) AS order_item_id FROM lineitem)
SELECT order_item_id, l_orderkey AS order_id, l_partkey AS product_id, o_custkey AS customer_id, l_suppkey AS store_id,
  CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS time_id, l_quantity AS quantity, l_extendedprice AS unit_price,
  CAST(CAST(l_quantity AS DECIMAL(10,0)) * CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS revenue
FROM numbered JOIN orders ON l_orderkey = o_orderkey""")
def fact_sales(spark, sf):
    lines = inputs.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("unit_price"), "l_linenumber")
    numbered = with_positions(lines, ["order_id", "l_linenumber", "product_id", "store_id", "quantity", "unit_price"], "order_item_id")
    fact = star.fact_sales(numbered, inputs.orders(spark, sf))
    return fact.withColumns({c: F.col(c).cast("double") for c in ("unit_price", "revenue")})


@query("fact_one_quarter", """SELECT l_suppkey AS store_id, month(o_orderdate)::INTEGER AS month, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate >= TIMESTAMP '1997-04-01' AND o_orderdate < TIMESTAMP '1997-07-01' GROUP BY 1, 2""")
def fact_one_quarter(spark, sf):
    """Facts are kept by month; the quarter is a condition on the time dimension only."""
    path = scratch_path(spark, "fact-by-month")
    star.write_by_month(inputs.dated_sales(spark, sf).select("order_id", "store_id", "time_id", "quantity"), path)
    days = inputs.time(spark, sf).filter("year = 1997 AND quarter = 2").select("time_id", "month")
    return star.sales_of_days(spark.read.parquet(path), days).groupBy("store_id", "month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").cast("long").alias("quantity"))
