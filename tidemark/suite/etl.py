"""Source merging and batch preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import etl
from tidemark.suite import inputs
from tidemark.suite.cleaning import TITLE_SQL
from tidemark.suite.inputs import CATALOG_SQL, SOURCES_SQL
from tidemark.suite.registry import query

_MERGED = f"""{CATALOG_SQL}, {SOURCES_SQL},
merged AS (SELECT c.id AS product_id, gender, masterCategory, subCategory, {TITLE_SQL.format('trim(articleType)')} AS articleType,
  {TITLE_SQL.format('trim(baseColour)')} AS baseColour, season, year, {TITLE_SQL.format('trim(usage)')} AS usage,
  productDisplayName, coalesce(i.stock_qty, 0) AS stock_qty, coalesce(r.rating, 0.0) AS rating,
  coalesce(r.review_count, 0) AS review_count
FROM catalog c LEFT JOIN inventory i ON c.id = i.id LEFT JOIN reviews r ON c.id = r.product_id)"""


def _merged(spark, sf):
    return etl.merge_sources(inputs.catalog(spark, sf), inputs.inventory(spark, sf), inputs.reviews(spark, sf))


@query("etl_merge", f"WITH {_MERGED} SELECT * FROM merged")
def etl_merge(spark, sf):
    return _merged(spark, sf).drop("updated_at")


@query("etl_merge_without_reviews", f"""WITH {_MERGED}
SELECT product_id, stock_qty, 0.0::DOUBLE AS rating, 0 AS review_count FROM merged""")
def etl_merge_without_reviews(spark, sf):
    merged = etl.merge_sources(inputs.catalog(spark, sf), inputs.inventory(spark, sf))
    return merged.select("product_id", "stock_qty", "rating", "review_count")


@query("etl_category_rollup", f"""WITH {_MERGED}
SELECT masterCategory, count(product_id) AS product_count, round(avg(stock_qty), 9) AS avg_stock,
  round(avg(rating), 9) AS avg_rating, CAST(sum(review_count) AS BIGINT) AS total_reviews
FROM merged GROUP BY 1""")
def etl_category_rollup(spark, sf):
    return etl.category_rollup(_merged(spark, sf)).withColumns({
        "avg_stock": F.round("avg_stock", 9), "avg_rating": F.round("avg_rating", 9)})


@query("etl_category_distinct", f"""WITH {CATALOG_SQL}
SELECT masterCategory, count(id) AS product_count, count(DISTINCT articleType) AS unique_articles,
  count(DISTINCT baseColour) AS unique_colours FROM catalog GROUP BY 1""")
def etl_category_distinct(spark, sf):
    return etl.category_variety(inputs.catalog(spark, sf))


@query("api_transform", f"""WITH {CATALOG_SQL}
SELECT id, gender, masterCategory, subCategory, articleType, baseColour, season, year, usage,
  trim(productDisplayName) AS productDisplayName, id % 4000 + 299 AS price_estimate,
  coalesce(year >= 2015, false) AS is_recent FROM catalog""")
def api_transform(spark, sf):
    return etl.prepare_batch(inputs.catalog(spark, sf))


@query("warehouse_group_by", """SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1, 2""")
def warehouse_group_by(spark, sf):
    from tidemark.sinks.files import create_views

    create_views(spark, {"warehouse_orders": inputs.table(spark, sf, "orders")})
    return spark.sql("""SELECT o_orderpriority, year(o_orderdate) AS order_year, count(*) AS n,
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
      FROM warehouse_orders GROUP BY o_orderpriority, year(o_orderdate)""")
