"""The whole build over the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ids import with_positions
from tidemark.plans.steps import run_steps
from tidemark.plans.warehouse import Sources, Warehouse, build
from tidemark.session import scratch_path
from tidemark.sources.delimited import read_typed
from tidemark.suite import inputs
from tidemark.suite.inputs import CLEAN_SQL, SOURCES_SQL
from tidemark.suite.registry import query


@query("warehouse_build", f"""WITH {CLEAN_SQL}, n AS (SELECT count(*) AS n FROM clean)
SELECT 1 AS run, 'clean' AS step, n FROM n UNION ALL SELECT 1, 'engineer', n FROM n UNION ALL SELECT 1, 'merge', n FROM n UNION ALL
SELECT 1, 'load_new', n FROM n UNION ALL SELECT 1, 'track', n FROM n UNION ALL SELECT 1, 'model', count(*) FROM lineitem UNION ALL
SELECT 1, 'analyse', 6 UNION ALL SELECT 1, 'export', 17 UNION ALL SELECT 1, 'validate', n FROM n UNION ALL SELECT 1, 'upsert', n FROM n UNION ALL
SELECT 2, 'load_new', 0 UNION ALL SELECT 2, 'track', 0 UNION ALL SELECT 2, 'upsert', 0""")
def warehouse_build(spark, sf):
    """Built once; then the loads run again and add nothing."""
    warehouse, first = _built(spark, sf)
    again = run_steps(spark, [("load_new", warehouse.load_new), ("track", warehouse.track),
                              ("upsert", lambda: warehouse.upsert("run-2"))]).withColumn("run", F.lit(2))
    return first.withColumn("run", F.lit(1)).unionByName(again).select("run", "step", F.col("detail").try_cast("long").alias("n"))


def _built(spark, sf):
    lines = inputs.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("unit_price"))
    customers = inputs.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("segment"))
    sources = Sources(
        catalog=inputs.raw_catalog(spark, sf), order_by=["delivery"], inventory=inputs.inventory(spark, sf),
        reviews=inputs.reviews(spark, sf), customers=customers, stores=inputs.store(spark, sf), sales_orders=inputs.orders(spark, sf),
        sales_items=lambda: with_positions(lines, ["order_id", "product_id", "store_id", "quantity", "unit_price"], "order_item_id"),
    )
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"), buckets=8)
    return warehouse, build(warehouse, sources, "run-1")


@query("warehouse_exports", f"""WITH {CLEAN_SQL},
names AS (SELECT DISTINCT masterCategory, subCategory, articleType FROM clean)
SELECT 'fact_sales' AS name, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS keys FROM lineitem UNION ALL
SELECT 'dim_product', count(*), CAST(sum(id) AS BIGINT) FROM clean UNION ALL
SELECT 'dim_customer', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer UNION ALL
SELECT 'dim_store', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier UNION ALL
SELECT 'dim_time', count(*), CAST(sum(year(d) * 10000 + month(d) * 100 + day(d)) AS BIGINT) FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) UNION ALL
SELECT 'normal_products', count(*), CAST(sum(id) AS BIGINT) FROM clean UNION ALL
SELECT 'normal_categories', n, n * (n + 1) // 2 FROM (SELECT count(DISTINCT masterCategory) AS n FROM names) UNION ALL
SELECT 'normal_sub_categories', n, n * (n + 1) // 2 FROM (SELECT count(*) AS n FROM (SELECT DISTINCT masterCategory, subCategory FROM names)) UNION ALL
SELECT 'normal_article_types', n, n * (n + 1) // 2 FROM (SELECT count(DISTINCT articleType) AS n FROM names) UNION ALL
SELECT 'normal_customers', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer UNION ALL
SELECT 'normal_stores', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier UNION ALL
SELECT 'normal_orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders UNION ALL
SELECT 'normal_order_items', count(*), CAST(sum(l_partkey) AS BIGINT) FROM lineitem""")
def warehouse_exports(spark, sf):
    """Rows and key sums of the exported files, read back."""
    warehouse, _ = _built(spark, sf)
    keys = {"fact_sales": "product_id", "dim_product": "product_id", "dim_customer": "customer_id", "dim_store": "store_id",
            "dim_time": "time_id", "normal_products": "product_id", "normal_categories": "category_id",
            "normal_sub_categories": "sub_category_id", "normal_article_types": "article_type_id", "normal_customers": "customer_id",
            "normal_stores": "store_id", "normal_orders": "order_id", "normal_order_items": "product_id"}
    rows = [read_typed(spark, f"{warehouse.root}/export/{n}", warehouse.read(n).schema).agg(
        F.lit(n).alias("name"), F.count(F.lit(1)).alias("n"), F.sum(F.col(k).cast("long")).alias("keys")) for n, k in keys.items()]
    return reduce(DataFrame.unionByName, rows)


@query("warehouse_rollup", f"""WITH {CLEAN_SQL}, {SOURCES_SQL}
SELECT masterCategory, count(*) AS product_count, round(avg(coalesce(stock_qty, 0)), 6) AS avg_stock,
  round(avg(coalesce(rating, 0.0)), 6) AS avg_rating, CAST(sum(coalesce(review_count, 0)) AS BIGINT) AS total_reviews
FROM clean c LEFT JOIN inventory i ON c.id = i.id LEFT JOIN reviews r ON c.id = r.product_id GROUP BY 1""")
def warehouse_rollup(spark, sf):
    """The category roll-up that the build published."""
    return _built(spark, sf)[0].read("category_rollup").withColumns({
        "avg_stock": F.round("avg_stock", 6), "avg_rating": F.round("avg_rating", 6)})
