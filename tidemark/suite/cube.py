"""Cube queries and business measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.clean import cleaning_report
from tidemark.plans import cube, measures
from tidemark.suite import inputs
from tidemark.suite.inputs import CLEAN_SQL, SALES_SQL
from tidemark.suite.registry import query


def _by_store(fact, spark, sf):
    """Sales with their region, by the snowflake hop: each table's own size decides how it is joined."""
    return (
        fact.join(inputs.table(spark, sf, "supplier"), F.col("store_id") == F.col("s_suppkey"))
        .join(inputs.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(inputs.table(spark, sf, "region").withColumnRenamed("r_name", "region"),
              F.col("n_regionkey") == F.col("r_regionkey"))
    )


def _star(spark, sf):
    return _by_store(cube.star_join(inputs.dated_sales(spark, sf), product=inputs.product(spark, sf)), spark, sf)


_MONEY = "CAST(round(sum(revenue), 2) AS DOUBLE)"


@query("olap_cube", f"""WITH {SALES_SQL}
SELECT category_name, region, CAST(quarter(order_date) AS INTEGER) AS quarter, {_MONEY} AS revenue,
  count(*) AS txns, CAST(grouping(category_name, region, quarter(order_date)) AS INTEGER) AS level
FROM dated JOIN product USING (product_id) JOIN store USING (store_id)
GROUP BY CUBE (category_name, region, quarter(order_date))""")
def olap_cube(spark, sf):
    return cube.revenue_cube(_star(spark, sf))


@query("olap_category_month", f"""WITH {SALES_SQL}
SELECT category_name, CAST(month(order_date) AS INTEGER) AS month, {_MONEY} AS revenue
FROM dated JOIN product USING (product_id) GROUP BY 1, 2""")
def olap_category_month(spark, sf):
    return cube.revenue_by_category_month(cube.star_join(inputs.dated_sales(spark, sf), product=inputs.product(spark, sf)))


@query("olap_top_articles", f"""WITH {SALES_SQL}
SELECT article_type_name, CAST(sum(quantity) AS BIGINT) AS units_sold, {_MONEY} AS revenue
FROM sales JOIN product USING (product_id) GROUP BY 1 ORDER BY revenue DESC, 1 LIMIT 10""")
def olap_top_articles(spark, sf):
    return cube.top_article_types(cube.star_join(inputs.sales(spark, sf), product=inputs.product(spark, sf)))


@query("olap_region", f"""WITH {SALES_SQL}
SELECT region, {_MONEY} AS revenue, count(*) AS transactions FROM sales JOIN store USING (store_id) GROUP BY 1""")
def olap_region(spark, sf):
    return cube.revenue_by_region(_by_store(inputs.sales(spark, sf), spark, sf))


@query("olap_quarterly", f"""WITH {SALES_SQL}
SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(quarter(order_date) AS INTEGER) AS quarter, {_MONEY} AS revenue
FROM dated GROUP BY 1, 2""")
def olap_quarterly(spark, sf):
    return cube.quarterly_trend(cube.star_join(inputs.dated_sales(spark, sf)))


@query("olap_gender_category", f"""WITH {SALES_SQL}
SELECT gender, category_name, count(*) AS txns, {_MONEY} AS revenue
FROM sales JOIN product USING (product_id) GROUP BY 1, 2""")
def olap_gender_category(spark, sf):
    return cube.gender_by_category(cube.star_join(inputs.sales(spark, sf), product=inputs.product(spark, sf)))


@query("olap_result_sizes", f"""WITH {SALES_SQL},
wide AS (SELECT *, month(order_date) AS m, year(order_date) AS y, quarter(order_date) AS q
  FROM dated JOIN product USING (product_id) JOIN store USING (store_id))
SELECT 'revenue_by_category_month' AS query, count(DISTINCT (category_name, m)) AS row_count FROM wide UNION ALL
SELECT 'top_article_types', least(10, count(DISTINCT article_type_name)) FROM wide UNION ALL
SELECT 'revenue_by_region', count(DISTINCT region) FROM wide UNION ALL
SELECT 'quarterly_trend', count(DISTINCT (y, q)) FROM wide UNION ALL
SELECT 'gender_by_category', count(DISTINCT (gender, category_name)) FROM wide UNION ALL
SELECT 'revenue_cube', count(*) FROM (SELECT 1 FROM wide GROUP BY CUBE (category_name, region, q))""")
def olap_result_sizes(spark, sf):
    return cube.result_sizes(cube.run_all(_star(spark, sf)))


@query("kpi_core", f"""WITH {SALES_SQL}
SELECT CAST(sum(revenue) AS DOUBLE) AS total_revenue, CAST(sum(quantity) AS BIGINT) AS total_units,
  count(*) AS total_transactions,
  CAST(sum(revenue) AS DOUBLE) / count(DISTINCT order_id) AS average_order_value FROM sales""")
def kpi_core(spark, sf):
    return measures.core_measures(inputs.sales(spark, sf))


@query("kpi_distinct_counts", """SELECT
  (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS total_orders,
  (SELECT count(DISTINCT p_partkey) FROM part) AS total_products,
  (SELECT count(DISTINCT c_custkey) FROM customer) AS total_customers""")
def kpi_distinct_counts(spark, sf):
    return measures.key_counts({
        "total_orders": (inputs.table(spark, sf, "lineitem"), "l_orderkey"),
        "total_products": (inputs.table(spark, sf, "part"), "p_partkey"),
        "total_customers": (inputs.table(spark, sf, "customer"), "c_custkey"),
    })


def _by_article(spark, sf):
    joined = inputs.sales(spark, sf).join(inputs.product(spark, sf), "product_id")
    return measures.totals_by(joined, "article_type_name")


_TOTALS = f"""{SALES_SQL}, totals AS (SELECT article_type_name, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM sales JOIN product USING (product_id) GROUP BY 1)"""


@query("olap_previews", f"""WITH {SALES_SQL},
r AS (SELECT region, CAST(sum(revenue) AS DOUBLE) AS revenue FROM sales JOIN store USING (store_id) GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY revenue DESC, region) AS INTEGER) AS position, region, revenue FROM r QUALIFY position <= 5""")
def olap_previews(spark, sf):
    """The first rows of a result, as the build reports them."""
    result = cube.revenue_by_region(inputs.sales(spark, sf).join(inputs.store(spark, sf), "store_id"))
    shown = cube.previews({"revenue_by_region": result})
    return shown.select("position", F.get_json_object("row", "$.region").alias("region"),
                        F.get_json_object("row", "$.revenue").cast("double").alias("revenue"))


@query("measure_rank", f"""WITH {_TOTALS}
SELECT *, CAST(rank() OVER (ORDER BY revenue DESC) AS INTEGER) AS revenue_rank FROM totals""")
def measure_rank(spark, sf):
    return measures.revenue_rank(_by_article(spark, sf))


@query("measure_top_category", f"WITH {_TOTALS} SELECT * FROM totals ORDER BY revenue DESC, article_type_name LIMIT 1")
def measure_top_category(spark, sf):
    return measures.top_row(_by_article(spark, sf), "article_type_name")


@query("measure_share", f"""WITH {_TOTALS}
SELECT article_type_name, revenue,
  round(revenue / (SELECT CAST(sum(CAST(revenue AS DECIMAL(38,2))) AS DOUBLE) FROM totals), 12) AS share FROM totals""")
def measure_share(spark, sf):
    return measures.revenue_share(_by_article(spark, sf)).withColumn("share", F.round("share", 12))


@query("measure_ytd", f"""WITH {SALES_SQL},
daily AS (SELECT order_date, sum(revenue) AS r FROM dated GROUP BY 1)
SELECT order_date, CAST(r AS DOUBLE) AS day_revenue,
  CAST(sum(r) OVER (PARTITION BY year(order_date) ORDER BY order_date) AS DOUBLE) AS revenue_ytd FROM daily""")
def measure_ytd(spark, sf):
    return measures.year_to_date(inputs.dated_sales(spark, sf))


@query("measure_qoq", f"""WITH {SALES_SQL},
q AS (SELECT CAST(date_trunc('quarter', order_date) AS DATE) AS quarter_start, sum(revenue) AS r FROM dated GROUP BY 1)
SELECT a.quarter_start, CAST(a.r AS DOUBLE) AS revenue, CAST(b.r AS DOUBLE) AS previous_revenue,
  round(coalesce(CAST(a.r - b.r AS DOUBLE) / nullif(CAST(b.r AS DOUBLE), 0), 0), 12) AS qoq_change
FROM q a LEFT JOIN q b ON b.quarter_start = CAST(a.quarter_start - INTERVAL 3 MONTH AS DATE)""")
def measure_qoq(spark, sf):
    return measures.quarter_over_quarter(inputs.dated_sales(spark, sf)).withColumn("qoq_change", F.round("qoq_change", 12))


@query("measure_sply", f"""WITH {SALES_SQL},
daily AS (SELECT order_date, CAST(sum(revenue) AS DOUBLE) AS revenue FROM dated GROUP BY 1)
SELECT a.order_date, a.revenue, b.revenue AS revenue_last_year
FROM daily a LEFT JOIN daily b ON b.order_date = CAST(a.order_date - INTERVAL 1 YEAR AS DATE)""")
def measure_sply(spark, sf):
    return measures.same_period_last_year(inputs.dated_sales(spark, sf))


@query("measure_quality_scorecard", f"""WITH {CLEAN_SQL}
SELECT 'rows_after' AS metric, count(*) AS value FROM clean UNION ALL
SELECT 'duplicates_removed', (SELECT count(*) FROM repaired) - (SELECT count(*) FROM firsts) UNION ALL
SELECT 'noisy_rows_removed', (SELECT count(*) FROM firsts) - (SELECT count(*) FROM clean)""")
def measure_quality_scorecard(spark, sf):
    report = cleaning_report(inputs.raw_catalog(spark, sf), ["delivery"])
    return measures.quality_scorecard(report).withColumn("value", F.col("value").cast("long"))
