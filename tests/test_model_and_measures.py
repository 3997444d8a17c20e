import threading
from datetime import date
from decimal import Decimal

import pytest
from conftest import CATALOG, catalog_row
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key
from tidemark.operators.ids import ranked, with_positions
from tidemark.plans import cube, etl, measures, star, steps, warehouse
from tidemark.session import materialise
from tidemark.sinks.published import PublishedTable


@pytest.fixture(scope="module")
def catalog(spark):
    df = spark.createDataFrame([
        catalog_row(1, "Shirt"), catalog_row(2, "Shoes", category="Footwear", sub="Topwear", article="Shoes"),
        catalog_row(3, "Cap", article="Caps"), catalog_row(4, "Odd", article=None),
    ], CATALOG)
    return df.withColumnRenamed("id", "product_id")


def test_normal_form_numbers_names_and_separates_equal_sub_categories(catalog, rows):
    tables = star.normalise(catalog)
    assert rows(tables.master_categories) == [(1, "Apparel"), (2, "Footwear")]
    # one name under two master categories is two sub-categories
    assert rows(tables.sub_categories) == [(1, "Topwear", 1), (2, "Topwear", 2)]
    assert rows(tables.article_types) == [(1, "Caps"), (2, "Shirts"), (3, "Shoes")]
    assert rows(tables.products, "product_id", "master_category_id", "sub_category_id", "article_type_id") == [
        (1, 1, 1, 2), (2, 2, 2, 3), (3, 1, 1, 1), (4, 1, 1, None)]


def test_flat_dimension_and_snowflake_agree(catalog, rows):
    tables = star.normalise(catalog)
    flat = star.dim_product(tables)
    assert rows(flat, "product_id", "category_name", "sub_category_name", "article_type_name") == [
        (1, "Apparel", "Topwear", "Shirts"), (2, "Footwear", "Topwear", "Shoes"), (3, "Apparel", "Topwear", "Caps")]
    assert set(star.snowflake_tables(tables)) == {
        "snowflake_dim_category", "snowflake_dim_subcategory", "snowflake_dim_article_type", "snowflake_dim_product"}


@pytest.fixture(scope="module")
def sales(spark):
    orders = spark.createDataFrame([
        (1, 10, date(2024, 1, 15)), (2, 11, date(2024, 5, 2)), (3, 10, date(2025, 1, 15)), (4, 12, date(2024, 2, 29)),
        (5, 12, date(2025, 2, 28)),
    ], "order_id long, customer_id long, order_date date")
    items = spark.createDataFrame([
        (1, 1, 1, 7, 2, 10.10), (2, 1, 2, 7, 1, 0.20), (3, 2, 1, 8, 1, 100.0), (4, 3, 3, 8, 3, 50.0), (5, 4, 1, 7, 1, 5.0),
        (6, 99, 1, 7, 1, 1.0), (7, 5, 3, 7, 1, 9.0),
    ], "order_item_id long, order_id long, product_id long, store_id long, quantity int, unit_price double")
    return items, orders


def test_fact_has_exact_revenue_and_only_known_orders(sales, rows):
    items, orders = sales
    fact = star.fact_sales(items, orders)
    assert rows(fact, "order_item_id", "time_id", "customer_id", "revenue") == [
        (1, 20240115, 10, Decimal("20.20")), (2, 20240115, 10, Decimal("0.20")), (3, 20240502, 11, Decimal("100.00")),
        (4, 20250115, 10, Decimal("150.00")), (5, 20240229, 12, Decimal("5.00")), (7, 20250228, 12, Decimal("9.00"))]
    time = star.dim_time(orders, consecutive=True)
    assert rows(star.fact_sales(items, orders, time), "order_item_id", "time_id")[0] == (1, 1)
    assert rows(star.dim_time(orders).filter("time_id = 20240229"), "year", "quarter", "month", "day_of_week") == [(2024, 1, 2, "Thursday")]


@pytest.fixture(scope="module")
def joined(spark, sales):
    items, orders = sales
    product = spark.createDataFrame([(1, "Apparel", "Shirts", "Men"), (2, "Apparel", "Caps", "Women"), (3, "Footwear", "Shoes", "Men")],
                                    "product_id long, category_name string, article_type_name string, gender string")
    store = spark.createDataFrame([(7, "North"), (8, "South")], "store_id long, region string")
    return cube.star_join(star.fact_sales(items, orders), product, store)


def test_cube_totals_agree(joined):
    result = cube.revenue_cube(joined).collect()
    total = joined.agg(F.sum("revenue"), F.count(F.lit(1))).first()
    for level in range(8):
        part = [r for r in result if r["level"] == level]
        assert sum(r["txns"] for r in part) == total[1]
        assert sum(r["revenue"] for r in part) == pytest.approx(float(total[0]))
    grand = [r for r in result if r["level"] == 7]
    assert len(grand) == 1 and grand[0]["category_name"] is None


def test_queries_give_the_same_on_the_common_grain(joined, rows):
    results = cube.run_all(joined)
    for name in results:
        assert rows(results[name]) == rows(getattr(cube, name)(joined)), name
    assert rows(cube.quarterly_trend(joined)) == [(2024, 1, 25.4), (2024, 2, 100.0), (2025, 1, 159.0)]
    assert dict(rows(cube.result_sizes(results)))["revenue_by_region"] == 2


def test_calendar_from_key_equals_the_time_dimension(sales, rows):
    items, orders = sales
    fact = star.fact_sales(items, orders)
    columns = ["order_item_id", *cube.CALENDAR]
    assert rows(cube.star_join(fact), *columns) == rows(cube.star_join(fact, time=star.dim_time(orders)), *columns)


def test_core_measures(sales, joined):
    assert measures.core_measures(joined).first().asDict() == {
        "total_revenue": 284.4, "total_units": 9, "total_transactions": 6, "average_order_value": pytest.approx(284.4 / 5)}
    nothing = measures.core_measures(joined.limit(0)).first()
    assert nothing["average_order_value"] == 0.0 and nothing["total_transactions"] == 0


def test_rank_share_and_top(spark, rows):
    totals = spark.createDataFrame([("a", 5.0), ("b", 5.0), ("c", 1.0), ("d", 9.0)], "name string, revenue double")
    assert rows(measures.revenue_rank(totals), "name", "revenue_rank") == [("a", 2), ("b", 2), ("c", 4), ("d", 1)]
    assert measures.top_row(totals, "name").first()["name"] == "d"
    assert rows(measures.revenue_share(totals), "name", "share") == [("a", 0.25), ("b", 0.25), ("c", 0.05), ("d", 0.45)]


def test_ranks_leave_gaps_after_ties(spark, rows):
    totals = spark.createDataFrame([("a", 5.0), ("b", 5.0), ("c", 1.0), ("d", 9.0), ("e", None), ("f", None)], "name string, revenue double")
    assert rows(ranked(totals, "revenue", "r"), "name", "r") == [
        ("a", 2), ("b", 2), ("c", 4), ("d", 1), ("e", 5), ("f", 5)]


@pytest.fixture(scope="module")
def daily(spark):
    days = [(date(2023, 3, 1), "10"), (date(2024, 2, 28), "1"), (date(2024, 2, 29), "2"), (date(2024, 3, 1), "4"),
            (date(2024, 8, 1), "8"), (date(2024, 8, 1), "8"), (date(2025, 2, 28), "32")]
    return spark.createDataFrame([(d, Decimal(v)) for d, v in days], "order_date date, revenue decimal(28,2)")


def test_year_to_date_restarts_each_year(daily, rows):
    assert [r[2] for r in sorted(rows(measures.year_to_date(daily)))] == [10.0, 1.0, 3.0, 7.0, 23.0, 32.0]


def test_quarter_change_does_not_skip_missing_quarters(daily, rows):
    got = {r[0].isoformat(): r[1:] for r in rows(measures.quarter_over_quarter(daily))}
    # the second quarter of 2024 has no sales, so the third has no predecessor
    assert got == {"2023-01-01": (10.0, None, 0.0), "2024-01-01": (7.0, None, 0.0), "2024-07-01": (16.0, None, 0.0),
                   "2025-01-01": (32.0, None, 0.0)}
    filled = daily.unionByName(daily.limit(1).select(F.lit(date(2024, 5, 1)).alias("order_date"), F.lit("14").cast("decimal(28,2)").alias("revenue")))
    changed = {r[0].isoformat(): r[3] for r in rows(measures.quarter_over_quarter(filled))}
    assert changed["2024-04-01"] == 1.0 and changed["2024-07-01"] == pytest.approx(2 / 14)


def test_same_day_last_year(daily, rows):
    got = {r[0].isoformat(): r[2] for r in rows(measures.same_period_last_year(daily))}
    assert got["2024-03-01"] == 10.0 and got["2025-02-28"] == 1.0 and got["2024-08-01"] is None


def test_prepared_batch(spark, rows):
    names = ["  Blue Shirt ", "Red Jeans", " Green Dress", "White Shoes  ", "Black Cap", "Ghost", None]
    data = list(zip([101, 102, 103, 104, 105, None, 8001], names, [2010, 2016, 2015, 2013, 2020, 2019, None]))
    df = spark.createDataFrame(data, "id long, productDisplayName string, year int")
    assert rows(etl.prepare_batch(df)) == [
        (101, "Blue Shirt", 2010, 400, False), (102, "Red Jeans", 2016, 401, True), (103, "Green Dress", 2015, 402, True),
        (104, "White Shoes", 2013, 403, False), (105, "Black Cap", 2020, 404, True), (8001, None, None, 300, False)]
    assert etl.prepare_batch(df.limit(0)).columns == ["id", "productDisplayName", "year", "price_estimate", "is_recent"]
    assert df.count() == 7


def test_merged_sources_fill_gaps_with_zero(spark, rows):
    catalog = spark.createDataFrame([catalog_row(1, article="t-shirts"), catalog_row(2, category="Footwear")], CATALOG)
    inventory = spark.sql("SELECT 1L AS id, 2 AS stock_qty, current_timestamp() AS updated_at")
    reviews = spark.sql("SELECT 2L AS product_id, 1.4D AS rating, 2 AS review_count")
    merged = etl.merge_sources(catalog, inventory, reviews)
    assert len(merged.columns) == 14
    assert rows(merged, "product_id", "articleType", "stock_qty", "rating", "review_count") == [
        (1, "T-Shirts", 2, 0.0, 0), (2, "Shirts", 0, 1.4, 2)]
    assert rows(etl.merge_sources(catalog, inventory), "product_id", "rating", "review_count") == [(1, 0.0, 0), (2, 0.0, 0)]
    assert rows(etl.category_rollup(merged)) == [("Apparel", 1, 2.0, 0.0, 0), ("Footwear", 1, 0.0, 1.4, 2)]
    assert rows(etl.category_variety(catalog)) == [("Apparel", 1, 1, 1), ("Footwear", 1, 1, 1)]


def test_steps_stop_at_the_first_failure(spark):
    ran = []
    report = steps.run_steps(spark, [("a", lambda: ran.append("a")), ("b", lambda: 1 / 0), ("c", lambda: ran.append("c"))])
    assert [(r["step"], r["status"]) for r in report.collect()] == [("a", "OK"), ("b", "FAILED"), ("c", "SKIPPED")]
    assert ran == ["a"]


def test_a_quarter_reads_the_months_it_has(spark, tmp_path, plan):
    fact = spark.range(3_000).select(F.col("id").alias("order_id"), date_key(F.date_add(F.lit("1997-01-01").cast("date"), (F.col("id") % 700).cast("int"))).alias("time_id"))
    star.write_by_month(fact, f"{tmp_path}/fact")
    orders = spark.range(700).select(F.date_add(F.lit("1997-01-01").cast("date"), F.col("id").cast("int")).alias("order_date"))
    time = materialise(star.dim_time(orders), "time")
    stored = spark.read.parquet(f"{tmp_path}/fact")
    quarter = star.sales_of_days(stored, time.filter("year = 1997 AND quarter = 2"))
    assert "dynamicpruning" in plan(quarter).lower()
    assert quarter.count() == fact.filter("time_id BETWEEN 19970401 AND 19970630").count() > 0
    assert star.sales_of_days(stored, time).count() == 3_000
    assert "time_id" in quarter.columns and "month_id" not in quarter.columns


def test_lines_are_shuffled_without_their_revenue(spark, plan):
    items = spark.range(1_000).selectExpr("id AS order_item_id", "id % 100 AS order_id", "id AS product_id", "1L AS store_id",
                                          "CAST(id % 7 AS DOUBLE) AS quantity", "1.25 * id AS unit_price")
    orders = spark.range(100).selectExpr("id AS order_id", "id AS customer_id", "DATE'2024-05-01' AS order_date")
    fact = star.fact_sales(items.hint("merge"), orders)
    shuffles = plan(fact).split("SortMergeJoin")[1].count("AS revenue_cents")
    assert "SortMergeJoin" in plan(fact) and shuffles == 0
    assert {r.time_id for r in fact.select("time_id").collect()} == {20240501} and fact.count() == 1_000


def test_published_tables_and_positions_are_written_small(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "small"))
    table.replace(spark.range(1_000))
    keyed = PublishedTable(spark, str(tmp_path / "keyed"), key=["id"], buckets=4)
    keyed.replace(spark.range(1_000))
    files = [f for t in (table.read(), keyed.read(), with_positions(spark.range(1_000), ["id"])) for f in t.inputFiles()]
    assert sum(f.endswith(".zstd.parquet") for f in files) >= 6
    assert table.read().count() == keyed.read().count() == 1_000


def test_steps_in_a_list_run_at_the_same_time(spark):
    both = threading.Barrier(2, timeout=60)  # one alone would wait in vain
    report = steps.run_steps(spark, [[("a", both.wait), ("b", both.wait)], [("c", lambda: 1 / 0), ("d", lambda: 7)],
                                     [("e", lambda: 1), ("f", lambda: 1)], ("g", lambda: 1)])
    found = [(r["step"], r["status"]) for r in report.collect()]
    assert found == [("a", "OK"), ("b", "OK"), ("c", "FAILED"), ("d", "OK"), ("e", "SKIPPED"), ("f", "SKIPPED"), ("g", "SKIPPED")]
    assert {r["step"]: r["detail"] for r in report.collect()}["d"] == "7"


def test_sales_are_recorded_while_the_catalogue_is_cleaned(spark, tmp_path):
    """The build: cleaning waits for the sales to begin, so neither may come first as a whole."""
    begun, cleaning = threading.Event(), threading.Event()
    built = warehouse.Warehouse(spark, str(tmp_path))
    built.record_sales = lambda s: begun.set() or cleaning.wait(60) and 5
    built.clean = lambda s: cleaning.set() or begun.wait(60) or 1 / 0
    for name in ("engineer", "merge", "load_new", "track", "analyse", "export", "validate", "upsert"):
        setattr(built, name, lambda *given: 1)
    built.model = lambda sales: sales()
    found = {r["step"]: (r["status"], r["detail"]) for r in warehouse.build(built, None, "run").collect()}
    assert found["clean"] == ("OK", "True") and found["model"] == ("OK", "5") and len(found) == 10
    built.record_sales = lambda s: 1 / 0
    found = {r["step"]: r["status"] for r in warehouse.build(built, None, "run").collect()}
    assert found["track"] == "OK" and found["model"] == "FAILED" and found["analyse"] == found["upsert"] == "SKIPPED"
    built.record_sales, built.validate = lambda s: 5, lambda run_id: 1 / 0
    found = {r["step"]: r["status"] for r in warehouse.build(built, None, "run").collect()}
    assert found["validate"] == "FAILED" and found["export"] == "OK" and found["upsert"] == "SKIPPED"
