"""The whole build: raw catalogue to published tables, cube results and reports.

Every step reads what earlier steps published, so a failed run can be repeated
and readers see complete tables only.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import features, profile, quality
from tidemark.operators.clean import clean_catalog, cleaning_report
from tidemark.plans import cube, etl, star
from tidemark.plans.steps import run_steps
from tidemark.session import run_together
from tidemark.sinks import files, loads
from tidemark.sinks.published import Constraints, PublishedTable
from tidemark.sinks.snapshots import track_changes


STAR_TABLES = ["fact_sales", "dim_product", "dim_customer", "dim_store", "dim_time", "snowflake_dim_category",
               "snowflake_dim_subcategory", "snowflake_dim_article_type", "snowflake_dim_product"]
NORMAL_TABLES = ["normal_products", "normal_categories", "normal_sub_categories", "normal_article_types",
                 "normal_customers", "normal_stores", "normal_orders", "normal_order_items"]


@dataclass(frozen=True)
class Sources:
    """Inputs of a build. `order_by` decides which of several rows of a product is the first.

    `sales_orders` has order_id, customer_id and order_date; `sales_items` has
    order_item_id, order_id, product_id, store_id, quantity and unit_price, and may be a
    function, which is called when they are published; `stores` has store_id and region.
    """

    catalog: DataFrame
    order_by: list[str]
    inventory: DataFrame
    reviews: DataFrame | None
    customers: DataFrame
    stores: DataFrame
    sales_orders: DataFrame
    sales_items: DataFrame | Callable[[], DataFrame]


class Warehouse:
    """Tables below `root/tables`, reports and exports next to them."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 32):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def table(self, name: str, **options) -> PublishedTable:
        return PublishedTable(self.spark, f"{self.root}/tables/{name}", **options)

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    def _publish(self, name: str, df: DataFrame, **options) -> int:
        return self.table(name, **options).replace(df)["rows_written"]

    def _publish_all(self, tables: dict[str, DataFrame]) -> dict[str, int]:
        return run_together(self.spark, {name: partial(self._publish, name, df) for name, df in tables.items()})

    def _report(self, name: str, df: DataFrame, single: bool = True) -> None:
        files.write_report(df, f"{self.root}/reports/{name}", single)

    def clean(self, s: Sources) -> int:
        self._report("cleaning", cleaning_report(s.catalog, s.order_by))
        keep = [c for c in s.catalog.columns if c not in s.order_by or c in quality.CATALOG_COLUMNS]
        return self._publish("catalog", clean_catalog(s.catalog, s.order_by).select(*keep),
                             constraints=loads.PRODUCT_CONSTRAINTS)

    def engineer(self) -> int:
        catalog = self.read("catalog")
        self._report("summary", profile.summary_rows(
            catalog, ["articleType", "baseColour"], ["masterCategory", "gender", "usage"], "year"), single=False)
        return self._publish("features", features.engineer_catalog(catalog))

    def merge(self, s: Sources) -> int:
        merged = etl.merge_sources(self.read("catalog"), s.inventory, s.reviews)
        rows = self._publish("products", merged, constraints=Constraints(unique=["product_id"]))
        self._publish("category_rollup", etl.category_rollup(self.read("products")))
        return rows

    def load_new(self) -> int:
        return loads.load_incremental(self.table("products_incremental"), self.read("products"), "product_id")["rows_written"]

    def track(self) -> int:
        changes, counts = track_changes(self.table("product_snapshot"), self.read("products"), "product_id")
        self._report("changes", counts)
        return changes.count()

    def record_sales(self, s: Sources) -> int:
        """The tables of the model that need no catalogue; returns the rows of the facts."""
        items = s.sales_items() if callable(s.sales_items) else s.sales_items
        self._publish_all({
            "normal_customers": s.customers, "normal_stores": s.stores, "normal_orders": s.sales_orders,
            "normal_order_items": items, "dim_customer": s.customers, "dim_store": s.stores,
            "dim_time": star.dim_time(s.sales_orders),
        })
        return self._publish("fact_sales", star.fact_sales(self.read("normal_order_items"), s.sales_orders))

    def model(self, sales: Callable[[], int]) -> int:
        """`sales` gives the outcome of `record_sales`, which may run before or meanwhile."""
        tables = star.normalise(self.read("products"))
        self._publish_all({
            "normal_products": tables.products, "normal_categories": tables.master_categories,
            "normal_sub_categories": tables.sub_categories, "normal_article_types": tables.article_types,
        })
        tables = star.NormalForm(self.read("normal_categories"), self.read("normal_sub_categories"),
                                 self.read("normal_article_types"), self.read("normal_products"))
        self._publish_all({"dim_product": star.dim_product(tables), **star.snowflake_tables(tables)})
        return sales()

    def analyse(self) -> int:
        sales = cube.star_join(self.read("fact_sales"), self.read("dim_product"), self.read("dim_store"))
        results = cube.run_all(sales)
        files.export_tables(results, f"{self.root}/cube")
        self._report("cube_previews", cube.previews(results))
        return len(results)

    def export(self) -> int:
        return len(files.export_tables({n: self.read(n) for n in STAR_TABLES + NORMAL_TABLES}, f"{self.root}/export"))

    def validate(self, run_id: str) -> int:
        _, report = quality.stage_and_validate(self.read("catalog"), run_id, f"{self.root}/staging")
        return report["row_count"]

    def upsert(self, run_id: str) -> int:
        table = self.table("products_resilient", key=["id"], buckets=self.buckets)
        done = loads.load_upsert(table, self.read("catalog"), run_id)
        loads.log_run(self.spark, f"{self.root}/run_log", run_id, done["rows_in_batch"])
        return done["net_new_rows"]


def build(warehouse: Warehouse, s: Sources, run_id: str) -> DataFrame:
    """Run all steps; the report has one row per step with the rows (or results) it produced.

    Sales are recorded while the catalogue goes through its steps, and the steps that
    only read what these left run together: many jobs of a build are too small for a
    whole cluster, or end with few tasks. Rows are upserted only if all of them went well.
    """
    w = warehouse
    with ThreadPoolExecutor(1) as pool:
        sales = pool.submit(inheritable_thread_target(w.spark)(w.record_sales), s)
        return run_steps(w.spark, [
            ("clean", lambda: w.clean(s)),
            ("engineer", w.engineer),
            ("merge", lambda: w.merge(s)),
            ("load_new", w.load_new),
            ("track", w.track),
            ("model", lambda: w.model(sales.result)),
            [
                ("analyse", w.analyse),
                ("export", w.export),
                ("validate", lambda: w.validate(run_id)),
            ],
            ("upsert", lambda: w.upsert(run_id)),
        ])
