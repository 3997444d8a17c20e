"""Source queries: the data is written by Spark from a driver table and read back through each reader."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import days_between
from tidemark.operators.ids import with_positions
from tidemark.session import drop_path, materialise, scratch_path
from tidemark.sources import delimited, documents, fallback, inventory, listing, paged
from tidemark.sinks.files import create_views
from tidemark.sinks.published import PublishedTable
from tidemark.suite import inputs
from tidemark.suite.inputs import CLEAN_SQL, GENDER
from tidemark.suite.registry import query


@query("scan_csv_ragged", """SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'P' THEN 'P,"x"' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderstatus = 'F' OR o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderpriority <> '5-LOW'""")
def scan_csv_ragged(spark, sf):
    """Low-priority lines have a field too many, status F lines one too few, some fields are quoted."""
    lines = inputs.table(spark, sf, "orders").select(F.concat_ws(
        ",", "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") == "P", '"P,""x"""').otherwise(F.col("o_orderstatus")),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("5-LOW,more"))
        .when(F.col("o_orderstatus") == "F", F.lit(None))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("N/A"))
        .otherwise(F.col("o_orderpriority")),
    ))
    path = scratch_path(spark, "ragged")
    lines.write.text(path)
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"
    return delimited.read_lenient(spark, path, T.StructType.fromDDL(schema), quoted_breaks=False)


@query("scan_csv_quoted_breaks", """SELECT doc_id, nullif(text, '') AS text, CASE WHEN doc_id % 5 <> 0 THEN lang END AS lang
FROM documents WHERE doc_id % 7 <> 0""")
def scan_csv_quoted_breaks(spark, sf):
    """Whole texts with their line breaks and quotes in quoted fields; some records have a field too many, some one too few."""
    text = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    fields = F.concat_ws(",", "doc_id", F.coalesce(text, F.lit("")), F.when(F.col("doc_id") % 5 != 0, F.coalesce("lang", F.lit(""))),
                         F.when(F.col("doc_id") % 7 == 0, F.lit("more,\"and\nmore\"")))
    path = scratch_path(spark, "quoted")
    inputs.table(spark, sf, "documents").select(fields).write.text(path)
    return delimited.read_lenient(spark, path, T.StructType.fromDDL("doc_id long, text string, lang string"), na_texts=[])


@query("scan_folder", f"""WITH {CLEAN_SQL}
SELECT id, gender, masterCategory, subCategory, articleType, trim(coalesce(baseColour, 'Unknown')) AS baseColour,
  trim(coalesce(season, 'Unknown')) AS season, year, trim(coalesce(usage, 'Unknown')) AS usage,
  trim(productDisplayName) AS productDisplayName, true AS from_csv
FROM raw_catalog QUALIFY row_number() OVER (PARTITION BY id ORDER BY delivery) = 1""")
def scan_folder(spark, sf):
    raw = inputs.raw_catalog(spark, sf)
    path = scratch_path(spark, "folder")
    # all deliveries of a product lie in one file
    raw.repartition("id").write.option("header", True).csv(path)
    texts = ["gender", "masterCategory", "subCategory", "articleType", "baseColour", "season", "usage", "productDisplayName"]
    rows = delimited.read_folder(spark, path, raw.schema, "id", ["delivery"], texts, ["baseColour", "season", "usage"])
    return rows.withColumn("from_csv", F.col("source_file").endswith(".csv")).drop("source_file", "delivery")


@query("scan_documents_json", "SELECT c_custkey AS product_id, c_name AS product_name, c_acctbal AS rating, c_nationkey AS review_count FROM customer")
def scan_documents_json(spark, sf):
    """Collections of up to 500 documents, one collection per line."""
    size = 500
    entry = F.struct(F.col("c_custkey").cast("string").alias("key"), F.struct(
        F.col("c_custkey").alias("product_id"), F.col("c_name").alias("product_name"),
        F.col("c_acctbal").alias("rating"), F.col("c_nationkey").alias("review_count")).alias("value"))
    grouped = (
        inputs.table(spark, sf, "customer").groupBy(F.floor(F.col("c_custkey") / size).alias("g"))
        .agg(F.map_from_entries(F.collect_list(entry)).alias("_default"))
    )
    path = scratch_path(spark, "documents")
    grouped.select("_default").write.json(path)
    return documents.read_collection(spark, path, one_per_line=True)


@query("scan_documents_one_object", "SELECT c_custkey AS product_id, c_name AS product_name, c_acctbal AS rating, c_nationkey AS review_count FROM customer")
def scan_documents_one_object(spark, sf):
    """One file with one object on one line: two collections, of which one is asked for."""
    customers = inputs.table(spark, sf, "customer")
    document = F.to_json(F.struct(F.col("c_custkey").alias("product_id"), F.col("c_name").alias("product_name"),
                                  F.col("c_acctbal").alias("rating"), F.col("c_nationkey").alias("review_count"),
                                  F.struct(F.lit('{"no": "document"}').alias("quoted")).alias("more")))
    # pieces of the object in the order of the file, and no line ends between them
    members = customers.select(F.col("c_custkey").alias("at"), F.concat_ws(
        "", F.when(F.col("c_custkey") == customers.agg(F.min("c_custkey")).scalar(), F.lit('{"other": {"1": {"product_id": 0}}, "_default": {'))
        .otherwise(F.lit(", ")), F.lit('"'), "c_custkey", F.lit('": '), document,
        F.when(F.col("c_custkey") == customers.agg(F.max("c_custkey")).scalar(), F.lit("}}"))).alias("value"))
    path = scratch_path(spark, "object")
    members.coalesce(1).sortWithinPartitions("at").select("value").write.option("lineSep", " ").text(path)
    return documents.read_collection(spark, path)


def stored_pages(spark, sf, size):
    """Orders as the kept answers of a paged collection of `size` rows a page; behind the last page comes an empty one."""
    rows = with_positions(inputs.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"),
                          ["o_orderkey"], "place")
    row = F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    # a page has `size` rows at most
    pages = rows.groupBy(F.floor((F.col("place") - 1) / size).alias("page")).agg(F.to_json(F.collect_list(row)).alias("value"))
    end = rows.agg(F.ceil(F.count(F.lit(1)) / size).alias("page")).withColumn("value", F.lit("[]"))
    path = scratch_path(spark, "pages")
    pages.unionByName(end).write.partitionBy("page").text(path)
    return paged.StoredPages(path), T.StructType.fromDDL("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double")


@query("scan_pages", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def scan_pages(spark, sf):
    """A collection read page by page up to its empty page."""
    reader, schema = stored_pages(spark, sf, 500)
    return paged.read_pages(spark, reader, schema, 500).require_complete()


@query("scan_pages_failing", """WITH placed AS (SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // 300 AS page FROM orders)
SELECT o_orderkey, CAST(NULL AS BIGINT) AS failed_page, false AS complete FROM placed WHERE page < 4 UNION ALL SELECT NULL, 4, false""")
def scan_pages_failing(spark, sf):
    """The fifth page is gone: what comes before it is kept, the page is named and the result is not complete."""
    reader, schema = stored_pages(spark, sf, 300)
    drop_path(spark, f"{reader.path}/page=4")
    got = paged.read_pages(spark, reader, schema, 300)
    return got.rows.select("o_orderkey", F.lit(None).cast("long").alias("failed_page")).unionByName(
        got.errors.select(F.lit(None).cast("long").alias("o_orderkey"), F.col("page").alias("failed_page"))
    ).withColumn("complete", F.lit(got.complete))


@query("scan_with_fallback", "SELECT o_orderkey, o_orderstatus, 'fallback' AS mode FROM orders")
def scan_with_fallback(spark, sf):
    df, _ = fallback.read_with_fallback([
        ("live", lambda: inputs.table(spark, sf, "orders_of_an_absent_service")),
        ("fallback", lambda: inputs.table(spark, sf, "orders")),
    ])
    return df.select("o_orderkey", "o_orderstatus", "mode")


@query("scan_projected", """SELECT l_orderkey, l_extendedprice FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-04-01'""")
def scan_projected(spark, sf):
    lines = inputs.table(spark, sf, "lineitem")
    first_quarter = (F.col("l_shipdate") >= "1998-01-01") & (F.col("l_shipdate") < "1998-04-01")
    return lines.filter(first_quarter).select("l_orderkey", "l_extendedprice")


@query("source_inventory", """SELECT 'orders' AS name, 'parquet' AS type, count(*) AS row_count,
  'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns FROM orders UNION ALL
SELECT 'documents', 'text', count(*), 'doc_id,text,lang,source,n_chars' FROM documents UNION ALL
SELECT 'events', 'stream', count(*), 'event_id,ts,user_id,event_type,value,props' FROM events""")
def source_inventory(spark, sf):
    kinds = {"orders": "parquet", "documents": "text", "events": "stream"}
    return inventory.source_inventory({n: (k, inputs.table(spark, sf, n)) for n, k in kinds.items()})


@query("table_inventory", """WITH c AS (SELECT count(*) AS n FROM customer), l AS (SELECT count(*) AS n FROM labels)
SELECT 'stock_customer' AS table_name, n AS row_count, 1 AS ordinal, 'c_custkey' AS column_name, 'bigint' AS data_type FROM c UNION ALL
SELECT 'stock_customer', n, 2, 'c_name', 'string' FROM c UNION ALL SELECT 'stock_customer', n, 3, 'c_nationkey', 'int' FROM c UNION ALL
SELECT 'stock_customer', n, 4, 'c_acctbal', 'double' FROM c UNION ALL SELECT 'stock_customer', n, 5, 'c_mktsegment', 'string' FROM c UNION ALL
SELECT 'stock_labels', n, 1, 'doc_id', 'bigint' FROM l UNION ALL SELECT 'stock_labels', n, 2, 'quality', 'int' FROM l UNION ALL
SELECT 'stock_labels', n, 3, 'toxic', 'int' FROM l""")
def table_inventory(spark, sf):
    create_views(spark, {f"stock_{n}": inputs.table(spark, sf, n) for n in ("customer", "labels")})
    return inventory.table_inventory(spark, "STOCK_")


@query("table_first_rows", """SELECT 'part' AS table_name, CAST(row_number() OVER (ORDER BY p_partkey) AS INTEGER) AS position, p_partkey AS key, p_name AS name
FROM part QUALIFY position <= 5 UNION ALL
SELECT 'customer', CAST(row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS position, c_custkey, c_name FROM customer QUALIFY position <= 5""")
def table_first_rows(spark, sf):
    first = inventory.first_rows({"part": (inputs.table(spark, sf, "part"), ["p_partkey"]),
                                  "customer": (inputs.table(spark, sf, "customer"), ["c_custkey"])})
    def either(field):
        return F.coalesce(F.get_json_object("row", f"$.p_{field}"), F.get_json_object("row", f"$.c_{field}"))
    key = F.coalesce(F.get_json_object("row", "$.p_partkey"), F.get_json_object("row", "$.c_custkey")).cast("long")
    return first.select("table_name", "position", key.alias("key"), either("name").alias("name"))


@query("calendar_days", """WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT CAST(d AS DATE) AS day, CAST(d AS DATE) IN (SELECT day FROM days) AS has_orders
FROM (SELECT unnest(generate_series((SELECT min(day) FROM days), (SELECT max(day) FROM days), INTERVAL 1 DAY)) AS d)""")
def calendar_days(spark, sf):
    """Every day between the first and the last order."""
    days = inputs.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    span = days.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    every = span.select(F.explode(days_between("first", "last")).alias("day"))
    return every.join(days.withColumn("has_orders", F.lit(True)), "day", "left").na.fill({"has_orders": False})


@query("text_parts", """SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS level, substr(o_orderpriority, 3) AS label,
  printf('%08d/%s', o_orderkey, o_orderstatus) AS reference, right(o_orderpriority, 3) = 'LOW' AS is_low FROM orders""")
def text_parts(spark, sf):
    return inputs.table(spark, sf, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("level"), F.expr("substring(o_orderpriority, 3)").alias("label"),
        F.format_string("%08d/%s", "o_orderkey", "o_orderstatus").alias("reference"), F.col("o_orderpriority").endswith("LOW").alias("is_low"))


@query("listing_page", f"""SELECT p_partkey AS id, p_type AS masterCategory, {GENDER} AS gender, p_name AS productDisplayName
FROM part WHERE p_type = 'PROMO' AND {GENDER} = 'Men' ORDER BY p_partkey LIMIT 20 OFFSET 10""")
def listing_page(spark, sf):
    rows = inputs.table(spark, sf, "part").selectExpr(
        "p_partkey AS id", "p_type AS masterCategory", f"{GENDER} AS gender", "p_name AS productDisplayName")
    return listing.list_page(rows, "id", limit=20, offset=10, masterCategory="PROMO", gender="Men")


@query("listing_after", """SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders
WHERE o_orderstatus = 'F' AND o_orderkey > 500 ORDER BY o_orderkey LIMIT 100""")
def listing_after(spark, sf):
    page = listing.list_after(inputs.table(spark, sf, "orders"), "o_orderkey", 500, o_orderstatus="F")
    return inputs.with_day(page, "o_orderdate")


@query("point_lookup", """SELECT o_custkey AS c_custkey, c_name, c_name IS NOT NULL AS found
FROM (SELECT DISTINCT o_custkey FROM orders) LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey""")
def point_lookup(spark, sf):
    keys = inputs.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    solvent = inputs.table(spark, sf, "customer").filter("c_acctbal >= 0").select("c_custkey", "c_name")
    return listing.find_keys(solvent, keys, "c_custkey")


@query("listing_deep_page", """SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders ORDER BY o_orderkey
LIMIT 50 OFFSET (SELECT count(*) - 75 FROM orders)""")
def listing_deep_page(spark, sf):
    """A page near the end, through the borders of pages that were noted before."""
    orders = inputs.table(spark, sf, "orders")
    borders = materialise(listing.page_borders(orders, "o_orderkey", 1_000), "borders")
    return inputs.with_day(listing.page_between_borders(orders, borders, "o_orderkey", 50, orders.count() - 75), "o_orderdate")


@query("point_lookup_published", """SELECT c_custkey, c_name, c_name IS NOT NULL AS found
FROM (SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_orderstatus = 'P') LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) USING (c_custkey)""")
def point_lookup_published(spark, sf):
    table = PublishedTable(spark, scratch_path(spark, "customers"), key=["c_custkey"], buckets=64)
    table.replace(inputs.table(spark, sf, "customer").filter("c_acctbal >= 0").select("c_custkey", "c_name"))
    wanted = inputs.table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return listing.find_published(table, wanted)
