"""Cleaning, dedupe and key operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import clean, combine, dedupe, ids, lookup, sampling
from tidemark.suite import inputs
from tidemark.suite.inputs import CATALOG_SQL, CLEAN_SQL, RAW_SQL
from tidemark.suite.registry import query

# Title case in SQL: a letter is upper-case when no letter stands before it.
TITLE_SQL = """array_to_string(list_transform(generate_series(1, length({0})), lambda i:
  CASE WHEN i > 1 AND regexp_matches({0}[i - 1], '\\p{{L}}') THEN lower({0}[i]) ELSE upper({0}[i]) END), '')"""


@query("clean_catalog", f"WITH {CLEAN_SQL} SELECT * FROM clean")
def clean_catalog(spark, sf):
    return clean.clean_catalog(inputs.raw_catalog(spark, sf), ["delivery"])


@query("clean_report", f"""WITH {CLEAN_SQL}
SELECT 'rows_before' AS metric, count(*) AS value FROM raw_catalog UNION ALL
SELECT 'missing_id', count(*) - count(id) FROM raw_catalog UNION ALL
SELECT 'missing_gender', count(*) - count(gender) FROM raw_catalog UNION ALL
SELECT 'missing_masterCategory', count(*) - count(masterCategory) FROM raw_catalog UNION ALL
SELECT 'missing_subCategory', count(*) - count(subCategory) FROM raw_catalog UNION ALL
SELECT 'missing_articleType', count(*) - count(articleType) FROM raw_catalog UNION ALL
SELECT 'missing_baseColour', count(*) - count(baseColour) FROM raw_catalog UNION ALL
SELECT 'missing_season', count(*) - count(season) FROM raw_catalog UNION ALL
SELECT 'missing_year', count(*) - count(year) FROM raw_catalog UNION ALL
SELECT 'missing_usage', count(*) - count(usage) FROM raw_catalog UNION ALL
SELECT 'missing_productDisplayName', count(*) - count(productDisplayName) FROM raw_catalog UNION ALL
SELECT 'missing_delivery', count(*) - count(delivery) FROM raw_catalog UNION ALL
SELECT 'rows_named', count(*) FROM named UNION ALL
SELECT 'duplicates_removed', (SELECT count(*) FROM repaired) - (SELECT count(*) FROM firsts) UNION ALL
SELECT 'noisy_rows_removed', (SELECT count(*) FROM firsts) - (SELECT count(*) FROM clean) UNION ALL
SELECT 'rows_after', count(*) FROM clean""")
def clean_report(spark, sf):
    return clean.cleaning_report(inputs.raw_catalog(spark, sf), ["delivery"])


@query("drop_null_rows", f"WITH {RAW_SQL} SELECT id, delivery, productDisplayName FROM raw_catalog WHERE productDisplayName IS NOT NULL")
def drop_null_rows(spark, sf):
    return clean.drop_null_rows(inputs.raw_catalog(spark, sf), ["productDisplayName"]).select(
        "id", "delivery", "productDisplayName")


@query("fill_constants", f"""WITH {CATALOG_SQL} SELECT id, coalesce(baseColour, 'Unknown') AS baseColour,
  coalesce(season, 'Unknown') AS season, coalesce(usage, 'Unknown') AS usage FROM catalog""")
def fill_constants(spark, sf):
    filled = clean.fill_constants(inputs.catalog(spark, sf), {c: "Unknown" for c in ("baseColour", "season", "usage")})
    return filled.select("id", "baseColour", "season", "usage")


@query("fill_median", f"""WITH {CATALOG_SQL}
SELECT id, coalesce(year, (SELECT CAST(trunc(median(year)) AS INTEGER) FROM catalog)) AS year FROM catalog""")
def fill_median(spark, sf):
    return clean.fill_median(inputs.catalog(spark, sf), "year").select("id", "year")


@query("range_filter", f"WITH {CATALOG_SQL} SELECT id, year FROM catalog WHERE year BETWEEN 1990 AND 2026")
def range_filter(spark, sf):
    return clean.keep_range(inputs.catalog(spark, sf), "year", 1990, 2026).select("id", "year")


@query("standardise_text", f"""SELECT o_orderkey, {TITLE_SQL.format('trim(o_orderpriority)')} AS o_orderpriority FROM orders""")
def standardise_text(spark, sf):
    orders = inputs.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return clean.standardise_text(orders, ["o_orderpriority", "not_a_column"])


@query("dedupe_keep_first", """SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""")
def dedupe_keep_first(spark, sf):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    first = dedupe.first_per_key(inputs.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return inputs.with_day(first, "l_shipdate")


@query("dedupe_per_file", """SELECT doc_id, source AS source_file, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY source, text ORDER BY doc_id) = 1""")
def dedupe_per_file(spark, sf):
    documents = inputs.table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("source_file"), "n_chars", dedupe.content_key(["text"]).alias("content"))
    return dedupe.first_per_key_in_file(documents, ["content"], ["doc_id"]).drop("content")


@query("duplicate_count", """SELECT CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS duplicate_count
FROM lineitem""")
def duplicate_count(spark, sf):
    return dedupe.duplicate_count(inputs.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("distinct_values", "SELECT DISTINCT p_brand FROM part")
def distinct_values(spark, sf):
    return dedupe.distinct_values(inputs.table(spark, sf, "part"), "p_brand")


@query("distinct_tuples", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_tuples(spark, sf):
    return dedupe.distinct_tuples(inputs.table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query("lookup_map", """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, coalesce(s_name, 'none') AS store_name
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal >= 0""")
def lookup_map(spark, sf):
    lines = inputs.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    known = inputs.table(spark, sf, "supplier").filter("s_acctbal >= 0")
    return lookup.map_values(lines, "l_suppkey", known, "s_suppkey", "s_name", "store_name", default=F.lit("none"))


@query("semi_affected_keys", """SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def semi_affected_keys(spark, sf):
    returned = inputs.table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return inputs.with_day(lookup.keep_keys(inputs.table(spark, sf, "orders"), returned, "o_orderkey"), "o_orderdate")


@query("anti_unprocessed", """SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def anti_unprocessed(spark, sf):
    shipped = inputs.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return inputs.with_day(lookup.drop_keys(inputs.table(spark, sf, "orders"), shipped, "o_orderkey"), "o_orderdate")


@query("delete_by_key", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')""")
def delete_by_key(spark, sf):
    gone = inputs.table(spark, sf, "part").filter("p_type = 'PROMO'").select(F.col("p_partkey").alias("l_partkey"))
    lines = inputs.table(spark, sf, "lineitem")
    return lookup.drop_keys(lines, gone, "l_partkey", unique=True).select("l_orderkey", "l_linenumber", "l_quantity")


@query("fk_orphans", """SELECT 'lineitem_orders' AS relation, count(DISTINCT l_orderkey) AS orphan_keys, count(*) AS orphan_rows
  FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL
SELECT 'open_orders_of_creditors', count(DISTINCT o_custkey), count(*) FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) UNION ALL
SELECT 'supplier_nation', count(DISTINCT s_nationkey), count(*) FROM supplier
  WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation)""")
def fk_orphans(spark, sf):
    t = lambda name: inputs.table(spark, sf, name)
    return lookup.orphan_report([
        ("lineitem_orders", t("lineitem"), "l_orderkey", t("orders"), "o_orderkey"),
        ("open_orders_of_creditors", t("orders"), "o_custkey", t("customer").filter("c_acctbal >= 0"), "c_custkey"),
        ("supplier_nation", t("supplier"), "s_nationkey", t("nation"), "n_nationkey"),
    ])


@query("overwrite_slice", """SELECT l_orderkey, l_linenumber, l_quantity,
  CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01' THEN 'X' ELSE l_returnflag END AS l_returnflag
FROM lineitem""")
def overwrite_slice(spark, sf):
    lines = inputs.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    in_year = (F.col("l_shipdate") >= "1998-01-01") & (F.col("l_shipdate") < "1999-01-01")
    return combine.overwrite_where(lines, in_year, {"l_returnflag": F.lit("X")}).drop("l_shipdate")


@query("add_missing_columns", """SELECT s_suppkey, s_name, 0.0::DOUBLE AS rating, 2020 AS catalog_year FROM supplier""")
def add_missing_columns(spark, sf):
    stores = inputs.table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return combine.add_missing_columns(stores, {"s_name": F.lit("?"), "rating": F.lit(0.0), "catalog_year": F.lit(2020)})


@query("union_batches", """SELECT l_orderkey AS order_id, CAST(l_shipdate AS DATE) AS happened FROM lineitem
UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE) FROM orders""")
def union_batches(spark, sf):
    shipped = inputs.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("happened"))
    ordered = inputs.table(spark, sf, "orders").select(F.col("o_orderdate").alias("happened"), F.col("o_orderkey").alias("order_id"))
    return inputs.with_day(combine.union_all([shipped, ordered]), "happened")


@query("set_difference", """SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'
EXCEPT ALL SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'""")
def set_difference(spark, sf):
    lines = inputs.table(spark, sf, "lineitem")
    pair = ["l_partkey", "l_suppkey"]
    return combine.rows_only_in(lines.filter("l_returnflag = 'R'").select(*pair), lines.filter("l_returnflag = 'A'").select(*pair))


@query("surrogate_keys", """SELECT row_number() OVER (ORDER BY c_mktsegment, c_nationkey) AS segment_id, c_mktsegment, c_nationkey
FROM (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer)""")
def surrogate_keys(spark, sf):
    return ids.surrogate_keys(inputs.table(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"], "segment_id")


@query("append_new_ids", """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS happened FROM orders UNION ALL
SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey),
  CAST(l_shipdate AS DATE) FROM lineitem""")
def append_new_ids(spark, sf):
    have = inputs.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("happened"))
    new = inputs.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("happened"), "l_linenumber", "l_partkey", "l_suppkey")
    all_rows = ids.append_with_new_ids(have, new, "id", ["happened", "id", "l_linenumber", "l_partkey", "l_suppkey"])
    return inputs.with_day(all_rows, "happened")


@query("sample_with_replacement", """WITH placed AS (SELECT *, row_number() OVER (ORDER BY event_id) AS place FROM events),
draws AS (SELECT i AS draw, CAST('0x' || substr(md5('7:' || i), 1, 15) AS BIGINT) % (SELECT count(*) FROM events) + 1 AS place
  FROM range(1, 3001) t(i))
SELECT draw, event_id, user_id, event_type, value FROM draws JOIN placed USING (place)""")
def sample_with_replacement(spark, sf):
    events = inputs.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return sampling.sample_with_replacement(events, ["event_id"], 3_000, seed=7)


@query("seeded_sample", "SELECT * EXCLUDE (ts) FROM events ORDER BY md5(concat_ws(':', 7, event_id)), event_id LIMIT 500")
def seeded_sample(spark, sf):
    return sampling.sample_rows(inputs.table(spark, sf, "events"), ["event_id"], 500, seed=7).drop("ts")


@query("last_rows", """SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10""")
def last_rows(spark, sf):
    return inputs.with_day(combine.last_rows(inputs.table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 10), "o_orderdate")
