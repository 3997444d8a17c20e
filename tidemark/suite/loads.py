"""Loads into published tables and file outputs, read back for comparison."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.operators import clean, merge, quality
from tidemark.session import scratch_path
from tidemark.sinks import files, loads
from tidemark.sinks.published import Constraints, PublishedTable, PublishRejected, RangedTable
from tidemark.sinks.snapshots import track_changes
from tidemark.sources.delimited import read_typed
from tidemark.sources.documents import read_report
from tidemark.suite import inputs
from tidemark.suite.inputs import CLEAN_SQL, RAW_SQL
from tidemark.suite.registry import query
from tidemark.suite.tracking import _COLUMNS, _after, _before

_MID = "TIMESTAMP '2024-01-16'"


def _new_table(spark, name, **options):
    return PublishedTable(spark, scratch_path(spark, name), **options)


@query("load_full_verify", "SELECT count(*) AS rows_loaded, count(*) AS rows_verified, true AS match FROM lineitem")
def load_full_verify(spark, sf):
    result = loads.load_and_verify(_new_table(spark, "full"), inputs.table(spark, sf, "lineitem"))
    return spark.createDataFrame([result], "rows_loaded long, rows_verified long, match boolean")


@query("load_full", "SELECT l_returnflag, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY 1")
def load_full(spark, sf):
    table = _new_table(spark, "full")
    loads.load_full(table, inputs.table(spark, sf, "lineitem"))
    return table.read().groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"))


@query("load_incremental", f"""SELECT event_id, user_id, event_type, value FROM events
WHERE ts < {_MID} OR event_id > (SELECT max(event_id) FROM events WHERE ts < {_MID})""")
def load_incremental(spark, sf):
    events = inputs.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    table = _new_table(spark, "incremental")
    for batch in (events.filter(F.col("ts") < "2024-01-16"), events, events):
        loads.load_incremental(table, batch.drop("ts"), "event_id")
    return table.read()


@query("load_incremental_steps", f"""WITH a AS (SELECT count(*) AS n, max(event_id) AS top FROM events WHERE ts < {_MID}),
b AS (SELECT count(*) AS n, max(event_id) AS top FROM events WHERE event_id > (SELECT top FROM a))
SELECT 1 AS step, CAST(NULL AS BIGINT) AS prev_watermark, n AS rows_written FROM a UNION ALL
SELECT 2, (SELECT top FROM a), n FROM b UNION ALL SELECT 3, top, 0 FROM b""")
def load_incremental_steps(spark, sf):
    events = inputs.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    table, rows = _new_table(spark, "incremental"), []
    for step, batch in enumerate((events.filter(F.col("ts") < "2024-01-16"), events, events), 1):
        done = loads.load_incremental(table, batch, "event_id")
        rows.append((step, done["prev_watermark"], done["rows_written"]))
    return spark.createDataFrame(rows, "step int, prev_watermark long, rows_written long")


@query("upsert_twice", """SELECT o_orderkey, o_orderstatus, o_orderpriority, o_custkey,
  CASE WHEN o_orderpriority = '5-LOW' AND o_orderdate < TIMESTAMP '1996-01-01' THEN 'run-0' ELSE 'run-2' END AS loaded_by_run
FROM (SELECT o_orderkey, o_orderpriority, o_custkey, o_orderdate,
  CASE WHEN o_orderpriority = '5-LOW' AND o_orderdate < TIMESTAMP '1996-01-01' THEN 'O' ELSE o_orderstatus END AS o_orderstatus FROM orders)""")
def upsert_twice(spark, sf):
    table = _new_table(spark, "upsert", key=["o_orderkey"], buckets=8)
    loads.load_upsert(table, _before(spark, sf), "run-0")
    for run in ("run-1", "run-2"):
        loads.load_upsert(table, _after(spark, sf), run)
    return table.read()


@query("idempotency_report", """WITH b AS (SELECT count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
n AS (SELECT count(*) AS n FROM orders)
SELECT 'run-0' AS run_id, CAST(0 AS BIGINT) AS row_count_before, b.n AS row_count_after, b.n AS net_new_rows FROM b UNION ALL
SELECT 'run-1', b.n, n.n, n.n - b.n FROM b, n UNION ALL SELECT 'run-2', n.n, n.n, 0 FROM n""")
def idempotency_report(spark, sf):
    table = _new_table(spark, "upsert", key=["o_orderkey"], buckets=8)
    first = loads.load_upsert(table, _before(spark, sf), "run-0")
    proof = loads.verify_idempotent(table, _after(spark, sf), ("run-1", "run-2"))
    rows = [first, proof["first_run"], proof["second_run"]]
    return spark.createDataFrame(rows, "run_id string, row_count_before long, row_count_after long, net_new_rows long")


@query("atomic_load_failed", f"""WITH {CLEAN_SQL} SELECT id, productDisplayName FROM clean""")
def atomic_load_failed(spark, sf):
    """A good load, then one with missing names and repeated ids: the good rows stay."""
    raw = inputs.raw_catalog(spark, sf)
    table = _new_table(spark, "atomic", constraints=loads.PRODUCT_CONSTRAINTS)
    loads.load_atomic(table, clean.clean_catalog(raw, ["delivery"]).select("id", "productDisplayName"))
    loads.load_atomic(table, raw.select("id", "productDisplayName"))
    return table.read()


@query("atomic_load_report", f"""WITH {CLEAN_SQL}
SELECT false AS inject_failure, 'COMMITTED' AS outcome, CAST(0 AS BIGINT) AS row_count_before, count(*) AS final_row_count FROM clean
UNION ALL SELECT true, 'ROLLED_BACK', count(*), count(*) FROM clean""")
def atomic_load_report(spark, sf):
    raw = inputs.raw_catalog(spark, sf)
    table = _new_table(spark, "atomic", constraints=loads.PRODUCT_CONSTRAINTS)
    rows = []
    for bad, batch in ((False, clean.clean_catalog(raw, ["delivery"])), (True, raw)):
        before = table.state()["rows"]
        done = loads.load_atomic(table, batch.select("id", "productDisplayName"))
        rows.append((bad, done["outcome"], before, done["final_row_count"]))
    report = spark.createDataFrame(
        rows, "inject_failure boolean, outcome string, row_count_before long, final_row_count long")
    loads.require_rollback(report)
    return report


@query("rebuild_range", """SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(*) AS n,
  CAST(sum(CASE WHEN year(l_shipdate) IN (1997, 1998) THEN l_quantity + 1 ELSE l_quantity END) AS BIGINT) AS quantity
FROM lineitem GROUP BY 1""")
def rebuild_range(spark, sf):
    """Two years are written again with corrected quantities, in one version; the others keep their files."""
    lines = inputs.table(spark, sf, "lineitem").select("l_quantity", "l_shipdate")
    table = RangedTable(spark, scratch_path(spark, "by-month"), "l_shipdate", "month")
    table.replace(lines)
    first, last = date(1997, 1, 1), date(1998, 12, 31)
    table.swap(table.between(first, last).withColumn("l_quantity", F.col("l_quantity") + 1), first, last)
    return table.read().groupBy(F.year("l_shipdate").alias("ship_year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))


@query("rebuild_range_failed", """SELECT l_orderkey, l_linenumber, l_quantity, 1 AS version FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-07-01'""")
def rebuild_range_failed(spark, sf):
    """A replay that has rows of a month it does not cover changes nothing, in any of its months."""
    lines = inputs.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    table = RangedTable(spark, scratch_path(spark, "by-month"), "l_shipdate", "month")
    table.replace(lines)
    try:
        table.swap(lines.filter(F.col("l_shipdate") >= "1997-04-01").withColumn("l_quantity", F.lit(0.0)), date(1997, 4, 1), date(1997, 6, 30))
    except PublishRejected:
        pass
    return table.between(date(1997, 3, 1), date(1997, 6, 30)).select("l_orderkey", "l_linenumber", "l_quantity").withColumn(
        "version", F.lit(table.state()["version"]))


@query("csv_round_trip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_round_trip(spark, sf):
    rows = inputs.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "csv")
    files.write_csv(rows, path)
    return read_typed(spark, path, rows.schema)


@query("export_tables", """SELECT 'fact_sales' AS table_name, count(*) AS row_count FROM lineitem UNION ALL
SELECT 'dim_time', count(DISTINCT CAST(o_orderdate AS DATE)) FROM orders UNION ALL
SELECT 'dim_store', count(*) FROM supplier UNION ALL SELECT 'dim_product', count(*) FROM part""")
def export_tables(spark, sf):
    tables = {"fact_sales": inputs.sales(spark, sf), "dim_time": inputs.time(spark, sf),
              "dim_store": inputs.store(spark, sf), "dim_product": inputs.product(spark, sf)}
    paths = files.export_tables(tables, scratch_path(spark, "export"))
    from tidemark.sources.inventory import source_inventory

    written = {name: ("csv", read_typed(spark, path, tables[name].schema)) for name, path in paths.items()}
    return source_inventory(written).select(F.col("name").alias("table_name"), "row_count")


@query("report_round_trip", f"""WITH {RAW_SQL}
SELECT count(*) AS row_count, count(*) - count(DISTINCT id) AS duplicate_count, false AS all_passed FROM raw_catalog""")
def report_round_trip(spark, sf):
    report = quality.validate(inputs.raw_catalog(spark, sf))
    path = scratch_path(spark, "report")
    files.write_report(report, path)
    return read_report(spark, path, report.schema).select("row_count", "duplicate_count", "all_passed")


@query("run_log", """SELECT 'lineitem' AS run_id, count(*) AS rows_upserted FROM lineitem UNION ALL
SELECT 'orders', count(*) FROM orders""")
def run_log(spark, sf):
    """The second run is repeated: its row is replaced."""
    path = scratch_path(spark, "run-log")
    for name in ("lineitem", "orders", "orders"):
        done = loads.load_full(_new_table(spark, name), inputs.table(spark, sf, name))
        loads.log_run(spark, path, name, done["rows_written"])
    return loads.read_run_log(spark, path).drop("ran_at")


@query("merge_other_buckets", """SELECT o_orderkey, o_orderstatus, o_orderpriority, o_custkey,
  CASE WHEN o_orderpriority = '5-LOW' AND o_orderdate < TIMESTAMP '1996-01-01' THEN 'run-0' ELSE 'run-1' END AS loaded_by_run
FROM (SELECT o_orderkey, o_orderpriority, o_custkey, o_orderdate,
  CASE WHEN o_orderpriority = '5-LOW' AND o_orderdate < TIMESTAMP '1996-01-01' THEN 'O' ELSE o_orderstatus END AS o_orderstatus FROM orders)""")
def merge_other_buckets(spark, sf):
    """A writer that asks for another number of buckets works with those that the table has."""
    path = scratch_path(spark, "rebucketed")
    loads.load_upsert(PublishedTable(spark, path, key=["o_orderkey"], buckets=8), _before(spark, sf), "run-0")
    table = PublishedTable(spark, path, key=["o_orderkey"], buckets=3)
    loads.load_upsert(table, _after(spark, sf), "run-1")
    return table.read()


@query("upsert_null_keys", """SELECT CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag END AS flag, count(*) AS n
FROM lineitem GROUP BY 1""")
def upsert_null_keys(spark, sf):
    """Upserting counts per flag twice, one flag being NULL, leaves one row per flag."""
    flags = inputs.table(spark, sf, "lineitem").groupBy(F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("flag")).agg(
        F.count(F.lit(1)).alias("n"))
    return merge.upsert(merge.upsert(flags.limit(0), flags, ["flag"]), flags, ["flag"])


@query("snapshot_tracking", """WITH b AS (SELECT count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
a AS (SELECT count(*) AS n FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderdate < TIMESTAMP '1996-01-01'))
SELECT 1 AS step, n AS inserted_count, CAST(0 AS BIGINT) AS updated_count, CAST(0 AS BIGINT) AS deleted_count, n AS total_tracked FROM b UNION ALL
SELECT 2, (SELECT count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'),
  (SELECT count(*) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' AND o_orderstatus <> 'O'
    AND NOT (o_orderpriority = '5-LOW' AND o_orderdate < TIMESTAMP '1996-01-01')),
  (SELECT count(*) FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderdate < TIMESTAMP '1996-01-01'), n FROM a UNION ALL
SELECT 3, 0, 0, 0, n FROM a""")
def snapshot_tracking(spark, sf):
    table = _new_table(spark, "snapshot", constraints=Constraints(not_null=["o_orderkey"], unique=["o_orderkey"]))
    result = None
    for step, state in enumerate((_before, _after, _after), 1):
        _, counts = track_changes(table, state(spark, sf), "o_orderkey", _COLUMNS)
        row = counts.withColumn("step", F.lit(step))
        result = row if result is None else result.unionByName(row)
    return result


@query("run_steps", """SELECT 'load' AS step, 'OK' AS status, count(*) AS n FROM orders UNION ALL
SELECT 'reject', 'FAILED', NULL UNION ALL SELECT 'never', 'SKIPPED', NULL""")
def run_steps(spark, sf):
    from tidemark.plans.steps import run_steps as run

    table = _new_table(spark, "steps", constraints=Constraints(unique=["o_custkey"]))
    free = _new_table(spark, "steps")
    orders = inputs.table(spark, sf, "orders")
    report = run(spark, [
        ("load", lambda: loads.load_full(free, orders)["rows_written"]),
        ("reject", lambda: loads.load_full(table, orders)["rows_written"]),
        ("never", lambda: None),
    ])
    return report.select("step", "status", F.col("detail").try_cast("long").alias("n"))
