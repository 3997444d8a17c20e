"""Change detection, change application and targeted repair.

The earlier state of the orders is what was known at the start of 2000: all
orders were open and old low-priority orders had not been archived yet.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import row_hash
from tidemark.operators import cdc, merge
from tidemark.session import scratch_path
from tidemark.sinks.published import PublishedTable
from tidemark.sinks.snapshots import change_log_of, track_changes, track_changes_by_digest
from tidemark.suite import inputs
from tidemark.suite.registry import query

_COLUMNS = ["o_orderstatus", "o_orderpriority", "o_custkey"]
_BEFORE_SQL = """before AS (SELECT o_orderkey, 'O' AS o_orderstatus, o_orderpriority, o_custkey FROM orders
  WHERE o_orderdate < TIMESTAMP '2000-01-01')"""
_AFTER_SQL = """after AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, o_custkey FROM orders
  WHERE NOT (o_orderpriority = '5-LOW' AND o_orderdate < TIMESTAMP '1996-01-01'))"""
_CHANGES_SQL = f"""{_BEFORE_SQL}, {_AFTER_SQL},
changes AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'INSERT'
    WHEN a.o_orderkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS op
  FROM after a FULL JOIN before b ON a.o_orderkey = b.o_orderkey
  WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus <> b.o_orderstatus)"""


def _before(spark, sf):
    early = inputs.table(spark, sf, "orders").filter(F.col("o_orderdate") < "2000-01-01")
    return early.select("o_orderkey", F.lit("O").alias("o_orderstatus"), "o_orderpriority", "o_custkey")


def _after(spark, sf):
    archived = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderdate") < "1996-01-01")
    return inputs.table(spark, sf, "orders").filter(~archived).select("o_orderkey", *_COLUMNS)


def _snapshots(spark, sf):
    return tuple(cdc.snapshot(f(spark, sf), "o_orderkey", _COLUMNS) for f in (_before, _after))


def _changes(spark, sf):
    return cdc.diff_snapshots(*_snapshots(spark, sf), "o_orderkey")


@query("cdc_row_hash", """SELECT l_orderkey, l_linenumber, l_partkey,
  md5(concat_ws('|', l_returnflag, l_linestatus, l_partkey, l_linenumber)) AS row_hash FROM lineitem""")
def cdc_row_hash(spark, sf):
    lines = inputs.table(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey",
                        row_hash(["l_returnflag", "l_linestatus", "l_partkey", "l_linenumber"]).alias("row_hash"))


@query("cdc_snapshot", """SELECT doc_id, md5(concat_ws('|', lang, source, n_chars, text)) AS row_hash FROM documents""")
def cdc_snapshot(spark, sf):
    return cdc.snapshot(inputs.table(spark, sf, "documents"), "doc_id", ["lang", "source", "n_chars", "text"])


@query("cdc_changes", f"WITH {_CHANGES_SQL} SELECT * FROM changes")
def cdc_changes(spark, sf):
    return _changes(spark, sf)


@query("cdc_changes_by_digest", f"WITH {_CHANGES_SQL} SELECT * FROM changes")
def cdc_changes_by_digest(spark, sf):
    """The changes of the second of two snapshots, found through the digests that the first has left."""
    table = PublishedTable(spark, scratch_path(spark, "snapshot"), key=["o_orderkey"], buckets=64)
    for state in (_before, _after):
        changes, _ = track_changes_by_digest(table, state(spark, sf), "o_orderkey", _COLUMNS)
    return changes


@query("cdc_counts", f"""WITH {_CHANGES_SQL}
SELECT CAST(count_if(op = 'INSERT') AS BIGINT) AS inserted_count, CAST(count_if(op = 'UPDATE') AS BIGINT) AS updated_count,
  CAST(count_if(op = 'DELETE') AS BIGINT) AS deleted_count, (SELECT count(*) FROM after) AS total_tracked FROM changes""")
def cdc_counts(spark, sf):
    before, after = _snapshots(spark, sf)
    return cdc.change_counts(cdc.diff_snapshots(before, after, "o_orderkey"), after)


@query("cdc_samples", f"""WITH {_CHANGES_SQL}
SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY op ORDER BY o_orderkey) <= 5""")
def cdc_samples(spark, sf):
    return cdc.change_samples(_changes(spark, sf), "o_orderkey")


@query("apply_changeset", f"WITH {_AFTER_SQL} SELECT * FROM after")
def apply_changeset(spark, sf):
    before, after = _before(spark, sf), _after(spark, sf)
    changes = _changes(spark, sf).join(after, "o_orderkey", "left")
    return cdc.apply_changes(before, changes, "o_orderkey")


@query("cdc_change_log", f"""WITH {_CHANGES_SQL} SELECT o_orderkey, op, 1 AS snapshot_version FROM changes UNION ALL
SELECT o_orderkey, 'INSERT', 0 FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'""")
def cdc_change_log(spark, sf):
    """The log that two comparisons have appended to."""
    table = PublishedTable(spark, scratch_path(spark, "snapshot"))
    for state in (_before, _after):
        track_changes(table, state(spark, sf), "o_orderkey", _COLUMNS)
    return change_log_of(table).read().select("o_orderkey", "op", F.col("snapshot_version").cast("int").alias("snapshot_version"))


@query("upsert_batch", """SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_orderstatus ELSE 'O' END AS o_orderstatus,
  o_orderpriority, o_custkey FROM orders""")
def upsert_batch(spark, sf):
    late = inputs.table(spark, sf, "orders").filter(F.col("o_orderdate") >= "1999-01-01").select("o_orderkey", *_COLUMNS)
    return merge.upsert(_before(spark, sf), late, ["o_orderkey"])


@query("backfill_targeted", """SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, coalesce(s.s_name, 'UNKNOWN') AS store_name,
  l.bad AND s.s_name IS NOT NULL AS backfilled
FROM (SELECT *, true AS bad FROM lineitem) l LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) s
  ON l.l_suppkey = s.s_suppkey AND l.l_returnflag = 'R'""")
def backfill_targeted(spark, sf):
    """Returned lines get their store's name; stores in debt are missing from the source of truth."""
    target = inputs.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.lit("UNKNOWN").alias("store_name"), "l_returnflag")
    truth = inputs.table(spark, sf, "supplier").filter("s_acctbal >= 0").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("store_name"))
    bad = (F.col("store_name") == "UNKNOWN") & (F.col("l_returnflag") == "R")
    return merge.backfill(target, bad, truth, "l_suppkey", ["store_name"]).drop("l_returnflag")


@query("backfill_report", """WITH d AS (SELECT count(*) AS n, count(s_suppkey) AS fixed FROM lineitem
  LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) ON l_suppkey = s_suppkey WHERE l_returnflag = 'R')
SELECT n AS corrupted_rows_detected, fixed AS rows_backfilled, n - fixed AS remaining_bad_rows, n = fixed AS backfill_successful FROM d""")
def backfill_report(spark, sf):
    lines = inputs.table(spark, sf, "lineitem")
    names = inputs.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("store_name"), "s_acctbal")
    target = lines.select("l_suppkey", F.when(F.col("l_returnflag") == "R", "UNKNOWN").otherwise("known").alias("store_name"))
    bad = F.col("store_name") == "UNKNOWN"
    after = merge.backfill(target, bad, names.filter("s_acctbal >= 0"), "l_suppkey", ["store_name"])
    return merge.backfill_report(target, after, bad)
