"""Change-event queries: events are encoded to JSON records, delivered twice, and applied as a stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedupe import latest_per_key
from tidemark.session import scratch_path
from tidemark.sinks.events import encode_events, publish_to_folder
from tidemark.sinks.published import PublishedTable
from tidemark.sources.events import dead_letters, decode_events, good_events, stream_from_folder
from tidemark.streaming.changes import ChangeTable, drop_repeats, run_changes
from tidemark.streaming.files import ingest_new_files
from tidemark.suite import inputs
from tidemark.suite.inputs import CHANGES_SQL, CLEAN_SQL
from tidemark.suite.registry import query

_PAYLOAD = ["value", "source_type"]
_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("payload", T.StructType([
        T.StructField("value", T.DoubleType()),
        T.StructField("source_type", T.StringType()),
    ])),
    T.StructField("event_ts", T.TimestampType()),
])


def _records(spark, sf):
    changes = inputs.change_events(spark, sf)
    return encode_events(changes, "product_id", _PAYLOAD, F.col("event_type"), F.col("event_ts"))


def _delivered_twice(spark, sf):
    path = scratch_path(spark, "records")
    records = _records(spark, sf)
    publish_to_folder(records, path)
    publish_to_folder(records, path)
    return path


def _events(spark, folder, max_files=None):
    return good_events(decode_events(stream_from_folder(spark, folder, max_files), _SCHEMA)).drop("key")


def _micros(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


@query("stream_cdc_apply", f"""WITH {CHANGES_SQL},
newest AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY event_ts DESC) = 1)
SELECT product_id, value, source_type, event_type AS last_event_type, strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS last_updated
FROM newest WHERE event_type <> 'DELETE'""")
def stream_cdc_apply(spark, sf):
    folder = _delivered_twice(spark, sf)
    table = ChangeTable(spark, scratch_path(spark, "changes"))
    run_changes(_events(spark, folder), table, scratch_path(spark, "checkpoint"))
    table.compact()
    return table.current().withColumn("last_updated", _micros("last_updated"))


@query("stream_bounded_dedup", f"WITH {CHANGES_SQL} SELECT product_id, value, source_type, strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts FROM changes")
def stream_bounded_dedup(spark, sf):
    """Every record comes twice, in different micro-batches; the state of seen ids lets the first one through."""
    events = _events(spark, _delivered_twice(spark, sf), max_files=4)
    # the records are in no order of time, so the delay covers all of it
    once, out = drop_repeats(events, "20000 days"), scratch_path(spark, "once")
    query = (once.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "checkpoint"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(once.schema).parquet(out).select("product_id", "payload.*", _micros("event_ts").alias("event_ts"))


@query("stream_replay_counts", """SELECT 'first run' AS step, count(*) AS applied, count(*) AS duplicate_skipped FROM events UNION ALL
SELECT 'restart', 0, 0 UNION ALL SELECT 'replay', 0, 2 * count(*) FROM events UNION ALL
SELECT 'other times', 0, count(*) FROM events""")
def stream_replay_counts(spark, sf):
    folder = _delivered_twice(spark, sf)
    table = ChangeTable(spark, scratch_path(spark, "changes"))
    checkpoint = scratch_path(spark, "checkpoint")
    rows = []
    for step, place in (("first run", checkpoint), ("restart", checkpoint), ("replay", scratch_path(spark, "checkpoint"))):
        done = run_changes(_events(spark, folder), table, place)
        rows.append((step, sum(d["applied"] for d in done), sum(d["duplicate_skipped"] for d in done)))
    # the same events come once more under another time
    again = good_events(decode_events(_records(spark, sf), _SCHEMA)).drop("key").withColumn("event_ts", F.col("event_ts") + F.expr("INTERVAL 400 DAYS"))
    done = table.apply(again)
    rows.append(("other times", done["applied"], done["duplicate_skipped"]))
    return spark.createDataFrame(rows, "step string, applied long, duplicate_skipped long")


@query("stream_forgotten_deletes", f"""WITH {CHANGES_SQL},
newest AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY event_ts DESC) = 1)
SELECT product_id, event_type AS last_event_type FROM newest WHERE event_type <> 'DELETE'""")
def stream_forgotten_deletes(spark, sf):
    """Compacted, all old delete markers forgotten, the same events delivered again: no deleted row comes back."""
    table = ChangeTable(spark, scratch_path(spark, "changes"))
    events = good_events(decode_events(_records(spark, sf), _SCHEMA)).drop("key")
    table.apply(events)
    table.compact(forget_deletes_before=datetime(2100, 1, 1))
    table.apply(events, 1)
    table.compact()
    return table.current().select("product_id", "last_event_type")


@query("stream_change_counts", f"WITH {CHANGES_SQL} SELECT event_type, count(*) AS n FROM changes GROUP BY 1")
def stream_change_counts(spark, sf):
    table = ChangeTable(spark, scratch_path(spark, "changes"))
    run_changes(_events(spark, _delivered_twice(spark, sf)), table, scratch_path(spark, "checkpoint"))
    return table.counts_by_type()


@query("event_encode_decode", f"""WITH {CHANGES_SQL} SELECT CAST(product_id AS VARCHAR) AS key, event_type, product_id, value, source_type,
  strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts, 1 AS same_id,
  (SELECT count(*) FROM changes) AS ids FROM changes""")
def event_encode_decode(spark, sf):
    """Encoded twice, every event has the same id both times and shares it with no other."""
    twice = [good_events(decode_events(_records(spark, sf), _SCHEMA)) for _ in range(2)]
    per_id = twice[0].unionByName(twice[1]).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    ids = per_id.agg(F.count_if(F.col("n") == 2))
    events = twice[0].join(per_id, "event_id").withColumns({"same_id": (F.col("n") == 2).cast("int"), "ids": ids.scalar()})
    return events.select("same_id", "ids", "key", "event_type", "product_id", "payload.*", _micros("event_ts").alias("event_ts"))


@query("event_dead_letters", """SELECT CAST(count_if(event_type = 'view') AS BIGINT) AS undecodable, CAST(count_if(event_type <> 'view') AS BIGINT) AS decoded FROM events""")
def event_dead_letters(spark, sf):
    """Records of one type arrive cut short."""
    cut = _records(spark, sf).withColumn("value", F.when(
        F.get_json_object("value", "$.payload.source_type") == "view", F.expr("left(value, length(value) - 40)")
    ).otherwise(F.col("value")))
    decoded = decode_events(cut, _SCHEMA)
    bad = dead_letters(decoded).agg(F.count(F.lit(1)))
    return decoded.agg(F.count_if("decoded").alias("decoded")).withColumn("undecodable", bad.scalar())


@query("json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_field(spark, sf):
    return inputs.table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("latest_event_per_key", """SELECT event_id, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_event_per_key(spark, sf):
    return latest_per_key(inputs.table(spark, sf, "events"), ["user_id"], ["ts", "event_id"]).select(
        "event_id", "user_id", "event_type", "value")


@query("stream_new_files", f"WITH {CLEAN_SQL} SELECT * FROM clean")
def stream_new_files(spark, sf):
    """The same catalogue comes twice, in files of two names: every product is there once."""
    raw = inputs.raw_catalog(spark, sf)
    folder = scratch_path(spark, "incoming")
    table = PublishedTable(spark, scratch_path(spark, "catalog"), key=["id"], buckets=8)
    quarantine, checkpoint = PublishedTable(spark, scratch_path(spark, "quarantine")), scratch_path(spark, "checkpoint")
    for _ in range(2):
        raw.repartition("id").write.mode("append").option("header", True).csv(folder)
        ingest_new_files(spark, folder, raw.schema, table, checkpoint, quarantine, ["delivery"])
    return table.read().drop("source_file")
