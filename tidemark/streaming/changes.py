"""Applying a stream of change events exactly once.

Every micro-batch appends the events whose id is not in the published log, in one
step, so a repeated batch finds its own events there and adds nothing. The log is
cut into buckets by a hash of the id, and a batch looks its ids up in the buckets
that they fall in, not in the whole log. The table
of current rows is the newest event of every key, which does not depend on the
order or number of deliveries. `compact` writes that fold down so that reading
stays cheap; deletes stay in it as markers, because an older update may still
arrive.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedupe import latest_per_key
from tidemark.session import temporary
from tidemark.sinks.published import PublishedTable

EVENT_TIME = ["event_ts", "event_id"]


class ChangeTable:
    """Current rows of a keyed table, fed by change events.

    `version` orders the events of a key. Event time with the id as tie-breaker
    is the default; an arrival order (such as the broker offset) can be given
    instead. With `id_buckets` well over the ids of a batch, a batch reads about as
    many buckets of the log as it has ids; with fewer it reads them all.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "product_id",
                 version: list[str] | None = None, buckets: int = 32, id_buckets: int = 32):
        self.spark, self.key = spark, key
        self.version = version or EVENT_TIME
        self.log = PublishedTable(spark, f"{root}/log", key=["event_id"], buckets=id_buckets)
        self.folded = PublishedTable(spark, f"{root}/folded", key=[key], buckets=buckets)

    def apply(self, events: DataFrame, batch_id: int = 0) -> dict:
        """Append unseen events of one micro-batch; returns applied and skipped counts.

        The batch is written once, so its records are decoded once. Of the log only
        the ids of some buckets are read; the id alone tells a repeat, whatever its time says.
        """
        with temporary(events, "micro-batch") as batch:
            n = batch.count()
            if n == 0:
                return {"batch_id": batch_id, "applied": 0, "duplicate_skipped": 0}
            # one row per event id and task crosses the shuffle, however often an event is redelivered
            fresh = batch.dropDuplicates(["event_id"])
            if self.log.exists():
                fresh = fresh.join(self.known_ids(batch), "event_id", "left_anti")
            written = self.log.append(fresh.select(*batch.columns))["rows_written"]
        return {"batch_id": batch_id, "applied": written, "duplicate_skipped": n - written}

    def known_ids(self, events: DataFrame) -> DataFrame:
        """Ids in the buckets of the log that the ids of `events` fall in."""
        version = self.log.state()["version"]  # the log's own number of buckets holds
        touched = [r[0] for r in events.select(self.log.bucket_of()).distinct().collect()]  # at most as many as there are buckets
        return self.log.read(touched).select("event_id") if version else events.limit(0).select("event_id")

    def _unfolded(self) -> DataFrame:
        return self.log.read(since=self.folded.state()["marks"].get("log_version", 0))

    def _newest(self) -> DataFrame:
        """The newest event of every key; what is folded already is taken as it is."""
        folded = self.folded.state()
        if folded["version"] and all(p["version"] <= folded["marks"]["log_version"] for p in self.log.state()["parts"]):
            return self.folded.read()
        rows = self._unfolded()
        if folded["version"]:
            rows = rows.unionByName(self.folded.read())
        return latest_per_key(rows, [self.key], self.version)

    def current(self) -> DataFrame:
        """Rows that exist now, with the type and time of their last event."""
        alive = self._newest().filter(F.col("event_type") != "DELETE")
        others = [c for c in alive.columns if c not in (self.key, "event_type", "event_ts", "event_id", "payload")]
        payload = ["payload.*"] if "payload" in alive.columns else []
        return alive.select(self.key, *payload, *others, F.col("event_type").alias("last_event_type"),
                            F.col("event_ts").alias("last_updated"))

    def compact(self, forget_deletes_before: datetime | None = None) -> dict:
        """Fold new log rows into the buckets of their keys; other buckets stay as they are.

        Delete markers older than the given time are left out of the rewritten
        buckets, which is safe once no older event can arrive. Small parts of the log
        that are folded are joined, so that its list of parts stays short.
        """
        def fold(old: DataFrame, new: DataFrame) -> DataFrame:
            newest = latest_per_key(old.unionByName(new), [self.key], self.version)
            if forget_deletes_before is None:
                return newest
            return newest.filter((F.col("event_type") != "DELETE") | (F.col("event_ts") >= forget_deletes_before))

        version = self.log.state()["version"]
        new = latest_per_key(self._unfolded(), [self.key], self.version)
        done = self.folded.merge(new, fold, {"log_version": version})
        self.log.compact(up_to=version)
        return done

    def change_log(self) -> DataFrame:
        return self.log.read()

    def counts_by_type(self) -> DataFrame:
        return self.log.read().groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def run_changes(stream: DataFrame, table: ChangeTable, checkpoint: str) -> list[dict]:
    """Apply everything available now and stop; a later call goes on from the checkpoint.

    A new checkpoint replays from the start, which leaves the table as it is.
    """
    results: list[dict] = []
    query = (
        stream.writeStream.foreachBatch(lambda df, batch_id: results.append(table.apply(df, batch_id)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return results


def drop_repeats(stream: DataFrame, delay: str = "1 day", time: str = "event_ts", event_id: str = "event_id") -> DataFrame:
    """Stateful removal of repeated events that arrive within `delay` of each other.

    State stays bounded, but events later than the watermark are dropped, so
    this suits alerting; ChangeTable keeps late events.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([event_id])


def received_and_applied(query) -> dict[str, int]:
    """Totals of the `received` and `applied` observations of a finished query."""
    totals = {"received": 0, "applied": 0}
    for progress in query.recentProgress:
        for name, row in progress.observedMetrics.items():
            if name in totals:
                totals[name] += row["n"]
    return {**totals, "duplicate_skipped": totals["received"] - totals["applied"]}
