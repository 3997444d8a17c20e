import json
import random
from datetime import datetime

import pytest
from conftest import CATALOG, catalog_row
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_sources import write_catalog

from tidemark.sinks.published import PublishedTable
from tidemark.sources.events import EVENT_SCHEMA, decode_events, good_events, stream_from_folder
from tidemark.streaming.changes import ChangeTable, drop_repeats, received_and_applied, run_changes
from tidemark.streaming.files import ingest_new_files


def event(event_id, kind, key, second, colour="Blue"):
    return {"event_id": event_id, "event_type": kind, "product_id": key,
            "payload": {"articleType": "Shirts", "baseColour": colour, "season": "Fall", "usage": "Casual",
                        "productDisplayName": "Shirt"},
            "event_ts": f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}Z"}


class Topic:
    """A folder of records; every send is one file."""

    def __init__(self, spark, root):
        self.spark, self.folder, self.sent = spark, root / "topic", 0
        self.folder.mkdir()

    def send(self, *events):
        lines = [json.dumps({"key": "k", "value": e if isinstance(e, str) else json.dumps(e)}) for e in events]
        (self.folder / f"{self.sent:04d}.json").write_text("\n".join(lines) + "\n")
        self.sent += 1

    def stream(self, **options):
        return good_events(decode_events(stream_from_folder(self.spark, str(self.folder), **options))).drop("key")


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


def now(table):
    return sorted(map(tuple, table.current().select("product_id", "baseColour", "last_event_type").collect()))


def totals(results):
    return sum(r["applied"] for r in results), sum(r["duplicate_skipped"] for r in results)


def test_insert_update_delete_and_redelivery(spark, topic, tmp_path):
    table = ChangeTable(spark, f"{tmp_path}/table")
    first = [event("a", "INSERT", 1, 1), event("b", "INSERT", 2, 2), event("c", "UPDATE", 1, 3, "Red"), event("d", "DELETE", 2, 4)]
    topic.send(*first, first[0], "{broken")
    checkpoint = f"{tmp_path}/checkpoint"
    assert totals(run_changes(topic.stream(), table, checkpoint)) == (4, 1)
    assert now(table) == [(1, "Red", "UPDATE")]
    # a restart goes on from the checkpoint: only new files are read
    topic.send(*first)
    topic.send(event("e", "INSERT", 3, 9, "Green"))
    assert totals(run_changes(topic.stream(), table, checkpoint)) == (1, 4)
    assert now(table) == [(1, "Red", "UPDATE"), (3, "Green", "INSERT")]
    # a replay from the start changes nothing
    assert totals(run_changes(topic.stream(max_files=1), table, f"{tmp_path}/fresh")) == (0, 10)
    assert now(table) == [(1, "Red", "UPDATE"), (3, "Green", "INSERT")]
    assert sorted(map(tuple, table.counts_by_type().collect())) == [("DELETE", 1), ("INSERT", 3), ("UPDATE", 1)]


def test_late_events_do_not_win_or_resurrect(spark, topic, tmp_path):
    table, checkpoint = ChangeTable(spark, f"{tmp_path}/table"), f"{tmp_path}/checkpoint"
    topic.send(event("a", "INSERT", 1, 1), event("c", "UPDATE", 1, 30, "New"), event("d", "DELETE", 2, 40))
    run_changes(topic.stream(), table, checkpoint)
    table.compact()
    topic.send(event("b", "UPDATE", 1, 20, "Stale"), event("x", "UPDATE", 2, 35, "Ghost"))
    run_changes(topic.stream(), table, checkpoint)
    assert now(table) == [(1, "New", "UPDATE")]
    table.compact()
    assert now(table) == [(1, "New", "UPDATE")]
    # a key that comes back after its delete is there again
    topic.send(event("y", "INSERT", 2, 50, "Back"))
    run_changes(topic.stream(), table, checkpoint)
    assert now(table) == [(1, "New", "UPDATE"), (2, "Back", "INSERT")]


def test_a_new_event_with_the_same_state_makes_no_second_row(spark, topic, tmp_path):
    table = ChangeTable(spark, f"{tmp_path}/table")
    topic.send(event("a", "UPDATE", 1, 1), event("b", "UPDATE", 1, 2))
    assert totals(run_changes(topic.stream(), table, f"{tmp_path}/c")) == (2, 0)
    assert now(table) == [(1, "Blue", "UPDATE")]


def test_arrival_order(spark, tmp_path, rows):
    schema = "event_id string, event_type string, product_id long, v string, event_ts timestamp, arrival long"
    events = spark.sql("SELECT 'a' AS event_id, 'UPDATE' AS event_type, 1L AS product_id, 'newer' AS v, TIMESTAMP'2024-01-02' AS event_ts, 1L AS arrival "
                       "UNION ALL SELECT 'b', 'UPDATE', 1, 'late', TIMESTAMP'2024-01-01', 2")
    assert events.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    for version, expected in ((["arrival"], "late"), (None, "newer")):
        table = ChangeTable(spark, f"{tmp_path}/{expected}", version=version)
        table.apply(events)
        assert table.current().first()["v"] == expected


def changes(spark, *events):
    return good_events(decode_events(spark.createDataFrame([(json.dumps(e),) for e in events], "value string")))


def test_compaction_forgets_old_deletes_and_nothing_revives(spark, tmp_path):
    table = ChangeTable(spark, f"{tmp_path}/table")
    table.apply(changes(spark, event("z", "INSERT", 1, 0), event("a", "DELETE", 1, 1)))
    table.apply(changes(spark, event("b", "DELETE", 2, 100), event("c", "INSERT", 3, 50)))
    table.compact(forget_deletes_before=datetime(2024, 1, 1, 0, 1))
    assert sorted(r["product_id"] for r in table.folded.read().collect()) == [2, 3]
    assert table.apply(changes(spark, event("b", "DELETE", 2, 100), event("z", "INSERT", 1, 0))) == {
        "batch_id": 0, "applied": 0, "duplicate_skipped": 2}
    assert [r[0] for r in now(table)] == [3]
    table.compact()
    assert [r[0] for r in now(table)] == [3]


def test_a_repeat_is_known_by_its_id_alone(spark, tmp_path):
    table = ChangeTable(spark, f"{tmp_path}/table")
    table.apply(changes(spark, event("a", "INSERT", 1, 1)))
    assert table.apply(changes(spark, event("a", "INSERT", 1, 5000)))["applied"] == 0


def test_folded_rows_are_read_without_a_window(spark, tmp_path, plan):
    table = ChangeTable(spark, f"{tmp_path}/table")
    table.apply(changes(spark, event("a", "INSERT", 1, 1)))
    assert "Window" in plan(table.current())
    table.compact()
    assert "Window" not in plan(table.current())


histories = st.lists(st.tuples(st.integers(1, 3), st.sampled_from(["INSERT", "UPDATE", "DELETE"])), min_size=1, max_size=8)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(history=histories, seed=st.integers(0, 99))
def test_any_order_and_repetition_gives_the_same_table(spark, tmp_path_factory, history, seed):
    events = [event(f"e{i}", kind, key, i, f"c{i}") for i, (key, kind) in enumerate(history)]
    expected = {}
    for e in events:
        expected.pop(e["product_id"], None)
        if e["event_type"] != "DELETE":
            expected[e["product_id"]] = (e["product_id"], e["payload"]["baseColour"], e["event_type"])
    delivered = events + random.Random(seed).choices(events, k=4)
    random.Random(seed).shuffle(delivered)
    table = ChangeTable(spark, str(tmp_path_factory.mktemp("permuted")))
    for part in (delivered[: len(delivered) // 2], delivered[len(delivered) // 2:]):
        if part:
            table.apply(good_events(decode_events(spark.createDataFrame([(json.dumps(e),) for e in part], "value string"))))
    assert now(table) == sorted(expected.values())


def test_stateful_removal_of_repeats_counts_both_sides(spark, topic, tmp_path):
    topic.send(event("a", "INSERT", 1, 1), event("b", "INSERT", 2, 2))
    topic.send(event("a", "INSERT", 1, 1), event("c", "INSERT", 3, 3))
    received = topic.stream(max_files=1).observe("received", F.count(F.lit(1)).alias("n"))
    applied = drop_repeats(received, "1 hour").observe("applied", F.count(F.lit(1)).alias("n"))
    query = (applied.writeStream.format("parquet").option("path", f"{tmp_path}/out")
             .option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start())
    query.awaitTermination()
    assert received_and_applied(query) == {"received": 4, "applied": 3, "duplicate_skipped": 1}
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_new_files_are_taken_once_and_together(spark, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    schema = spark.createDataFrame([], CATALOG).schema
    table, quarantine = PublishedTable(spark, f"{tmp_path}/t", key=["id"], buckets=4), PublishedTable(spark, f"{tmp_path}/q")
    run = lambda: ingest_new_files(spark, str(incoming), schema, table, f"{tmp_path}/c", quarantine, ["productDisplayName"])
    write_catalog(incoming / "one.csv", catalog_row(1, " A "), catalog_row(2, None))
    write_catalog(incoming / "two.csv", catalog_row(3, colour=None))
    (incoming / "notes.txt").write_text("ignored")
    assert [(d["published"], d["quarantined"]) for d in run()] == [(2, 1)]
    assert run() == []
    write_catalog(incoming / "three.csv", catalog_row(4, year=None), catalog_row(5, year=1900), catalog_row(1, "New"), catalog_row(6))
    assert [(d["published"], d["quarantined"]) for d in run()] == [(3, 1)]
    got = sorted((r["id"], r["productDisplayName"], r["baseColour"], r["source_file"]) for r in table.read().collect())
    assert got == [(1, "New", "Blue", "three.csv"), (3, "Blue Shirt", "Unknown", "two.csv"), (4, "Blue Shirt", "Blue", "three.csv"),
                   (6, "Blue Shirt", "Blue", "three.csv")]
    assert sorted((r["id"], r["reject_reasons"]) for r in quarantine.read().collect()) == [
        (2, ["null:productDisplayName"]), (5, ["range:year"])]


def test_event_schema_has_the_product_payload():
    assert [f.name for f in EVENT_SCHEMA["payload"].dataType] == ["articleType", "baseColour", "season", "usage", "productDisplayName"]


def test_ids_are_looked_up_in_their_buckets(spark, tmp_path):
    table = ChangeTable(spark, f"{tmp_path}/table", id_buckets=32)
    table.apply(changes(spark, *[event(f"e{i}", "INSERT", i, i) for i in range(300)]))
    batch = changes(spark, event("e7", "UPDATE", 7, 400), event("new", "INSERT", 8, 401))
    buckets = {f.split("__bucket=")[1].split("/")[0] for f in table.known_ids(batch).inputFiles()}
    assert 1 <= len(buckets) <= 2 < len({p["bucket"] for p in table.log.state()["parts"]})
    assert table.known_ids(batch).count() < 60
    assert table.apply(batch, 1) == {"batch_id": 1, "applied": 1, "duplicate_skipped": 1}
    # a table that is opened with another number keeps its own
    assert ChangeTable(spark, f"{tmp_path}/table", id_buckets=4).apply(batch, 2)["applied"] == 0


def test_log_parts_are_joined_and_repeats_still_known(spark, tmp_path, plan):
    table = ChangeTable(spark, f"{tmp_path}/table", buckets=2, id_buckets=1)
    for i in range(10):
        table.apply(changes(spark, event(f"e{i}", "UPDATE", i % 3, i, f"c{i}")), i)
    expected = now(table)
    table.compact()
    assert len(table.log.state()["parts"]) == 1 and now(table) == expected
    assert "Window" not in plan(table.current())
    assert table.apply(changes(spark, event("e4", "UPDATE", 1, 900, "late")), 11)["applied"] == 0
    table.apply(changes(spark, event("f", "UPDATE", 1, 950, "new")), 12)
    assert (1, "new", "UPDATE") in now(table) and table.change_log().count() == 11
