import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import cdc, merge
from tidemark.sinks.published import PublishedTable
from tidemark.sinks.snapshots import change_log_of, differing, track_changes, track_changes_by_digest

ROW = "product_id long, articleType string, baseColour string, usage string, stock_qty int"


def stock(spark, *pairs):
    return spark.createDataFrame([(i, "Shirt", "Blue", "Casual", q) for i, q in pairs], ROW)


@pytest.mark.parametrize("previous, current, expected", [
    ([], [(1, 10), (2, 10), (3, 10)], (3, 0, 0, 3)),
    ([(1, 10), (2, 10)], [(1, 10), (2, 10)], (0, 0, 0, 2)),
    ([(1, 10)], [(1, 99)], (0, 1, 0, 1)),
    ([(1, 10), (2, 10), (3, 10)], [(1, 10)], (0, 0, 2, 1)),
    ([(1, 10), (2, 5)], [(1, 99), (3, 20)], (1, 1, 1, 2)),
])
def test_changes_between_snapshots(spark, tmp_path, previous, current, expected):
    table = PublishedTable(spark, f"{tmp_path}/snapshot")
    if previous:
        track_changes(table, stock(spark, *previous), "product_id")
    changes, counts = track_changes(table, stock(spark, *current), "product_id")
    assert tuple(counts.first()) == expected
    assert changes.count() == sum(expected[:3])
    assert table.read().count() == len(current)


def test_changes_survive_a_failure_before_the_snapshot_moves(spark, tmp_path, rows, monkeypatch):
    table = PublishedTable(spark, f"{tmp_path}/snapshot")
    track_changes(table, stock(spark, (1, 10)), "product_id")
    replace = PublishedTable.replace
    monkeypatch.setattr(PublishedTable, "replace", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        track_changes(table, stock(spark, (1, 99), (2, 5)), "product_id")
    monkeypatch.setattr(PublishedTable, "replace", replace)
    changes, _ = track_changes(table, stock(spark, (1, 99), (2, 5)), "product_id")
    assert rows(changes) == [(1, "UPDATE"), (2, "INSERT")]
    log = change_log_of(table).read()
    assert rows(log, "product_id", "op", "snapshot_version") == [(1, "INSERT", 0), (1, "UPDATE", 1), (2, "INSERT", 1)]


def test_null_keys_do_not_multiply(spark, rows):
    batch = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    once = merge.upsert(batch.limit(0), batch, ["k"])
    assert rows(merge.upsert(once, batch, ["k"])) == rows(batch)
    gone = spark.createDataFrame([(None, "DELETE", "n")], "k int, op string, v string")
    assert rows(cdc.apply_changes(batch, gone, "k")) == [(1, "a")]


def test_snapshot_takes_the_last_row_of_a_repeated_key(spark):
    df = stock(spark, (1, 5), (1, 7)).withColumn("line", F.col("stock_qty"))
    one = cdc.snapshot(df, "product_id", last_by=["line"]).collect()
    assert len(one) == 1 and one[0]["row_hash"] == cdc.snapshot(stock(spark, (1, 7)), "product_id").first()["row_hash"]


def test_a_null_in_a_tracked_column_is_a_change(spark, rows):
    before = spark.createDataFrame([(1, "a", None, "b", 1)], ROW)
    after = spark.createDataFrame([(1, "a", "b", None, 1)], ROW)
    diff = cdc.diff_snapshots(cdc.snapshot(before, "product_id"), cdc.snapshot(after, "product_id"), "product_id")
    assert rows(diff) == [(1, "UPDATE")]


def test_samples_hold_the_first_keys_of_each_kind(spark, rows, plan):
    changes = spark.createDataFrame([(i, "INSERT") for i in range(20)] + [(99, "DELETE")], "product_id long, op string")
    sample = cdc.change_samples(changes, "product_id")
    assert rows(sample) == [(0, "INSERT"), (1, "INSERT"), (2, "INSERT"), (3, "INSERT"), (4, "INSERT"), (99, "DELETE")]
    assert "WindowGroupLimit" in plan(sample)


def test_change_log_is_stamped_and_counted(spark, rows):
    changes = spark.createDataFrame([(1, "INSERT"), (2, "INSERT"), (3, "DELETE")], "product_id long, op string")
    log = cdc.change_log(changes)
    assert log.filter("applied_at IS NULL").count() == 0
    assert rows(cdc.counts_by_op(log)) == [("DELETE", 1), ("INSERT", 2)]


states = st.dictionaries(st.integers(0, 8), st.integers(0, 3), max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(before=states, after=states)
def test_applying_the_difference_gives_the_new_state(spark, rows, before, after):
    old, new = stock(spark, *before.items()), stock(spark, *after.items())
    snapshots = [cdc.snapshot(d, "product_id") for d in (old, new)]
    changes = cdc.diff_snapshots(*snapshots, "product_id").join(new, "product_id", "left")
    assert rows(cdc.apply_changes(old, changes, "product_id")) == rows(new)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(before=states, batch=states)
def test_upsert_twice_is_upsert_once(spark, rows, before, batch):
    old, new = stock(spark, *before.items()), stock(spark, *batch.items())
    once = merge.upsert(old, new, ["product_id"])
    assert rows(once) == rows(merge.upsert(once, new, ["product_id"])) == rows(stock(spark, *{**before, **batch}.items()))


def test_upsert_takes_the_last_row_of_a_batch(spark, rows):
    batch = stock(spark, (1, 5), (1, 9)).withColumn("line", F.col("stock_qty"))
    target = stock(spark, (1, 1), (2, 2))
    assert rows(merge.upsert(target, batch, ["product_id"], ["line"]), "product_id", "stock_qty") == [(1, 9), (2, 2)]


def test_backfill_repairs_only_bad_rows(spark):
    truth = spark.range(1000).select("id", F.lit("Red").alias("baseColour"))
    broken = truth.withColumn("baseColour", F.when(F.col("id").between(200, 399), "UNKNOWN_COLOUR").otherwise(F.col("baseColour")))
    bad = F.col("baseColour") == "UNKNOWN_COLOUR"
    fixed = merge.backfill(broken, bad, truth, "id", ["baseColour"])
    report = merge.backfill_report(broken, fixed, bad).first().asDict()
    assert report == {"corrupted_rows_detected": 200, "rows_backfilled": 200, "remaining_bad_rows": 0, "backfill_successful": True}
    assert fixed.filter("backfilled").agg(F.min("id"), F.max("id")).first() == (200, 399)


def test_a_bad_key_without_truth_stays_bad(spark):
    target = spark.createDataFrame([(1, "BAD"), (2, "BAD"), (3, None)], "id long, baseColour string")
    truth = spark.createDataFrame([(1, "Red"), (3, "Blue")], "id long, baseColour string")
    bad = F.col("baseColour") == "BAD"
    fixed = merge.backfill(target, bad, truth, "id", ["baseColour"])
    assert sorted(map(tuple, fixed.collect())) == [(1, "Red", True), (2, "BAD", False), (3, None, False)]
    assert not merge.backfill_report(target, fixed, bad).first()["backfill_successful"]


def test_digests_find_the_buckets_that_changed(spark, tmp_path, rows, monkeypatch):
    table = PublishedTable(spark, f"{tmp_path}/snapshot", key=["id"], buckets=50)
    first = spark.range(2_000).select("id", F.format_string("v%d", "id").alias("v"), F.lit("same").alias("w"))
    changes, counts = track_changes_by_digest(table, first, "id", ["v", "w"])
    assert changes.count() == 2_000 and counts.first().asDict()["inserted_count"] == 2_000
    read, asked = table.read, []
    monkeypatch.setattr(table, "read", lambda buckets=None, since=0: asked.append(buckets) or read(buckets, since))
    # nothing changed, then one row
    for df, expected, n in ((first.repartition(7), [], 0), (first.withColumn("v", F.when(F.col("id") == 77, "x").otherwise(F.col("v"))), [(77, "UPDATE")], 1)):
        asked.clear()
        files = set(read().inputFiles())
        changes, _ = track_changes_by_digest(table, df, "id", ["v", "w"])
        assert rows(changes) == expected and len(asked[0]) == n
        assert len(files & set(read().inputFiles())) == len(files) - n  # the others keep their files
    # inserts, updates and deletes at once equal a comparison of all rows
    last = first.filter("id % 3 <> 0").withColumn("v", F.when(F.col("id") % 5 == 0, "y").otherwise(F.col("v"))).unionByName(
        spark.range(5_000, 5_020).select("id", F.lit("z").alias("v"), F.lit("same").alias("w")))
    before = read()
    expected = rows(cdc.diff_snapshots(before, cdc.snapshot(last, "id", ["v", "w"]), "id"))
    changes, counts = track_changes_by_digest(table, last, "id", ["v", "w"])
    assert rows(changes) == expected and counts.first()["total_tracked"] == last.count()
    with pytest.raises(ValueError):
        track_changes_by_digest(PublishedTable(spark, f"{tmp_path}/other"), first, "id", ["v"])


def test_differing_buckets_by_tree():
    rng = random.Random(5)
    for buckets in (1, 2, 15, 16, 17, 300):
        before = {str(b): "a" for b in range(buckets) if rng.random() < 0.9}
        after = {b: ("c" if rng.random() < 0.1 else d) for b, d in before.items() if rng.random() < 0.95}
        assert differing(before, after, buckets) == [b for b in range(buckets) if before.get(str(b)) != after.get(str(b))]
        assert differing(before, before, buckets) == []
