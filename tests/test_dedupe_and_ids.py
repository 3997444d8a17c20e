from collections import Counter

from pyspark.sql import functions as F

from tidemark.operators import dedupe, ids, lookup, sampling


def test_first_and_latest_per_key(spark, rows):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (None, 2, "n"), (None, 1, "m"), (2, 5, "z")], "k int, o int, v string")
    assert rows(dedupe.first_per_key(df, ["k"], ["o"])) == [(1, 1, "a"), (2, 5, "z"), (None, 1, "m")]
    assert rows(dedupe.latest_per_key(df, ["k"], ["o"])) == [(1, 3, "c"), (2, 5, "z"), (None, 2, "n")]
    assert rows(dedupe.first_per_key(df, ["k"], ["o"], n=2)) == rows(df)


def test_dedupe_inside_a_file_keeps_keys_shared_by_files(spark, rows):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", 1, 3)], "source_file string, id int, line int")
    assert rows(dedupe.first_per_key_in_file(df, ["id"], ["line"])) == [("a", 1, 1), ("b", 1, 3)]


def test_content_key_tells_values_apart(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, "a"), ("", "a"), ("a,b", None), ("a", "b")], "x string, y string")
    assert df.select(dedupe.content_key(["x", "y"]).alias("k")).distinct().count() == 5


def test_duplicate_count_takes_nulls_as_one_group(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (None,), (None,), (2,)], "k int")
    assert dedupe.duplicate_count(df, ["k"]).first()[0] == 3
    assert dedupe.duplicate_count(df.limit(0), ["k"]).first()[0] == 0


def test_dedupe_limits_every_task_before_the_shuffle(spark, plan):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS o")
    text = plan(dedupe.first_per_key(df, ["k"], ["o"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_positions_are_consecutive_and_ordered(spark, rows):
    df = spark.range(1000, numPartitions=7).selectExpr("(id * 37) % 1000 AS v", "id AS other")
    got = ids.with_positions(df, ["v"]).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, 1001))
    assert [r["v"] for r in got] == sorted(r["v"] for r in got)


def test_positions_of_one_hot_value_are_spread_over_tasks(spark):
    df = spark.range(20000, numPartitions=8).select(F.lit(1).alias("v"), "id")
    numbered = ids.with_positions(df, ["v"])
    assert numbered.agg(F.min("position"), F.max("position"), F.countDistinct("position")).first() == (1, 20000, 20000)
    files = numbered.select("_metadata.file_path").distinct().count() if "_metadata" in numbered.columns else None
    assert files is None or files > 1


def test_positions_descending_and_of_nothing(spark):
    df = spark.range(5)
    assert [r["id"] for r in ids.with_positions(df, [F.desc("id")]).orderBy("position").collect()] == [4, 3, 2, 1, 0]
    assert ids.with_positions(df.limit(0), ["id"]).count() == 0


def test_surrogate_keys_follow_the_natural_order(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "v string")
    assert rows(ids.surrogate_keys(df, ["v"], "k")) == [(1, "a"), (2, "b"), (3, "c")]


def test_positions_meet_their_offsets_without_a_shuffle(spark, plan):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        text = plan(ids.with_positions(spark.range(20000, numPartitions=8), ["id"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_append_with_new_ids_discards_incoming_ids(spark, rows):
    have = spark.createDataFrame([(10, "x"), (40, "y")], "id long, v string")
    new = spark.createDataFrame([(1, "b"), (1, "a")], "id long, v string")
    assert rows(ids.append_with_new_ids(have, new, "id", ["v"])) == [(10, "x"), (40, "y"), (41, "a"), (42, "b")]
    assert rows(ids.append_with_new_ids(have.limit(0), new, "id", ["v"])) == [(1, "a"), (2, "b")]


def test_lookup_takes_the_last_entry_of_a_repeated_key(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "name string")
    table = spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], "name string, id int, line int")
    assert rows(lookup.map_values(df, "name", table, "name", "id", "code", last_by=["line"])) == [("a", 2), ("b", None), (None, None)]


def test_membership(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    keys = spark.createDataFrame([(2,), (2,), (9,)], "k int")
    assert rows(lookup.keep_keys(df, keys, "k")) == [(2,)]
    assert rows(lookup.drop_keys(df, keys, "k")) == [(1,), (3,)]


def test_orphans_ignore_null_references(spark, rows):
    child = spark.createDataFrame([(1,), (7,), (7,), (None,)], "p int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(lookup.orphans(child, "p", parent, "id")) == [(7, 2)]
    assert rows(lookup.orphan_report([("r", child, "p", parent, "id")])) == [("r", 1, 2)]


def test_sample_is_exact_and_repeatable(spark, rows):
    df = spark.range(1000)
    a, b = (sampling.sample_rows(df.repartition(n), ["id"], 50, seed=3) for n in (2, 9))
    assert rows(a) == rows(b) and a.count() == 50
    assert rows(sampling.sample_rows(df, ["id"], 50, seed=4)) != rows(a)
    assert sampling.sample_rows(df.limit(7), ["id"], 50).count() == 7
    # a smaller sample is part of a larger one
    few = sampling.sample_rows(df, ["id"], 3, seed=3)
    assert set(rows(few)) <= set(rows(a)) and few.count() == 3
    assert 0 < sampling.sample_fraction(df, 0.1).count() < 250


def test_sample_with_replacement_is_exact_and_repeatable(spark, rows):
    df = spark.range(40).select("id", (F.col("id") * 2).alias("v"))
    a, b = (sampling.sample_with_replacement(df.repartition(n), ["id"], 500, seed=3) for n in (2, 9))
    assert rows(a, "draw", "id", "v") == rows(b, "draw", "id", "v")
    drawn = a.collect()
    assert sorted(r.draw for r in drawn) == list(range(1, 501)) and all(r.v == 2 * r.id for r in drawn)
    counts = Counter(r.id for r in drawn)
    assert set(counts) == set(range(40)) and max(counts.values()) < 35  # 12.5 each on average
    few = sampling.sample_with_replacement(df, ["id"], 5, seed=3)
    assert set(rows(few, "draw", "id")) <= set(rows(a, "draw", "id")) and few.count() == 5
    assert rows(sampling.sample_with_replacement(df, ["id"], 500, seed=4), "draw", "id") != rows(a, "draw", "id")
    assert sampling.sample_with_replacement(df.limit(0), ["id"], 5).count() == 0
    assert sampling.sample_with_replacement(df.limit(1), ["id"], 5).count() == 5
