"""One key holds a third of the rows: results stay whole and no task gets the hot group."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc, dedupe, features, lookup, merge, profile, quality
from tidemark.session import materialise
from tidemark.suite import QUERIES

ROWS, HOT = 90_000, 30_000


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A third of the rows has key 0; the others have three rows per key."""
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    df = spark.range(ROWS, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.floor(F.col("id") / 6) + 1).alias("k"), F.col("id").alias("o"))
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def skewed_joins(spark):
    """Every join is a sort-merge join and partitions count as skewed early, as hot keys at scale do."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_in_grouped_operators(spark, hot):
    keys = hot.select("k").distinct().count()
    assert dedupe.first_per_key(hot, ["k"], ["o"]).count() == keys
    assert dedupe.duplicate_count(hot, ["k"]).first()[0] == ROWS - keys
    assert profile.value_counts(hot, "k", top=1).first()["n"] == HOT
    assert profile.exact_median(hot, "k").first()[0] == hot.agg(F.median("k")).first()[0]


def test_frequency_join_splits_the_hot_key(hot, skewed_joins):
    encoded = features.frequency_encode(hot, "k", "f")
    assert "isSkew" in final_plan(encoded).replace("SortMergeJoin(skew=true)", "isSkew")
    assert encoded.count() == ROWS and encoded.filter("k = 0").select("f").distinct().collect() == [(HOT / ROWS,)]


@pytest.mark.parametrize("build", [
    lambda s, hot: lookup.keep_keys(hot, hot.filter("k < 500"), "k"),
    lambda s, hot: lookup.drop_keys(hot, hot.filter("k > 500"), "k"),
    lambda s, hot: lookup.map_values(hot, "k", hot, "k", "o", "v", last_by=["o"]),
])
def test_joins_with_a_repeated_key_side_split_the_hot_key(spark, hot, skewed_joins, build):
    df = build(spark, hot)
    assert "skew=true" in final_plan(df)
    assert df.filter("k = 0").count() == HOT


def test_quarantine_marks_every_repeat_of_a_hot_key(spark, hot):
    rules = quality.BatchRules(required=["k", "o"], mandatory=["k"], key="k", numeric="o", valid_range=(0, ROWS))
    _, bad = quality.split_batch(hot, ["o"], rules)
    assert bad.count() == dedupe.duplicate_count(hot, ["k"]).first()[0]


def test_changes_of_a_hot_operation(spark, hot):
    changes = hot.select(F.col("o").alias("key"), F.when(F.col("k") == 0, "DELETE").otherwise("INSERT").alias("op"))
    assert cdc.change_samples(changes, "key").count() == 10
    assert cdc.change_counts(changes).first().asDict() == {"inserted_count": ROWS - HOT, "updated_count": 0, "deleted_count": HOT}


def test_upsert_does_not_shuffle_the_target_for_a_small_batch(spark, hot, plan):
    target = hot.select(F.col("o").alias("id"), "k")
    batch = materialise(spark.createDataFrame([(1, 5)], "id long, k long"), "batch")
    text = plan(merge.upsert(target, batch, ["id"]))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, columns", [
    ("olap_top_articles", {"l_partkey", "l_quantity", "l_extendedprice"}),
    ("olap_region", {"l_suppkey", "l_quantity", "l_extendedprice"}),
    ("kpi_core", {"l_orderkey", "l_quantity", "l_extendedprice"}),
    ("profile_crosstab", {"l_shipdate", "l_returnflag"}),
])
def test_scans_read_only_needed_columns(spark, plan, name, columns):
    schemas = re.findall(r"FileScan parquet \[([^\]]*)\]", plan(QUERIES[name](spark, SF)))
    read = {c.split("#")[0] for c in next(s for s in schemas if "l_" in s).split(",")}
    assert read == columns


def test_filters_reach_the_scan(spark, plan):
    text = plan(QUERIES["scan_projected"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text


def test_cube_expands_groups_and_not_sales(spark, plan):
    text = plan(QUERIES["olap_cube"](spark, SF))
    above, below = text.split("Expand", 1)
    assert "HashAggregate" in below and "partial_sum" in below


@pytest.mark.parametrize("name", ["olap_cube", "measure_share", "frequency_encode", "profile_percent", "fill_median", "cdc_counts"])
def test_no_cross_joins(spark, plan, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
