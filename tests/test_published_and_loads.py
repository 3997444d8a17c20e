import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import files, loads
from tidemark.sinks.published import ConcurrentPublish, Constraints, PublishedTable, PublishRejected, RangedTable


def names(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id long, productDisplayName string")


def products(spark, n):
    return spark.range(n).select("id", F.format_string("Product %d", "id").alias("productDisplayName"))


def test_replace_append_and_read(spark, tmp_path, rows):
    table = PublishedTable(spark, f"{tmp_path}/t")
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.replace(names(spark, (1, "a")))["version"] == 1
    assert table.append(names(spark, (2, "b")))["rows_total"] == 2
    assert rows(table.read()) == [(1, "a"), (2, "b")]
    assert rows(table.read(since=1)) == [(2, "b")]
    table.replace(names(spark, (3, "c")))
    assert rows(table.read()) == [(3, "c")]


def test_an_empty_append_adds_no_part(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t")
    table.append(names(spark, (1, "a")))
    table.append(names(spark, (1, "a")).limit(0), {"seen": 7})
    assert len(table.state()["parts"]) == 1 and table.state()["marks"] == {"seen": 7}
    only_empty = PublishedTable(spark, f"{tmp_path}/e")
    only_empty.replace(names(spark, (1, "a")).limit(0))
    assert only_empty.read().count() == 0


def test_an_atomic_load_commits_whole_or_not_at_all(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t", constraints=loads.PRODUCT_CONSTRAINTS)
    bad = products(spark, 200).unionByName(names(spark, (10, None)))
    first = loads.load_atomic(table, bad)
    assert (first["outcome"], first["final_row_count"]) == ("ROLLED_BACK", 0)
    assert loads.load_atomic(table, products(spark, 200)) == {"outcome": "COMMITTED", "error": None, "final_row_count": 200}
    again = loads.load_atomic(table, bad)
    assert (again["outcome"], again["final_row_count"], table.read().count()) == ("ROLLED_BACK", 200, 200)
    repeated = loads.load_atomic(table, products(spark, 200).unionByName(names(spark, (10, "x"))))
    assert "duplicate:id" in repeated["error"]


def test_a_job_that_dies_leaves_the_earlier_rows(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t")
    table.replace(products(spark, 10))
    broken = products(spark, 10).withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception):
        table.replace(broken)
    assert table.read().count() == 10 and table.state()["version"] == 1


def test_unique_holds_over_appends(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t", constraints=Constraints(unique=["id"]))
    table.append(names(spark, (1, "a")))
    with pytest.raises(PublishRejected):
        table.append(names(spark, (1, "b")))
    assert table.append(names(spark, (2, "b")))["rows_total"] == 2


def test_a_merge_rewrites_only_touched_buckets(spark, tmp_path, rows):
    table = PublishedTable(spark, f"{tmp_path}/t", key=["id"], buckets=16)
    loads.load_upsert(table, products(spark, 200), "run-1")
    before = {p["bucket"]: p["path"] for p in table.state()["parts"]}
    done = loads.load_upsert(table, names(spark, (5, "new")), "run-2")
    after = {p["bucket"]: p["path"] for p in table.state()["parts"]}
    assert sum(before[b] != after[b] for b in before) == 1
    assert done == {"run_id": "run-2", "row_count_before": 200, "row_count_after": 200, "net_new_rows": 0, "rows_in_batch": 1}
    assert rows(table.read().filter("loaded_by_run = 'run-2'"), "id", "productDisplayName") == [(5, "new")]


def test_loading_twice_adds_nothing(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t", key=["id"], buckets=4)
    proof = loads.verify_idempotent(table, products(spark, 2000), ("a", "b"))
    assert proof["idempotent_confirmed"] and proof["first_run"]["net_new_rows"] == 2000
    assert table.read().select("loaded_by_run").distinct().collect() == [("b",)]


def test_a_batch_with_repeated_keys_needs_an_order(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t", key=["id"], buckets=4)
    batch = names(spark, (1, "a"), (1, "b"))
    with pytest.raises(PublishRejected):
        loads.load_upsert(table, batch, "r")
    loads.load_upsert(table, batch, "r", last_by=["productDisplayName"])
    assert table.read().first()["productDisplayName"] == "b"


@pytest.mark.parametrize("start", [1, -5])
def test_incremental_load_steps(spark, tmp_path, start):
    table = PublishedTable(spark, f"{tmp_path}/t")
    batch = lambda n: names(spark, *[(i, "x") for i in range(start, start + n)])
    steps = [loads.load_incremental(table, batch(n), "id") for n in (3, 5, 3)]
    assert [s["rows_written"] for s in steps] == [3, 2, 0]
    assert [s["prev_watermark"] for s in steps] == [None, start + 2, start + 4]
    assert table.read().count() == 5


@pytest.mark.parametrize("kind", ["timestamp", "date", "timestamp_ntz", "decimal(10,2)", "string"])
def test_incremental_load_by_other_types(spark, tmp_path, kind):
    table = PublishedTable(spark, f"{tmp_path}/t")
    texts = ["1.25", "2.5", "3"] if kind.startswith("decimal") else ["2024-01-01 10:00:00.5", "2024-01-02 10:00:00", "2024-01-03"]
    texts = [t.split()[0] for t in texts] if kind == "date" else texts
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast(kind).alias("m"))
    assert loads.load_incremental(table, rows.orderBy("m").limit(2), "m")["rows_written"] == 2
    assert loads.load_incremental(table, rows, "m")["rows_written"] == 1
    assert loads.load_incremental(table, rows, "m")["rows_written"] == 0


def test_load_and_verify(spark, tmp_path):
    assert loads.load_and_verify(PublishedTable(spark, f"{tmp_path}/t"), products(spark, 77)) == {
        "rows_loaded": 77, "rows_verified": 77, "match": True}


def test_the_table_keeps_its_buckets_and_key(spark, tmp_path):
    first = PublishedTable(spark, f"{tmp_path}/t", key=["id"], buckets=32)
    loads.load_upsert(first, products(spark, 1000), "a")
    other = PublishedTable(spark, f"{tmp_path}/t", key=["id"], buckets=4)
    assert loads.load_upsert(other, products(spark, 300), "b")["net_new_rows"] == 0
    assert other.buckets == 32 and first.read().count() == 1000
    assert first.read().select("id").distinct().count() == 1000
    with pytest.raises(ValueError, match="key"):
        PublishedTable(spark, f"{tmp_path}/t", key=["productDisplayName"]).read()


def test_null_keys_are_rejected(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t", key=["id"], buckets=4)
    with pytest.raises(PublishRejected, match="NULL"):
        loads.load_upsert(table, names(spark, (1, "a"), (None, "b")), "r")
    assert not table.exists()


def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch, rows):
    table, other = (PublishedTable(spark, f"{tmp_path}/t") for _ in range(2))
    table.replace(names(spark, (1, "a")))
    write = PublishedTable._write

    def interrupted(self, df, version):
        parts = write(self, df, version)
        monkeypatch.setattr(PublishedTable, "_write", write)
        other.append(names(spark, (2, "b")))
        return parts

    monkeypatch.setattr(PublishedTable, "_write", interrupted)
    with pytest.raises(ConcurrentPublish):
        table.append(names(spark, (3, "c")))
    assert rows(table.read()) == [(1, "a"), (2, "b")]
    table.append(names(spark, (3, "c")))
    assert table.read().count() == 3


def test_vacuum_keeps_the_current_version(spark, tmp_path, rows):
    table = PublishedTable(spark, f"{tmp_path}/t")
    for i in range(3):
        table.replace(names(spark, (i, "x")))
    assert table.vacuum() == 0
    assert table.vacuum(keep_seconds=-1) == 4  # two folders and two versions
    assert rows(table.read()) == [(2, "x")] and table.state()["version"] == 3
    table.append(names(spark, (9, "y")))
    assert table.read().count() == 2


def test_a_batch_is_logged_with_its_own_size(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t", key=["id"], buckets=4)
    assert [loads.load_upsert(table, products(spark, n), "r")["rows_in_batch"] for n in (50, 20)] == [50, 20]


def test_rebuild_range_leaves_other_partitions(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    loads.rebuild_range(spark.createDataFrame([(1, 2020), (2, 2021)], "v int, y int"), path, ["y"])
    loads.rebuild_range(spark.createDataFrame([(9, 2021), (8, 2021)], "v int, y int"), path, ["y"])
    assert rows(spark.read.parquet(path)) == [(1, 2020), (8, 2021), (9, 2021)]


def test_rollback_gate(spark):
    report = lambda n: spark.createDataFrame([(True, "ROLLED_BACK", 5, n)], "inject_failure boolean, outcome string, row_count_before long, final_row_count long")
    loads.require_rollback(report(5))
    with pytest.raises(AssertionError):
        loads.require_rollback(report(6))


def test_files_and_run_log(spark, tmp_path, rows):
    paths = files.export_tables({"a": names(spark, (1, "x, \"y\"")), "b": names(spark, (2, None))}, str(tmp_path))
    assert set(paths) == {"a", "b"}
    assert spark.read.option("header", True).option("escape", '"').csv(paths["a"]).first()[1] == 'x, "y"'
    files.write_report(spark.sql("SELECT 1 AS n, map('k', 2) AS m"), f"{tmp_path}/report")
    (written,) = (tmp_path / "report").glob("*.json")
    assert json.loads(written.read_text()) == {"n": 1, "m": {"k": 2}}
    loads.log_run(spark, f"{tmp_path}/log", "r1", 5)
    loads.log_run(spark, f"{tmp_path}/log", "2", 6)
    loads.log_run(spark, f"{tmp_path}/log", "r1", 7)
    assert rows(loads.read_run_log(spark, f"{tmp_path}/log"), "run_id", "rows_upserted") == [("2", 6), ("r1", 7)]


def dated(spark, *pairs):
    return spark.createDataFrame(list(pairs), "day string, v int").withColumn("day", F.col("day").cast("date"))


def test_ranges_are_swapped_in_one_version(spark, tmp_path):
    table = RangedTable(spark, f"{tmp_path}/t", "day", "month")
    table.replace(dated(spark, ("2024-01-31", 1), ("2024-02-01", 2), ("2024-02-29", 3), ("2024-03-01", 4)))
    content = lambda: sorted(tuple(r) for r in table.read().select(F.col("day").cast("string"), "v").collect())
    before, files_before = content(), sorted(table.read().inputFiles())
    february = (date(2024, 2, 1), date(2024, 2, 29))
    bad = [
        dated(spark, ("2024-02-10", 9), ("2024-03-01", 9)),                                     # a row of another range
        dated(spark, ("2024-02-10", 9), (None, 9)),                                             # a row without a date
        dated(spark, ("2024-02-10", 9), ("2024-02-11", 8)).withColumn("v", F.expr("IF(v = 8, raise_error('broken'), v)")),
    ]
    for df in bad:
        with pytest.raises(Exception):
            table.swap(df, *february)
        assert content() == before and sorted(table.read().inputFiles()) == files_before and table.state()["version"] == 1
    done = table.swap(dated(spark, ("2024-02-10", 9)), *february)
    assert done["ranges_replaced"] == 1 and done["version"] == 2
    assert content() == [("2024-01-31", 1), ("2024-02-10", 9), ("2024-03-01", 4)]
    # the other ranges keep their files, and a read of some days opens those of their ranges only
    assert len(set(files_before) & set(table.read().inputFiles())) == 2
    assert {f.split("__bucket=")[1].split("/")[0] for f in table.between(date(2024, 2, 1), date(2024, 3, 1)).inputFiles()} == {"202402", "202403"}
    assert table.between(date(2024, 1, 1), date(2024, 1, 30)).count() == 0
    table.swap(dated(spark), date(2024, 1, 1), date(2024, 2, 29))
    assert content() == [("2024-03-01", 4)]


def test_two_replays_that_start_from_the_same_version(spark, tmp_path, monkeypatch):
    table, other = (RangedTable(spark, f"{tmp_path}/t", "day", "year") for _ in range(2))
    table.replace(dated(spark, ("2023-05-01", 1), ("2024-05-01", 2)))
    state = other.state()
    monkeypatch.setattr(other, "state", lambda: state)
    table.swap(dated(spark, ("2023-06-01", 3)), date(2023, 1, 1), date(2023, 12, 31))
    with pytest.raises(ConcurrentPublish):
        other.swap(dated(spark, ("2024-06-01", 4)), date(2024, 1, 1), date(2024, 12, 31))
    assert sorted(r.v for r in table.read().collect()) == [2, 3]


def test_joined_parts_keep_rows_and_versions(spark, tmp_path, rows):
    table = PublishedTable(spark, f"{tmp_path}/t", key=["id"], buckets=2)
    for i in range(9):
        table.append(names(spark, *[(10 * i + j, f"n{i}") for j in range(4)]))
    before, late = rows(table.read()), rows(table.read(since=6))
    early = [p for p in table.state()["parts"] if p["version"] <= 6]
    kept = len(table.state()["parts"]) - len(early)
    assert table.compact(at_least=5, up_to=6) == len(early) > 9
    assert rows(table.read()) == before and rows(table.read(since=6)) == late and rows(table.read(since=5)) != late
    assert len(table.state()["parts"]) == 2 + kept and table.compact(at_least=5, up_to=6) == 0
    # large parts stay when a few small ones have come
    big = PublishedTable(spark, f"{tmp_path}/big")
    big.append(products(spark, 1_000))
    for i in range(4):
        big.append(names(spark, (5_000 + i, "x")))
    assert big.compact(at_least=4) == 4 and sorted(p["rows"] for p in big.state()["parts"]) == [4, 1_000]


def test_buckets_that_are_not_named_cannot_be_written(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t", key=["id"], buckets=4)
    table.replace(products(spark, 40))
    one = table.read([1])
    with pytest.raises(PublishRejected, match="outside"):
        table.replace_buckets(products(spark, 40), [1])
    assert table.replace_buckets(one.withColumn("productDisplayName", F.lit("new")), [1])["rows_total"] == 40
    assert {r[0] for r in table.read([1]).select("productDisplayName").distinct().collect()} == {"new"}
