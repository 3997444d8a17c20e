import pytest

from tidemark import session
from tidemark.session import run_together


def test_intermediate_tables_go_to_the_configured_folder(spark):
    path = session.scratch_path(spark, "t")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and spark.sparkContext.applicationId in path
    assert session.scratch_path(spark, "t") != path


class Conf:
    def get(self, key, default):
        return default


class Session:
    conf = Conf()

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})()


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session("yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session("local-cluster[2,1,1024]"))
    local = Session("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_a_written_table_is_read_back_whole_and_can_be_dropped(spark, monkeypatch, tmp_path, rows):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    df = spark.range(10).selectExpr("id", "rand() AS r", "CAST(NULL AS STRING) AS s")
    fixed = session.materialise(df, "t")
    assert fixed.dtypes == df.dtypes and rows(fixed) == rows(fixed)
    assert session.drop_scratch(spark) and not list((tmp_path / "tidemark").iterdir())


def test_a_temporary_table_goes_with_its_block(spark):
    with session.temporary(spark.range(3), "t") as df:
        assert df.count() == 3
        path = df.inputFiles()[0]
    from pathlib import Path

    assert not Path(path.removeprefix("file://")).exists()


def test_shuffles_grow_with_the_input():
    assert session.shuffle_partitions(1) == 200
    assert session.shuffle_partitions(session.DEFAULT_INPUT_BYTES) == 4096
    assert session.shuffle_partitions(100 * 10**12) == 186265


def test_independent_jobs_run_together(spark):
    found = run_together(spark, {n: (lambda n=n: spark.range(n).count()) for n in (3, 5, 9)})
    assert found == {3: 3, 5: 5, 9: 9}
    with pytest.raises(ZeroDivisionError):
        run_together(spark, {"good": lambda: 1, "bad": lambda: 1 // 0})
    assert run_together(spark, {}) == {}
