"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # state of streaming queries lives on disk, not on the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


#: Input that an application is sized for when nothing is said: 4096 reduce tasks.
DEFAULT_INPUT_BYTES = 2 << 40


def shuffle_partitions(input_bytes: int, per_task: int = 512 << 20, at_least: int = 200) -> int:
    """Reduce tasks for a job that shuffles about `input_bytes`; adaptive execution joins small ones."""
    return max(at_least, -(-input_bytes // per_task))


def build_session(app_name: str = "tidemark", master: str | None = None, input_bytes: int | None = None,
                  **extra: str) -> SparkSession:
    """A session with the settings the library relies on; `extra` uses `_` for `.`.

    `input_bytes` sizes the shuffles of the application, so that one reduce task
    fits in an executor's memory. Adaptive execution joins small reduce tasks and
    adds none, so an unknown input counts as a large one.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes or DEFAULT_INPUT_BYTES)))
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, named by `spark.checkpoint.dir`.

    A machine-local folder is used only when the setting is absent and the
    whole application runs in one local JVM; it goes when the application ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_folders:
        folder = _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _local_folders[context.applicationId]


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidemark/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables, at its end when no DataFrame needs them any more."""
    return drop_path(spark, _scratch_root(spark))


def drop_path(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def temporary(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """`df` written to the shared folder, for as long as the block runs."""
    path = scratch_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        drop_path(df.sparkSession, path)


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    The written table survives executor loss, so values assigned by a
    non-deterministic plan (row positions, samples) stay fixed afterwards.
    """
    path = scratch_path(df.sparkSession, name)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_together(spark: SparkSession, actions: dict[str, Callable[[], object]], at_once: int = 4) -> dict[str, object]:
    """Results of independent actions, some of which run at the same time; the first failure is raised when all have ended.

    Small jobs leave most of a cluster idle, and several of them fill it better.
    """
    with ThreadPoolExecutor(at_once) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(action)) for name, action in actions.items()}
    return {name: future.result() for name, future in running.items()}
