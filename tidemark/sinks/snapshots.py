"""Keeping the snapshot that the next change detection compares with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.session import temporary
from tidemark.sinks.published import PublishedTable


def change_log_of(table: PublishedTable) -> PublishedTable:
    """The log of all changes that `track_changes` found for a snapshot table."""
    return PublishedTable(table.spark, f"{table.root}-changes")


def bucket_digests(table: PublishedTable, snapshot: DataFrame) -> dict[str, str]:
    """Bucket of the table → digest of its rows, which does not depend on their order; one value a bucket."""
    one = F.xxhash64(*sorted(snapshot.columns))
    found = snapshot.groupBy(table.bucket_of().alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(one.cast("decimal(20,0)")).alias("total"), F.bit_xor(one).alias("mixed")).collect()
    return {str(r.bucket): f"{r.n}:{r.total}:{r.mixed}" for r in found}


def differing(before: dict[str, str], after: dict[str, str], buckets: int, fan_out: int = 16) -> list[int]:
    """Buckets with different digests, found from the top of a tree of digests down."""
    def digest(side: dict[str, str], first: int, size: int) -> list[str | None]:
        return [side.get(str(b)) for b in range(first, min(first + size, buckets))]

    size = 1
    while size < buckets:
        size *= fan_out
    nodes = [0]
    while True:
        nodes = [node for node in nodes if digest(before, node, size) != digest(after, node, size)]
        if size == 1 or not nodes:
            return nodes
        size //= fan_out
        nodes = [at for node in nodes for at in range(node, min(node + size * fan_out, buckets), size)]


def track_changes_by_digest(table: PublishedTable, current: DataFrame, key: str, columns: list[str] | None = None,
                            last_by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """As `track_changes`, for a table with `key`: only buckets whose digests differ are read, compared and written.

    The digests of its buckets are kept with the snapshot, and those of the current
    rows come from one pass that adds up in the tasks. Whatever happens to the rest
    of the rows, the cost of comparing follows the buckets that changed.
    """
    if table.key != [key]:
        raise ValueError(f"the snapshot table has the key {table.key}, not {[key]}")
    log, state = change_log_of(table), table.state()
    version = state["version"]
    with temporary(cdc.snapshot(current, key, columns, last_by), "snapshot") as now:
        after = bucket_digests(table, now)
        changed = differing(state["marks"].get("digests", {}), after, table.buckets)
        moved = now.filter(table.bucket_of().isin(changed)) if changed else now.limit(0)
        if log.state()["marks"].get("snapshot_version", -1) < version:
            before = table.read(changed) if version else now.limit(0)
            found = cdc.change_log(cdc.diff_snapshots(before, moved, key)).withColumn("snapshot_version", F.lit(version))
            log.append(found, {"snapshot_version": version})
        table.replace_buckets(moved, changed, {"digests": after})
    changes = log.read().filter(F.col("snapshot_version") == version).select(key, "op")
    return changes, cdc.change_counts(changes, table.read())


def track_changes(table: PublishedTable, current: DataFrame, key: str, columns: list[str] | None = None,
                  last_by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(changes, counts) since the snapshot in `table`, which then becomes the current one.

    The changes are appended to the published log before the snapshot moves. The
    log remembers which version of the snapshot they belong to: a run that failed
    in between finds its changes there and only moves the snapshot.
    """
    log, version = change_log_of(table), table.state()["version"]
    with temporary(cdc.snapshot(current, key, columns, last_by), "snapshot") as now:
        if log.state()["marks"].get("snapshot_version", -1) < version:
            before = table.read() if table.exists() else now.limit(0)
            found = cdc.change_log(cdc.diff_snapshots(before, now, key)).withColumn("snapshot_version", F.lit(version))
            log.append(found, {"snapshot_version": version})
        table.replace(now)
    changes = log.read().filter(F.col("snapshot_version") == version).select(key, "op")
    return changes, cdc.change_counts(changes, table.read())
