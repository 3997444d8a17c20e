"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: A word is a run of characters other than white space, in Java and Python alike.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def let(value, use):
    """`use` of a value that is computed once: an expression inside a lambda would be computed for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


class Scratch:
    """Intermediate tables of one operator in the shared folder, dropped when nothing needs them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Write `df`, replacing what had this name, and read it back; the shuffles of the write are freed with it."""
        before, path = self.spark.conf.get(CLEANUP, None), scratch_path(self.spark, name)
        self.spark.conf.set(CLEANUP, "true")
        try:
            # a write plans anew, so it is planned under the setting
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables; none of the DataFrames that are still to be computed may read them."""
        for path in [self.paths.pop(n) for n in names if n in self.paths]:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Distributed union-find: (node, component) for every node of `links` (a, b), component = smallest node.

    Contraction by rounds: every node points to the lowest of itself and its
    neighbours, links between different targets go on to the next round, and in
    the end the pointers are followed back. Low means a low hash of the node, so
    that chains of rising ids halve as well; stars take two rounds. A round only
    joins and takes minima, which pre-aggregate in the tasks. Its tables are
    written to the shared folder, so a lost executor costs one stage, and nothing
    but the answer to "is anything left" reaches the driver.
    """
    scratch = Scratch(links.sparkSession)

    def clean(pairs: DataFrame, at: int) -> DataFrame:
        low = F.struct(F.xxhash64("a"), "a") < F.struct(F.xxhash64("b"), "b")
        pairs = pairs.filter("a <> b").select(F.when(low, F.col("a")).otherwise(F.col("b")).alias("a"),
                                              F.when(low, F.col("b")).otherwise(F.col("a")).alias("b"))
        return scratch.save(f"{name}-links-{at}", pairs.distinct())

    links, parents = clean(links.select("a", "b"), 0), []
    while not links.isEmpty():
        at = len(parents)
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("n"))).alias("m"))
        parent = scratch.save(f"{name}-parents-{at}", lowest.select("node", F.when(
            F.struct(F.col("m.h"), F.col("m.n")) < F.struct(F.xxhash64("node"), "node"), F.col("m.n"))
            .otherwise(F.col("node")).alias("parent")))
        parents.append(parent)
        moved = (links.join(parent.select(F.col("node").alias("a"), F.col("parent").alias("pa")), "a")
                 .join(parent.select(F.col("node").alias("b"), F.col("parent").alias("pb")), "b")
                 .select(F.col("pa").alias("a"), F.col("pb").alias("b")))
        # a node that others point to, and that points on itself
        onward = (parent.filter("node <> parent").select(F.col("parent").alias("via")).distinct()
                  .join(parent.select(F.col("node").alias("via"), "parent"), "via").filter("via <> parent")
                  .select(F.col("via").alias("a"), F.col("parent").alias("b")))
        links = clean(moved.unionByName(onward), at + 1)
        scratch.drop(f"{name}-links-{at}")
    if not parents:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = parents[-1].select("node", F.col("parent").alias("label"))
    for at in range(len(parents) - 2, -1, -1):
        # a target without links in later rounds is itself the end
        labels = scratch.save(f"{name}-labels-{at}", parents[at].join(
            labels.select(F.col("node").alias("parent"), "label"), "parent", "left")
            .select("node", F.coalesce("label", "parent").alias("label")))
        scratch.drop(f"{name}-labels-{at + 1}", f"{name}-parents-{at + 1}", f"{name}-parents-{at}")
    least = scratch.save(f"{name}-least", labels.groupBy("label").agg(F.min("node").alias("component")))
    return labels.join(least, "label").select("node", "component")
