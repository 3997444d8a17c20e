"""Centroid clustering with the threshold algorithm.

Every dimension has the list of centroids sorted by their value there. A vector
enters each list at its own value and walks outward, a step in all lists at a
time; every centroid that comes up first in some list gets its exact distance.
A centroid that has not come up yet is, in every dimension, at least as far as the
last entry taken there, so once the sum of these squared frontier distances
strictly exceeds the best exact distance, no other can win or tie. Ties go to the
smaller number. All arithmetic is in integers.

A round is one pass over the vectors: tasks assign and add up, for each cluster
and dimension, and Spark sums these parts (clusters x dimensions rows a task). To
the driver come the sums of a round, whose number does not depend on the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, table
from tidemark.llm.registry import query

CLUSTERS, ROUNDS, WIDTH, SCALE = 40, 5, 64, 256
ROWS = 4096          # vectors that walk together
LOW_BITS = 32        # sums are kept in two parts, so that 2 ** 31 rows of a task cannot overflow them
LONGEST = 2**63 - 1  # larger distances are given as this


class CentroidLists:
    """Centroids (k x width) with one sorted list for each dimension."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.numbers = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.numbers, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of each vector."""
        k, width = self.centroids.shape
        reach = max(int(np.abs(m).max(initial=0)) for m in (vectors, self.centroids)) * 2 + 1
        if reach * reach * max(width, 1) <= LONGEST:
            kind, far = np.int64, np.int64(LONGEST)
        else:  # too large for 64 bits: Python integers
            kind, far = object, reach * reach * width + 1
        vectors, centroids, values = (m.astype(kind) for m in (vectors, self.centroids, self.values))
        best, number = np.full(len(vectors), far, dtype=kind), np.full(len(vectors), k)
        seen = np.zeros((len(vectors), k), dtype=bool)
        # places of the next entry upward and downward, in lists with a far value on both ends
        ends = np.full((1, width), reach, dtype=kind)
        values = np.vstack([-ends * 2, values, ends * 2])
        numbers = np.vstack([np.zeros((1, width), dtype=int), self.numbers, np.zeros((1, width), dtype=int)])
        up = np.empty(vectors.shape, dtype=np.int64)
        for d in range(width):
            up[:, d] = np.searchsorted(values[:, d], vectors[:, d])
        down, column = up - 1, np.arange(width)
        open_ = np.arange(len(vectors))
        while len(open_):
            own, high, low = vectors[open_], up[open_], down[open_]
            above, below = values[high, column] - own, own - values[low, column]
            upward = above <= below
            taken = numbers[np.where(upward, high, low), column]
            gaps = np.where(upward, above, below)
            up[open_], down[open_] = high + upward, low - ~upward
            new = np.zeros((len(open_), k), dtype=bool)
            new[np.arange(len(open_))[:, None], taken] = True
            new &= ~seen[open_]
            seen[open_] |= new
            for c in np.flatnonzero(new.any(axis=0)):  # by rising number, so the first of equals stays
                at = open_[new[:, c]]
                apart = vectors[at] - centroids[c]
                distance = (apart * apart).sum(axis=1)
                better = (distance < best[at]) | ((distance == best[at]) & (c < number[at]))
                best[at[better]], number[at[better]] = distance[better], c
            frontier = (gaps * gaps).sum(axis=1)
            open_ = open_[~((frontier > best[open_]) | seen[open_].all(axis=1)).astype(bool)]
        return number.astype(np.int32), best


def quantised(vectors: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>): floor(scale * component) of the vectors that take part.

    Left out: NULL vectors, other widths, NULL or non-finite components. Products
    beyond 64 bits become the largest or smallest 64-bit integer.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    used = vectors.select("vec_id", x.cast("array<double>").alias("embedding")).filter(x.isNotNull() & (F.size(x) == width) & finite)
    return used.select("vec_id", F.transform("embedding", lambda c: F.floor(c * scale).cast("long")).alias("v"))


def seeds(rows: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors of smallest sha256 of salt and id, by rising hash; equal ids by their components."""
    mark = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = rows.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()  # k rows
    return np.array([r.v for r in first], dtype=np.int64)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floor of the mean of their vectors; one without vectors stays."""
    k, width = centroids.shape

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = CentroidLists(centroids)
        high, low, count = np.zeros((k, width), np.int64), np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for batch in _blocks(batches):
            vectors = _matrix(batch.column(0), width)
            number, _ = lists.nearest(vectors)
            count += np.bincount(number, minlength=k)
            for c in np.unique(number):
                own = vectors[number == c]
                high[c] += (own >> LOW_BITS).sum(axis=0)
                low[c] += (own & (1 << LOW_BITS) - 1).sum(axis=0)
        c, d = np.nonzero(np.broadcast_to(count[:, None] > 0, (k, width)))
        columns = [c.astype(np.int32), d.astype(np.int32), high[c, d], low[c, d], count[c]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["cluster", "at", "high", "low", "n"])

    sums = rows.select("v").mapInArrow(parts, "cluster int, at int, high long, low long, n long").groupBy("cluster", "at").agg(
        *(F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")), F.sum("n").alias("n"))
    after = centroids.copy()
    for r in sums.collect():  # at most k x width rows
        after[r.cluster, r.at] = ((int(r.high) << LOW_BITS) + int(r.low)) // r.n
    return after


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of quantised vectors."""
    width = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = CentroidLists(centroids)
        for batch in _blocks(batches):
            number, distance = lists.nearest(_matrix(batch.column(1), width))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number), pa.array(
                np.minimum(distance, LONGEST).astype(np.int64))], names=["vec_id", "cluster", "distance"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "v").mapInArrow(assign, f"vec_id {kind}, cluster int, distance long")


@dataclass(frozen=True)
class Clustering:
    """`rows` (vec_id, cluster, distance), one for each vector that takes part, and the final centroids."""

    rows: DataFrame
    centroids: np.ndarray


def clustered(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE,
              salt: str = "2:") -> Clustering:
    """k-means from the k vectors of smallest hash, by a fixed number of rounds.

    Left out are NULL vectors, other widths and NULL or non-finite components; an
    empty table or one without such vectors gives no rows. A NULL id is hashed as
    an empty text. A repeated row is a vector of its own, so it can also be two
    centroids; the smaller number then takes all. With fewer than k vectors there
    are as many centroids. Distances beyond 64 bits are given as 2^63 - 1. Other
    columns are left out.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = scratch.save("vectors", quantised(vectors, width, scale))
    centroids = seeds(rows, k, salt)
    if not len(centroids):
        return Clustering(rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids)
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    found = scratch.save("assigned", assigned(rows, centroids))
    scratch.drop("vectors")
    return Clustering(found, centroids)


def with_inertia(found: Clustering) -> DataFrame:
    """Rows with the distance summed over their cluster and over all, and a checksum of their centroid."""
    sums = {r.cluster: int(r.total) for r in found.rows.groupBy("cluster").agg(  # at most k rows
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()}
    total = min(sum(sums.values()), LONGEST)

    def by_cluster(values: dict, kind: str):
        pairs = [F.lit(x) for c in sorted(values) for x in (c, values[c])]
        return F.element_at(F.create_map(*pairs), F.col("cluster")).cast(kind) if pairs else F.lit(None).cast(kind)

    marks = {c: hashlib.sha256(",".join(map(str, v.tolist())).encode()).hexdigest() for c, v in enumerate(found.centroids)}
    return found.rows.select("vec_id", "cluster", "distance",
                             by_cluster({c: min(s, LONGEST) for c, s in sums.items()}, "long").alias("cluster_inertia"),
                             F.lit(total).cast("long").alias("inertia"), by_cluster(marks, "string").alias("centroid_sha256"))


def _oracle() -> str:
    """The same by comparing every vector with every centroid, one table expression a round."""
    distance = "CAST(list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    nearest = (f"SELECT vec_id, v, cluster, distance FROM (SELECT v.line, v.vec_id, v.v, c.cluster, {distance} AS distance FROM v, {{}} c) "
               "QUALIFY row_number() OVER (PARTITION BY line ORDER BY distance, cluster) = 1")
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS line, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY mark, v) - 1 AS INTEGER) AS cluster, v FROM
  (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS mark, v FROM v ORDER BY mark, v LIMIT {CLUSTERS}))"""]
    for n in range(ROUNDS):
        steps += [f"a{n} AS MATERIALIZED ({nearest.format(f'c{n}')})",
                  f"""m{n} AS MATERIALIZED (SELECT cluster, list(mean ORDER BY place) AS v FROM (
  SELECT cluster, place, CAST((s - (((s % n) + n) % n)) // n AS BIGINT) AS mean FROM (
    SELECT cluster, place, sum(x) AS s, count(*) AS n FROM (
      SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{n}) GROUP BY cluster, place)) GROUP BY cluster)""",
                  f"c{n + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m USING (cluster))"]
    last = f"c{ROUNDS}"
    return f"""WITH {', '.join(steps)}, f AS MATERIALIZED ({nearest.format(last)})
SELECT f.vec_id, f.cluster, f.distance, CAST(sum(f.distance) OVER (PARTITION BY f.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(f.distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c.v, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256
FROM f JOIN {last} c USING (cluster)"""


ORACLE = _oracle()


@query("op12_centroid_clusters", ORACLE)
def op12_centroid_clusters(spark, sf_dir):
    return with_inertia(clustered(table(spark, sf_dir, "embeddings")))
