"""Exact top-k search by inner product over vectors sorted by length.

Vectors are turned into integers and cut into blocks of falling length. The block
of the longest vectors gives every query a lower bound for its k-th score. By
Cauchy-Schwarz a query then needs only the blocks whose longest vector could
reach that bound, which are the first ones. Inside a block the vectors are
rotated into the axes of the corpus (the right singular vectors, from the matrix
of second moments): the inner product over the leading axes plus the product of
the residual lengths bounds the whole, and only vectors whose bound reaches the
query's k-th score so far are multiplied out, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.registry import query
from tidemark.session import materialise

SCALE = 1024
BLOCK_ROWS = 4096  # vectors of a block
QUERY_ROWS = 1024  # queries of a block
STEP = 512         # vectors between two updates of the bounds
FOUND = "query_id long, vec_id long, score long"
SLACK = 1e-6       # relative room for rounding in the bounds


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>, length double): floor(scale * component) of the vectors that take part.

    Left out: NULL vectors and ids, empty vectors, NULL or non-finite components.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    used = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding"))
    used = used.filter(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & finite)
    return used.select("vec_id", F.transform("embedding", lambda c: F.floor(c * scale).cast("long")).alias("v")).withColumn(
        "length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))))


def rotation(vectors: DataFrame) -> np.ndarray:
    """Axes of the corpus as columns, strongest first, from the summed products of components (width x width values)."""
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 0

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            m = matrix(batch["v"], width).astype(float)
            total += m.T @ m
        at = np.arange(width * width)
        yield pd.DataFrame({"at": at, "total": total.reshape(-1)})

    if not width:
        return np.zeros((0, 0))
    sums = vectors.select("v").mapInPandas(products, "at int, total double").groupBy("at").agg(F.sum("total").alias("total"))
    moments = np.zeros(width * width)
    for at, total in sums.collect():  # width x width rows
        moments[at] = total
    return np.linalg.eigh(moments.reshape(width, width))[1][:, ::-1].copy()


def matrix(values: pd.Series, width: int) -> np.ndarray:
    """Rows of integers; shorter vectors are padded with zeros."""
    out = np.zeros((len(values), width), dtype=np.int64)
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of paired rows."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2**62:
        return np.einsum("ij,ij->i", a, b)
    exact = (a.astype(object) * b.astype(object)).sum(axis=1)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def search_block(queries: pd.DataFrame, rows: pd.DataFrame, axes: np.ndarray, k: int) -> pd.DataFrame:
    """Up to k best rows of one block for each query; `bound` is the query's known k-th score or NULL."""
    width = len(axes)
    rows = rows.sort_values(["length", "vec_id"], ascending=[False, True], ignore_index=True)
    q, x = matrix(queries["v"], width), matrix(rows["v"], width)
    q_id, x_id = queries["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
    q_len, x_len = queries["length"].to_numpy(), rows["length"].to_numpy()
    lead = max(1, width // 4)
    q_axes, x_axes = q @ axes, x @ axes
    q_rest, x_rest = (np.sqrt((m[:, lead:] ** 2).sum(axis=1)) for m in (q_axes, x_axes))
    bound = queries["bound"].to_numpy(dtype=float, na_value=-np.inf)
    best_score = np.empty((len(q), 0), dtype=np.int64)
    best_id = np.empty((len(q), 0), dtype=np.int64)
    valid = np.empty((len(q), 0), dtype=bool)
    for at in range(0, len(x), STEP):
        part = slice(at, min(at + STEP, len(x)))
        room = SLACK * q_len * x_len[at] + SLACK
        live = np.flatnonzero(q_len * x_len[at] + room >= bound)  # rows from here on are no longer than x[at]
        if not len(live):
            break
        upper = q_axes[live, :lead] @ x_axes[part, :lead].T + np.outer(q_rest[live], x_rest[part])
        may = (upper + room[live, None] >= bound[live, None]) & (q_id[live, None] != x_id[None, part])
        i, j = np.nonzero(may)
        score = np.zeros((len(q), part.stop - at), dtype=np.int64)
        have = np.zeros(score.shape, dtype=bool)
        have[live[i], j] = True
        for some in range(0, len(i), 1 << 18):
            a, b = live[i[some:some + (1 << 18)]], j[some:some + (1 << 18)]
            score[a, b] = inner(q[a], x[at + b])
        best_score = np.hstack([best_score, score])
        best_id = np.hstack([best_id, np.broadcast_to(x_id[part], score.shape)])
        valid = np.hstack([valid, have])
        # valid ones first, then by score, then by the smaller id
        order = np.lexsort((best_id, ~best_score, ~valid), axis=1)[:, :k]
        best_score, best_id, valid = (np.take_along_axis(m, order, axis=1) for m in (best_score, best_id, valid))
        if best_score.shape[1] == k:
            bound = np.where(valid[:, -1], np.maximum(bound, best_score[:, -1].astype(float)), bound)
    i, j = np.nonzero(valid)
    return pd.DataFrame({"query_id": q_id[i], "vec_id": best_id[i, j], "score": best_score[i, j]})


def top_k(vectors: DataFrame, is_query: str = "vec_id % 100 = 0", k: int = 10, scale: int = SCALE,
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product for each query, ties to the smaller id.

    Every row but the query's own is a candidate. Vectors that are NULL or have
    NULL or non-finite components, and rows without id, take no part; a shorter
    vector counts as padded with zeros; a repeated row (same id) appears as often
    as it is there, except for its own id. Products beyond 64 bits are clipped.
    """
    rows = materialise(quantised(vectors, scale), "vectors")
    n_rows = rows.count()
    axes = rotation(rows)
    blocks = max(1, -(-n_rows // block_rows))
    placed = materialise(rows.repartitionByRange(blocks, F.col("length").desc(), "vec_id")
                         .withColumn("block", F.spark_partition_id()), "vector-blocks")
    # the longest vector of each block, one number per block
    longest = dict(placed.groupBy("block").agg(F.max("length")).collect())
    order = sorted(longest, key=lambda b: (-longest[b], b))
    queries = rows.filter(is_query).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 31)))
    parts = max(1, -(-queries.count() // query_rows))
    queries = queries.select("vec_id", "v", "length", F.pmod("part", F.lit(parts)).cast("int").alias("part"))

    def search(pairs: DataFrame) -> DataFrame:
        """`pairs`: queries with the blocks that they need."""
        wanted = pairs.select(F.col("part").alias("for_part"), F.col("block").alias("for_block")).distinct()
        copies = placed.join(wanted, F.col("block") == F.col("for_block")).select("vec_id", "v", "length", "for_part", "for_block")
        found = pairs.groupBy("part", "block").cogroup(copies.groupBy("for_part", "for_block")).applyInPandas(
            lambda q, x: search_block(q, x, axes, k) if len(q) and len(x) else
            pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64"), FOUND)
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    if not order:
        return spark_empty(vectors)
    every = materialise(queries.withColumn("block", F.lit(order[0])).withColumn("bound", F.lit(None).cast("long")), "first-queries")
    first = materialise(search(every), "first-found").drop("rank")
    bounds = first.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.when(F.count("*") >= k, F.min("score")).alias("bound"))
    bounded = queries.join(bounds, "vec_id", "left").select("vec_id", "v", "length", "part", "bound")
    rest = F.array(*[F.struct(F.lit(b).alias("block"), F.lit(float(longest[b])).alias("reach")) for b in order[1:]])
    if len(order) > 1:
        needed = F.filter(rest, lambda b: F.col("bound").isNull() | (
            F.col("length") * b["reach"] * (1 + SLACK) + SLACK >= F.col("bound")))
        later = search(materialise(bounded.withColumn("need", F.explode(needed))
                                   .select("vec_id", "v", "length", "part", "bound", "need.block"), "query-blocks")).drop("rank")
        first = first.unionByName(later)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def spark_empty(vectors: DataFrame) -> DataFrame:
    return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")


ORACLE = f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id,
  CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 10"""


@query("op9_exact_top_k", ORACLE)
def op9_exact_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"))
