"""Exact vector search by cosine."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmarket.functions.text import bound

#: Rows that a block of queries is multiplied with at once, which bounds a task's memory.
ROWS = 1000


def normalised(v: Column) -> Column:
    """Unit length as array<double>; a zero vector stays as it is."""
    d = v.cast("array<double>")
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda s, x: s + x * x))
    # The norm is bound, or each element would measure it anew.
    return bound(norm, lambda n: F.transform(d, lambda x: x / F.when(n == 0, F.lit(1.0)).otherwise(n)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def wrong_size(vectors: DataFrame, dim: int) -> DataFrame:
    """Rows whose vector is null or not of the given length; empty before a load."""
    return vectors.where(F.col("embedding").isNull() | (F.size("embedding") != dim))


def top_k(vectors: DataFrame, query: list[float], k: int) -> DataFrame:
    """vec_id, score, rank of the k nearest to one query by cosine in double precision, ties to smaller ids."""
    q = F.array(*[F.lit(float(x)) for x in query]).cast("array<double>")
    scored = vectors.select("vec_id", dot(normalised(F.col("embedding")), normalised(q)).alias("score"))
    best = scored.orderBy(F.desc("score"), "vec_id").limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "vec_id")))


def _unit(rows: list, dim: int) -> np.ndarray:
    x = np.array(rows, np.float64).reshape(len(rows), dim)
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(norm == 0, 1.0, norm)


def _block(vectors: DataFrame, ids: list[int], queries: np.ndarray, k: int) -> DataFrame:
    """query_id, vec_id, score: in each task the k best of each query of a block, by matrix products."""
    held = vectors.sparkSession.sparkContext.broadcast((np.array(ids, np.int64), queries))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_id, q = held.value
        best: list[list[tuple[float, int]]] = [[] for _ in query_id]
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            fit = pa.compute.equal(pa.compute.list_value_length(batch.column(1)), q.shape[1]).fill_null(False)
            batch = batch.filter(fit)
            if not batch.num_rows:
                continue
            # A null component is no number here, so the row is like any other with one.
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            ident, x = batch.column(0).to_numpy(zero_copy_only=False), _unit(x, q.shape[1])
            rough = q @ x.T
            # Of a batch's rows only those count that reach a query's k-th best of this batch and of all before.
            floor = np.array([-max(b)[0] if len(b) >= k else -np.inf for b in best])
            n = min(k, len(ident))
            least = np.maximum(np.partition(rough, -n, axis=1)[:, -n], floor)
            # The product's last digits depend on a row's place, so equal vectors are scored again one by one.
            for j, at in zip(*np.nonzero(rough >= least[:, None] - 1e-9), strict=True):
                best[j].append((-float((q[j] * x[at]).sum()), int(ident[at])))
            for j, found in enumerate(best):
                if len(found) > k:
                    best[j] = sorted(found)[:k]
        flat = [(int(query_id[j]), i, -d) for j, found in enumerate(best) for d, i in found]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in flat], pa.int64()), pa.array([f[1] for f in flat], pa.int64()), pa.array([f[2] for f in flat], pa.float64())], ["query_id", "vec_id", "score"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(search, "query_id long, vec_id long, score double")


def top_k_many(vectors: DataFrame, queries: DataFrame, k: int, most: int = 1000, folder: str | None = None) -> DataFrame:
    """query_id, vec_id, score, rank for a stated set of queries, in blocks against all rows.

    Scores are cosines in double precision, ties go to smaller ids; vectors that are null or not as
    long as the queries take no part. The driver holds the queries of one block, about ``most``, at
    a time; each task keeps k rows a query. Queries for more than one block need a shared
    ``folder``, where the blocks' results are written.
    """
    spark = vectors.sparkSession
    queries = queries.where("query_id is not null and embedding is not null").select(F.col("query_id").cast("long"), F.col("embedding").cast("array<double>").alias("q"))
    blocks = max(1, math.ceil(queries.count() / most))
    found = None
    for n in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == n).collect()
        if not rows:
            continue
        one = _block(vectors, [r["query_id"] for r in rows], _unit([r["q"] for r in rows], len(rows[0]["q"])), k)
        if blocks == 1:
            found = one
        elif folder is None:
            raise ValueError("more queries than a block holds: give a shared folder")
        else:
            found = found or f"{folder}/{uuid.uuid4().hex}"
            one.write.mode("append").parquet(found)
    if found is None:
        return spark.createDataFrame([], "query_id long, vec_id long, score double, rank int")
    found = spark.read.parquet(found) if isinstance(found, str) else found
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
