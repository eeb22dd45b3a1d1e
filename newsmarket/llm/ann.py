"""Approximate nearest neighbours: inverted file of coarse centroids with product-quantised residuals.

Equal vectors are one entry that keeps its k + 1 smallest ids (enough for any answer, as ties go
to smaller ids). Centroids and codebooks come from a bounded sample; every entry is indexed. A
query probes the cells of its nearest centroids. Cells lie in slices of a bounded number of entries,
near cells together and a large cell in several, so a query goes once to each slice that holds one of
its cells. There one asymmetric distance table of the query ranks the codes of all its cells, the best are
measured again on the original vectors, and so is every entry whose code, with the distance kept between code
and vector, doesn't rule it out; so codes lose nothing, however dense a cell is. The nearest of all slices
remain. A query that finds too few entries is asked again of all cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, shared_dir, stored

#: Distinct vectors that centroids and codebooks are fitted on, at most; those of the smallest hashes.
FIT_ROWS = 20_000
PARTS, CODES = 16, 256
#: Entries of a slice, and queries that meet a copy of it at once.
BLOCK, QUERIES = 512, 2048
#: Codes measured exactly first, from each slice.
SHORTLIST = 50
#: Share of the sample's true neighbours that must lie in the probed cells, and the queries it is measured with.
COVERED, TRIALS = 0.96, 256
K = 10


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None]


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _distances(x, c).argmin(1)
        order = np.argsort(near, kind="stable")
        used, at, n = np.unique(near[order], return_index=True, return_counts=True)
        c[used] = np.add.reduceat(x[order], at, axis=0) / n[:, None]
    return c


class Index:
    """Centroids and codebooks."""

    def __init__(self, sample: np.ndarray, cells: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.dim, self.trials = sample.shape[1], sample[:0]
        # Rows far from the origin but near each other would lose their digits in products.
        self.mid = sample.mean(0)
        sample = sample - self.mid
        self.cells = _kmeans(sample, cells, 10, rng)
        rest = sample - self.cells[_distances(sample, self.cells).argmin(1)]
        self.bounds = np.linspace(0, self.dim, min(PARTS, self.dim) + 1).astype(int)
        self.books = [_kmeans(rest[:, a:b], CODES, 8, rng) for a, b in zip(self.bounds[:-1], self.bounds[1:], strict=True)]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and codes of each vector."""
        x = x - self.mid
        cell = _distances(x, self.cells).argmin(1)
        rest = x - self.cells[cell]
        codes = [_distances(rest[:, a:b], book).argmin(1) for a, b, book in zip(self.bounds[:-1], self.bounds[1:], self.books, strict=True)]
        return cell, np.stack(codes, 1).astype(np.uint8)

    def rests(self, codes: np.ndarray) -> np.ndarray:
        """The residuals that codes stand for."""
        return np.concatenate([book[codes[:, k]] for k, book in enumerate(self.books)], axis=1)

    def far(self, q: np.ndarray) -> np.ndarray:
        """Squared distances to the centroids, which order a query's cells."""
        return _distances(q - self.mid, self.cells)

    def probes(self, q: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(self.far(q), axis=1, kind="stable")[:, :n]

    def probes_needed(self, sample: np.ndarray, k: int) -> int:
        """Cells to probe so that COVERED of the neighbours in the sample of the trial queries are met, of those asked and
        of the sample's own. Where vectors have little structure these are many; a larger table has nearer neighbours and
        needs no more.
        """
        return max(self._needed(sample, k, q) for q in (sample[:TRIALS], self.trials) if len(q))

    def _needed(self, sample: np.ndarray, k: int, q: np.ndarray) -> int:
        d = _distances(q - self.mid, sample - self.mid)
        own = {v.tobytes(): i for i, v in enumerate(sample)}
        for j, v in enumerate(q):
            d[j, own.get(v.tobytes(), [])] = np.inf
        k = min(k, len(sample) - 1)
        if k < 1:
            return 1
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        cell = self.far(sample).argmin(1)
        place = np.argsort(self.probes(q, len(self.cells)), axis=1)  # place of each cell in a query's order
        return int(np.quantile(place[np.arange(len(q))[:, None], cell[near]], COVERED)) + 1

    def constants(self, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What a query does not change in the squared distance to a code: 2 c.r + r.r for centroid c, residual code r."""
        rest = self.rests(codes)
        return 2 * (self.cells[cell] * rest).sum(1) + (rest * rest).sum(1)

    def errors(self, x: np.ndarray, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Distances between vectors and what their codes stand for."""
        return np.sqrt(((x - self.mid - self.cells[cell] - self.rests(codes)) ** 2).sum(1))

    def table(self, q: np.ndarray) -> np.ndarray:
        """-2 q.r of a query for each part's codes, (parts, CODES)."""
        q = q - self.mid
        out = np.zeros((len(self.books), CODES))
        for k, (a, b, book) in enumerate(zip(self.bounds[:-1], self.bounds[1:], self.books, strict=True)):
            out[k, : len(book)] = -2 * book @ q[a:b]
        return out

    def slices(self, sizes: dict[int, int]) -> list[list[int]]:
        """The slices of each cell: near cells share one up to BLOCK entries, a larger cell has several of its own."""
        mid = self.cells - self.cells.mean(0)
        along = mid @ np.linalg.svd(mid, full_matrices=False)[2][0]
        out: list[list[int]] = [[] for _ in self.cells]
        now, held = 0, 0
        for c in np.argsort(along, kind="stable").tolist():
            n = sizes.get(c, 0)
            if held and held + n > BLOCK:
                now, held = now + 1, 0
            many = max(1, -(-n // BLOCK))
            out[c] = list(range(now, now + many))
            now, held = (now + many, 0) if many > 1 else (now, held + n)
        return out


def cells_for(n: int) -> int:
    """Cells grow with the vectors, up to what the fit sample supports."""
    return int(min(max(8, n // 20), FIT_ROWS // 20))


def usable(vectors: DataFrame, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """vec_id, v (array<double>) of the rows that take part: no null, zero or non-finite vectors."""
    v = F.col(col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _packed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in frames:
        yield pa.RecordBatch.from_arrays([pa.array([np.array(v, np.float64).tobytes() for v in b.column(0).to_pylist()], pa.binary()), *b.columns[1:]], ["vec", *b.schema.names[1:]])


def _search(index: Index, k: int, probes: int):
    def run(key: tuple, entries: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if entries.num_rows and queries.num_rows:
            x, codes = _matrix(entries["vec"]), np.frombuffer(b"".join(entries["code"].to_pylist()), np.uint8).reshape(entries.num_rows, -1)
            cell, ids, part = entries["cell"].to_numpy(), entries["ids"].to_pylist(), np.arange(codes.shape[1])
            fixed, asked, off = index.constants(cell, codes), _matrix(queries["vec"]), index.errors(x, cell, codes)
            far, most = index.far(asked), max(SHORTLIST, k + 1)
            # What rounding may add to a squared distance of a code.
            loose = 1e-12 * ((index.cells[cell] ** 2).sum(1) + (index.rests(codes) ** 2).sum(1))
            wide = 1e-12 * ((asked - index.mid) ** 2).sum(1)
            for j, qid in enumerate(queries["query_id"].to_pylist()):
                probed = np.zeros(len(index.cells), bool)
                probed[np.argsort(far[j], kind="stable")[:probes]] = True
                at = np.flatnonzero(probed[cell])
                if len(at) > most:
                    rough = far[j][cell[at]] + fixed[at] + index.table(asked[j])[part, codes[at]].sum(1)
                    first = np.argpartition(rough, most)[:most]
                    # No more than k + 1 entries, one of them the query's own, can matter; a code tells its vector's distance up to the error.
                    kth = np.partition(((x[at[first]] - asked[j]) ** 2).sum(1), k)[k]
                    least = np.sqrt(np.maximum(rough - loose[at] - wide[j], 0)) - off[at]
                    at = at[least <= np.sqrt(kth) * (1 + 1e-9)]
                exact = np.sqrt(((x[at] - asked[j]) ** 2).sum(1))
                if len(at) > k + 1:
                    best = exact <= np.partition(exact, k)[k]
                    at, exact = at[best], exact[best]
                near = sorted((d, i) for d, e in zip(exact.tolist(), at.tolist(), strict=True) for i in ids[e] if i != qid)
                found += [(qid, i, d) for d, i in near[:k]]
        return pa.table({"query_id": pa.array([f[0] for f in found], pa.int64()), "vec_id": pa.array([f[1] for f in found], pa.int64()), "score": pa.array([f[2] for f in found], pa.float64())})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest entries found for each query, without itself.

    vectors, queries: vec_id, v as ``usable`` gives them, of one length (the commonest; other lengths take no part).
    Ties go to smaller ids; with fewer candidates all found come back. A repeated vec_id is one candidate for
    each different vector.
    """
    spark = vectors.sparkSession
    path = shared_dir(spark)
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = vectors.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if size is None:
        return none
    alike = F.size("v") == size["dim"]
    # The rank is limited in each task before rows move, so a vector sends k + 1 ids of a task at most.
    packed = vectors.where(alike).select("v", "vec_id").mapInArrow(_packed, "vec binary, vec_id long")
    ranked = packed.withColumn("_rank", F.dense_rank().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("_rank") <= k + 1)
    entries = stored(ranked.groupBy("vec").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")), f"{path}/entries")
    n = entries.count()
    sample = entries.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(FIT_ROWS).collect()
    sample = np.stack([np.frombuffer(r["vec"], np.float64) for r in sample])
    index = Index(sample, cells_for(n))
    asked = queries.where(alike).select("v", F.col("vec_id").alias("query_id")).distinct().mapInArrow(_packed, "vec binary, query_id long")
    trials = asked.select("vec").distinct().orderBy(F.xxhash64("vec"), "vec").limit(TRIALS).collect()
    if not trials:
        return none
    index.trials = np.stack([np.frombuffer(r["vec"], np.float64) for r in trials])
    probes = index.probes_needed(sample, k)
    held = spark.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cell, codes = held.value.place(_matrix(b.column(0)))
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), *b.columns], ["cell", "code", "vec", "ids"])

    placed = stored(entries.mapInArrow(place, "cell int, code binary, vec binary, ids array<long>"), f"{path}/index")
    sizes = dict(placed.groupBy("cell").count().collect())  # a row for each cell
    of_cell = index.slices(sizes)
    table = spark.createDataFrame([(c, s) for c, s in enumerate(of_cell)], "cell int, slices array<int>")
    spot = F.pmod(F.xxhash64("vec"), F.size("slices")).cast("int")
    placed = placed.join(F.broadcast(table), "cell").select(F.get("slices", spot).alias("slice"), "cell", "code", "vec", "ids")

    def search(asked: DataFrame, probes: int) -> DataFrame:
        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    to = [sorted({s for c in cells for s in of_cell[c]}) for cells in held.value.probes(_matrix(b.column(0)), probes).tolist()]
                    at = pa.array(np.repeat(np.arange(b.num_rows), [len(t) for t in to]))
                    yield pa.RecordBatch.from_arrays([pa.array([s for t in to for s in t], pa.int32()), b.column(1).take(at), b.column(0).take(at)], ["slice", "query_id", "vec"])

        sent = stored(asked.mapInArrow(probe, "slice int, query_id long, vec binary"), f"{path}/sent{probes}")
        # A slice has a copy for each block of the queries that probe it, so no group holds more than one of each.
        blocks = sent.groupBy("slice").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
        copies = placed.join(blocks, "slice").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        sent = sent.join(blocks, "slice").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int")).drop("blocks")
        found = copies.groupBy("slice", "block").cogroup(sent.groupBy("slice", "block")).applyInArrow(_search(index, k, probes), "query_id long, vec_id long, score double")
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", F.row_number().over(order))
        return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    if probes >= len(index.cells):
        return search(asked, len(index.cells))
    found = stored(search(asked, probes), f"{path}/found")
    full = found.where(F.col("rank") == k).select("query_id")
    few = asked.join(full, "query_id", "left_anti").select("vec", "query_id")
    if few.isEmpty():
        return found
    return found.join(full, "query_id", "left_semi").unionByName(search(few, len(index.cells)))


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(read(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))
