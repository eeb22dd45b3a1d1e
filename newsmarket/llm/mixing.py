"""Mixing to target weights by soft domain membership.

A softmax classifier on byte profiles, fitted on a bounded sample of a labelled table, gives each
document posteriors p over K domains. With n tokens a document adds rate * n * p to the expected
domain totals. Rates start at 1 and follow projected gradient steps of the least squares distance
to the targets, in the metric of the Gram matrix of the documents whose rate is not 0: that meets
reachable targets in about ten steps. A step that gains nothing is taken back and damped, towards
the plain metric. A step needs K sums and that matrix over all documents. Only those numbers reach
the driver, and a document's rate is recomputed from the steps, so nothing but the posteriors is stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmarket.functions.columns import free

from .common import read, shared_dir, small_batches, stored

#: Labelled rows that the classifier is fitted on, at most; those of the smallest hashes.
FIT_ROWS = 8_000
#: Steps at most, and the share of all tokens by which a domain's total may miss its target. Targets that can be
#: met take about ten steps; the others stop when a step gains less than a thousandth.
STEPS, CLOSE = 200, 1e-6
#: Production weights over the quality label.
WEIGHTS = {"high": 0.97, "low": 0.03}


def profile(text: str | None) -> np.ndarray:
    """Square roots of the byte shares of a whole text, and 1."""
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if data else np.zeros(256)
    return np.append(np.sqrt(counts / max(1, len(data))), 1.0).astype(np.float32)


def tokens(text: str | None) -> int:
    """Words between white space; the token measure of the targets."""
    return len((text or "").encode("utf-8", "surrogatepass").split())


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_domains(docs: DataFrame, labelled: DataFrame, path: str) -> tuple[list[str], np.ndarray]:
    """Domain names and weights (257, K); labelled: doc_id, domain. No labels: one domain, 'all'."""
    labelled = labelled.select(F.col("doc_id").cast("long").alias("_id"), F.col("domain").cast("string").alias("_domain")).where("_id is not null and _domain is not null")
    few = labelled.groupBy("_id").agg(F.min("_domain").alias("_domain")).orderBy(F.xxhash64("_id"), "_id").limit(FIT_ROWS)
    few = stored(few, f"{path}/few")  # bounded, so it may be broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(few), "_id")
    rows = rows.groupBy("_id", "_domain").agg(F.min("text").alias("text")).select("_domain", "text")  # an id counts once

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([profile(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], ["domain", "x"])

    got = rows.mapInArrow(profiles, "domain string, x binary").collect()  # FIT_ROWS at most
    names = sorted({r["domain"] for r in got})
    if not names:
        return ["all"], np.zeros((257, 1), np.float32)
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in got])
    y = np.eye(len(names), dtype=np.float32)[[names.index(r["domain"]) for r in got]]
    step = 2 / (np.linalg.norm(x.T @ x / len(x), 2) + 2e-4)
    w = v = np.zeros((257, len(names)), np.float32)
    for k in range(400):
        g = x.T @ (_softmax(x @ v) - y) / len(x) + 1e-4 * v
        w, old = v - step * g, w
        v = w + (k / (k + 3)) * (w - old)
    return names, w


def _rates(n: np.ndarray, p: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """Rates after the steps: each subtracts the gradient and keeps what is not negative."""
    rate = np.ones(len(n))
    for y in steps:
        rate = np.maximum(0.0, rate - n * (p @ y))
    return rate


class Mix:
    """Domains, classifier and steps; a few KB that each task gets."""

    def __init__(self, names: list[str], weights: np.ndarray, steps: list[np.ndarray], scale: float):
        self.names, self.weights, self.steps, self.scale = names, weights, steps, scale
        #: The largest share of all tokens by which a domain misses its target.
        self.missing = 0.0

    def posteriors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        n = np.array([tokens(t) for t in texts], np.float64)
        x = np.stack([profile(t) for t in texts]) if texts else np.zeros((0, 257), np.float32)
        return n, _softmax((x @ self.weights).astype(np.float64))

    def rates(self, texts: list[str | None]) -> np.ndarray:
        n, p = self.posteriors(texts)
        return _rates(n / self.scale, p, self.steps)


def copies(rate: str = "rate", key: str = "doc_id", seed: int = 11) -> Column:
    """Whole copies whose mean is the rate: its floor, and one more by a keyed hash of the id."""
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (u < F.col(rate) - F.floor(rate)).cast("long")).cast("long")


def solve(docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> tuple[Mix, DataFrame]:
    """A Mix whose rates bring the expected domain totals to ``targets`` (shares of all tokens, made to add
    up to 1; a domain without one gets 0), and the stored table (doc_id, n, p)."""
    spark = docs.sparkSession
    small_batches(spark)
    path = shared_dir(spark)
    names, weights = fit_domains(docs, labelled, path)
    mix = Mix(names, weights, [], 1.0)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, p = mix.posteriors(batch.column(1).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1]), pa.int32()), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n.astype(np.int64)), lists], ["doc_id", "n", "p"])

    table = stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(predict, "doc_id long, n long, p array<double>"), f"{path}/posteriors")
    k = len(names)
    size = table.agg(F.sum("n").alias("total"), F.count("*").alias("docs"), *[F.sum(F.pow("n", F.lit(2)) * F.col("p")[i] * F.col("p")[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(k)]).first()
    if not size["total"]:
        return mix, table
    mix.scale = size["total"] / size["docs"]  # mean tokens of a document: keeps the sums near the count
    gram = np.array([[size[f"g{i}_{j}"] for j in range(k)] for i in range(k)]) / mix.scale**2
    wish = np.array([targets.get(n, 0.0) for n in names])
    wish = wish / wish.sum() * size["docs"] if wish.sum() > 0 else np.full(k, size["docs"] / k)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, g = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            n, p = batch.column(0).to_numpy() / mix.scale, batch.column(1).values.to_numpy(zero_copy_only=False).reshape(-1, k)
            r = _rates(n, p, mix.steps)
            s += (r * n) @ p
            g += (p * np.where(r > 0, n * n, 0.0)[:, None]).T @ p
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*s, *g.ravel())], sums)

    sums = [*(f"s{i}" for i in range(k)), *(f"g{i}" for i in range(k * k))]
    def measured() -> tuple[np.ndarray, np.ndarray, float]:
        got = np.array(table.select("n", "p").mapInArrow(totals, ", ".join(f"{c} double" for c in sums)).agg(*[F.sum(c) for c in sums]).first(), float)
        return got[:k] - wish, got[k:].reshape(k, k), float(np.linalg.norm(got[:k] - wish))

    left, active, error = measured()
    least, damping, slow = 1e-9 * np.trace(gram), 1e-9 * np.trace(gram), 0
    for _ in range(STEPS):
        mix.missing = float(np.abs(left).max() / size["docs"])
        if mix.missing <= CLOSE or slow >= 5 or damping > 10 * np.trace(gram):
            break
        mix.steps.append(np.linalg.solve(active + damping * np.eye(k), left))
        tried = measured()
        if tried[2] < error:
            slow = slow + 1 if tried[2] > 0.999 * error else 0
            (left, active, error), damping = tried, max(least, damping / 10)
        else:  # a step that loses is taken back; with enough damping it is a plain gradient step, which gains
            mix.steps.pop()
            damping = max(damping * 10, 1e-4 * np.trace(gram))
    return mix, table


def rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> DataFrame:
    """doc_id, n_tokens, rate, copies and p_<domain> for each row of docs.

    Rates are not negative; a document without words keeps rate 1. Targets that no rates can
    reach are approached in the least squares sense (``solve`` tells what is missing). Null ids get
    copies by the hash of null. Other columns, whatever their names, are ignored.
    """
    mix, table = solve(docs, labelled, targets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(mix.names)
        for batch in batches:
            n, p = batch.column(1).to_numpy(), batch.column(2).values.to_numpy(zero_copy_only=False).reshape(-1, k)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(_rates(n / mix.scale, p, mix.steps)), *(pa.array(p[:, i]) for i in range(k))], ["doc_id", "n_tokens", "rate", *(f"p_{x}" for x in mix.names)])

    schema = "doc_id long, n_tokens long, rate double, " + ", ".join(f"`p_{x}` double" for x in mix.names)
    return table.mapInArrow(run, schema).withColumn("copies", copies())


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> DataFrame:
    """The rows of docs, each as often as its copies; columns unchanged, whatever their names, no rows moved."""
    mix, _ = solve(docs, labelled, targets)
    rate, many, copy = free("rate_", docs), free("copies_", docs), free("copy_", docs)
    schema = T.StructType([*docs.schema.fields, T.StructField(rate, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch], text_at=docs.columns.index("text")) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mix.rates(batch.column(text_at).to_pylist()))], [*batch.schema.names, rate])

    with_rate = docs.mapInArrow(run, schema).withColumn(many, copies(rate).cast("int"))
    return with_rate.where(F.col(many) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(many)))).select(*docs.columns)


def quality_domains(labels: DataFrame) -> DataFrame:
    return labels.where("quality in (0, 1)").select("doc_id", F.when(F.col("quality") == 1, "high").otherwise("low").alias("domain"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(read(spark, sf_dir, "documents"), quality_domains(read(spark, sf_dir, "labels")), WEIGHTS)
