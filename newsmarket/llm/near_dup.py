"""Near duplicates by SetSketch registers.

A document's set holds its distinct five-word shingles. A sketch has ``M`` registers; each is the
minimum over the set of an exponential hash value, kept at exponentially spaced levels of base
``B`` (so sketches of a union are the element-wise maximum). Runs of ``ROWS`` registers are band
keys. Texts that share a band key are candidates; the joint likelihood of two sketches given the
set sizes estimates their similarity, pairs far below the threshold go, and the rest are
confirmed on the full sets.

Texts with equal sets are one node from the start. In a band each node is compared with the
band's smallest node, then components are formed, and only bands that still hold two or more
components are looked at again, block by block, for links across components. So copies are never
expanded into pairs, and no candidate is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmarket.functions.columns import free

from .common import read, shared_dir, small_batches, stored
from .graph import components

WORDS = 5
THRESHOLD = 75  # per cent
M, ROWS = 160, 4
B, RATE, TOP = 1.001, 20.0, 65534
#: An estimate has a standard error of sqrt(J(1-J)/M) = 0.034 at J = 0.75; pairs 4.4 errors below go.
LEAST_ESTIMATE = 0.60
BLOCK = 512
#: Bands of up to so many nodes give their pairs by a join on the band key, larger ones by blocks.
SMALL = 16

_rng = np.random.default_rng(20240229)
_MULT = (_rng.integers(0, 2**32, M, dtype=np.uint64) | 1).astype(np.uint32)
_PLUS = _rng.integers(0, 2**32, M, dtype=np.uint64).astype(np.uint32)
_BAND_SALT = _rng.integers(0, 2**63, M // ROWS, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _WordHash(dict):
    """Hash of a word, remembered for up to ``most`` words at a time."""

    most = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


#: Of this Python worker, from task to task.
_hashes = _WordHash()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, hashes: _WordHash) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; empty for no words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(WORDS, len(words))
    acc = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        acc = acc * _STEP + h[k : len(h) - n + 1 + k]
    return np.unique(_mixed(acc))


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers (uint16) of a non-empty set of hashes."""
    x, low = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32), np.full(M, 2**32 - 1, np.uint32)
    for k in range(0, len(x), 256):
        np.minimum(low, (x[k : k + 256, None] * _MULT + _PLUS).min(axis=0), out=low)
    least = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1.0 - np.log(least) / np.log(B)) + TOP / 4, 0, TOP + 1).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One int64 for each band; regs: (n, M)."""
    runs = np.ascontiguousarray(regs).view(np.uint64)
    return _mixed(runs * _STEP + _BAND_SALT).view(np.int64)


def joint_estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard similarity that makes the register comparison most likely, given the set sizes.

    With relative sizes u and v, a register is larger in the first sketch with probability
    p(u - vJ), larger in the second with p(v - uJ), and equal otherwise.
    """
    more, less = (a > b).sum(-1), (a < b).sum(-1)
    same = M - more - less
    u = na / np.maximum(na + nb, 1)
    v = 1 - u
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / np.log(B)
    grid = np.linspace(0, 1, 201)
    j = np.minimum(grid[None, :], np.minimum(u / v, v / u)[:, None])
    up, down = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
    tiny = 1e-12
    fit = more[:, None] * np.log(up + tiny) + less[:, None] * np.log(down + tiny) + same[:, None] * np.log(np.maximum(1 - up - down, tiny))
    return j[np.arange(len(j)), fit.argmax(1)]


def _set_key(shingles: bytes) -> tuple[int, int]:
    """A 128-bit key of a set, as two longs."""
    key = xxhash.xxh3_128_intdigest(shingles)
    return (key >> 64) - 2**63, (key & (2**64 - 1)) - 2**63


_SKETCH = "doc_id long, n_shingles long, k1 long, k2 long, regs binary"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _hashes
    for batch in batches:
        n, k1, k2, regs = [], [], [], []
        for text in batch.column(1).to_pylist():
            s = shingle_set(text, hashes)
            key = _set_key(s.tobytes())
            n.append(len(s))
            k1.append(key[0])
            k2.append(key[1])
            regs.append(registers(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(regs, pa.binary())], ["doc_id", "n_shingles", "k1", "k2", "regs"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, M))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.tile(np.arange(keys.shape[1], dtype=np.int8), len(keys))), pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), keys.shape[1]))], ["key", "band", "rep"])


def _regs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, M)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            at = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            na, nb = (at[c].to_numpy().astype(np.float64) for c in ("n_a", "n_b"))
            ok = 100 * np.minimum(na, nb) >= THRESHOLD * np.maximum(na, nb)
            ok &= joint_estimate(_regs(at["regs_a"]), _regs(at["regs_b"]), na, nb) >= LEAST_ESTIMATE
            yield pa.RecordBatch.from_arrays([at["a"].filter(pa.array(ok)), at["b"].filter(pa.array(ok))], ["a", "b"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _hashes
    for batch in batches:
        sets = [shingle_set(t, hashes).tobytes() for t in batch.column(1).to_pylist()]
        k1, k2 = zip(*map(_set_key, sets), strict=True) if sets else ((), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64())], ["id", "shingles", "k1", "k2"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
        keep = []
        for x, y in zip(at["s_a"].to_pylist(), at["s_b"].to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            inter = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * inter >= THRESHOLD * (len(x) + len(y) - inter))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([at["a"].filter(keep), at["b"].filter(keep)], ["a", "b"])


_LINK = "a long, b long"


def _across(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Confirmed links across components in one block of a band: one at least for each minority
    member and other component, if there is any. A pair counts in the first band that it shares.
    """
    band, q, m, out = key[1], pdf[pdf["minor"]], pdf[~pdf["minor"]], []
    if len(q) and len(m):
        regs = np.frombuffer(b"".join(m["regs"]), np.uint16).reshape(-1, M)
        runs = regs.view(np.uint64)
        comp, ids = m["component"].to_numpy(), m["rep"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in m["shingles"]]
        n = np.array([len(x) for x in sets])
        for row in q.itertuples():
            own, full = np.frombuffer(row.regs, np.uint16), np.frombuffer(row.shingles, np.uint64)
            at = np.flatnonzero((comp != row.component) & (100 * np.minimum(n, len(full)) >= THRESHOLD * np.maximum(n, len(full))))
            at = at[(runs[at] == own.view(np.uint64)).argmax(1) == band]
            if not len(at):
                continue
            est = joint_estimate(np.broadcast_to(own, (len(at), M)), regs[at], np.full(len(at), float(len(full))), n[at].astype(float))
            at = at[est >= LEAST_ESTIMATE]
            if not len(at):
                continue
            flat = np.concatenate([sets[k] for k in at])
            inside = full[np.minimum(np.searchsorted(full, flat), len(full) - 1)] == flat
            inter = np.add.reduceat(inside, np.concatenate([[0], np.cumsum(n[at])[:-1]]).astype(np.int64), dtype=np.int64)
            linked = at[100 * inter >= THRESHOLD * (n[at] + len(full) - inter)]
            linked = linked[np.unique(comp[linked], return_index=True)[1]]
            out += [(min(row.rep, ids[k]), max(row.rep, ids[k])) for k in linked]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs.

    Two documents are linked if 100 * |A and B| >= 75 * |A or B| on their shingle sets (fewer than
    five words: the whole sequence is the one shingle; no words or null text: empty set, linked
    with nothing). component_id is the smallest id reachable over links, kept is doc_id =
    component_id. Repeated rows come back as often as they went in; rows with a null id keep a
    null component and are kept; an id with several texts is linked by each of them; other columns,
    whatever their names, are ignored. Similarity is taken on 64-bit shingle hashes. At the threshold a pair shares a band key with probability
    1 - 3e-7.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = shared_dir(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = stored(docs.mapInArrow(_sketch, _SKETCH), f"{path}/sketches")
    sets = (
        sketches.where("regs is not null and doc_id is not null")
        .groupBy("k1", "k2")
        .agg(F.min("doc_id").alias("rep"), F.first("regs").alias("regs"), F.first("n_shingles").alias("n"))
    )
    sets = stored(sets, f"{path}/sets")
    bands = stored(sets.select("rep", "regs").mapInArrow(_bands, "key long, band byte, rep long"), f"{path}/bands")
    shared = bands.groupBy("key").agg(F.min("rep").alias("star"), F.max("rep").alias("other")).where("star <> other").select("key", "star")
    members = stored(bands.join(shared, "key"), f"{path}/members")

    full = stored(_sets_of(members.select(F.col("rep").alias("doc_id")), docs), f"{path}/full")
    stars = members.where("rep <> star").select(F.col("star").alias("a"), F.col("rep").alias("b")).distinct()
    likely = stored(_pairs(stars, sets), f"{path}/likely")
    links = stored(_confirmed(likely, full), f"{path}/star_links")
    comp = components(links, f"{path}/stars")
    more = _across_components(members, comp, sets, full, path)
    comp = components(links.unionByName(more), f"{path}/all")
    of_set = sets.select("k1", "k2", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    of_set = of_set.select("k1", "k2", F.coalesce("component", "rep").alias("component"))
    found = sketches.drop("regs").join(of_set, ["k1", "k2"], "left")
    linked = F.col("n_shingles") > 0
    component = F.when(linked & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of candidate pairs (a, b) those whose joint likelihood estimate is high enough.

    The star ``a`` of many pairs is joined last: its row then meets theirs without being sent once for each, and
    a skewed star is split by the planner.
    """
    for side in ("b", "a"):
        pairs = pairs.join(sets.select(F.col("rep").alias(side), F.col("regs").alias(f"regs_{side}"), F.col("n").alias(f"n_{side}")), side)
    return pairs.mapInArrow(_likely, "a long, b long").distinct()


def _sets_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """Full sets of the documents named, which share a band with another; texts are moved this once."""
    return docs.join(ids.distinct().hint("merge"), "doc_id", "left_semi").mapInArrow(_full_sets, "id long, shingles binary, k1 long, k2 long")


def _confirmed(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """Of candidate pairs those linked on their full sets; the stars are joined last, as in ``_pairs``."""
    for side in ("b", "a"):
        pairs = pairs.join(full.select(F.col("id").alias(side), F.col("shingles").alias(f"s_{side}")), side)
    return pairs.mapInArrow(_confirm, _LINK).distinct()


def _across_components(members: DataFrame, comp: DataFrame, sets: DataFrame, full: DataFrame, path: str) -> DataFrame:
    """Links in bands that hold two or more components: by a join in bands of up to SMALL nodes, else by blocks."""
    known = members.select("key", "band", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    sizes = known.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = (
        sizes.groupBy("key")
        .agg(F.sum("n").alias("all_n"), F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("kinds"))
        .where("kinds > 1")
        .select("key", "all_n", F.col("top.component").alias("major"), F.ceil(F.col("all_n") / BLOCK).cast("int").alias("across"), F.ceil((F.col("all_n") - F.col("top.n")) / BLOCK).cast("int").alias("down"))
    )
    rows = stored(known.join(mixed, "key"), f"{path}/mixed")
    small, large = rows.where(F.col("all_n") <= SMALL), rows.where(F.col("all_n") > SMALL)
    other = small.select("key", F.col("rep").alias("rep_2"), F.col("component").alias("component_2"))
    few = small.where("component <> major").join(other, "key").where("component <> component_2")
    few = few.select(F.least("rep", "rep_2").alias("a"), F.greatest("rep", "rep_2").alias("b")).distinct()
    few = stored(_confirmed(_pairs(few, sets), full), f"{path}/few_links")
    # An id with several texts has a row for each, with the registers of that text.
    texts = full.groupBy(F.col("id").alias("rep"), "k1", "k2").agg(F.first("shingles").alias("shingles"))
    large = large.join(texts.join(sets.select("k1", "k2", "regs"), ["k1", "k2"]), "rep")
    spot = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["key", "band", "rep", "component", "regs", "shingles"]
    as_member = large.select(*cols, F.lit(False).alias("minor"), spot("across").alias("j"), every("down").alias("i"))
    as_minor = large.where("component <> major").select(*cols, F.lit(True).alias("minor"), spot("down").alias("i"), every("across").alias("j"))
    found = as_member.unionByName(as_minor).groupBy("key", "band", "i", "j").applyInPandas(_across, _LINK)
    return few.unionByName(stored(found.distinct(), f"{path}/block_links"))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Documents without those that are near copies of one with a smaller id; columns unchanged, whatever
    their names. Rows with a null id stay; of rows that repeat a kept id all stay.
    """
    name = free("kept_", docs)
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(kept, F.col("doc_id") == F.col(name), "left_semi").unionByName(docs.where("doc_id is null"))


SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s
  FROM words),
sized AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
flat AS (SELECT doc_id, unnest(s) AS g FROM sets),
inter AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM inter JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  WITH RECURSIVE r(root, node) AS (
    SELECT a, a FROM both_ways UNION SELECT r.root, e.b FROM r JOIN both_ways e ON e.a = r.node)
  SELECT root, min(node) AS component FROM r GROUP BY 1)
SELECT s.doc_id, s.n AS n_shingles, coalesce(component, s.doc_id) AS component_id, s.doc_id = coalesce(component, s.doc_id) AS kept
FROM sized s LEFT JOIN reach ON root = s.doc_id
"""
