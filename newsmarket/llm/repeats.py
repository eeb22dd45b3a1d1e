"""Long passages that repeat, byte for byte, by a run-length index.

Every string of ``LENGTH`` bytes has an anchor, the first of its stretches of ``GRAM`` bytes with
the smallest hash, so equal strings have equal anchors at equal places. Neighbouring strings with
the same anchor make a segment. Anchors are counted, and a Bloom filter of a fixed size spares what
has none that repeats. Segments are counted by anchor and content: one that occurs twice is repeated as a whole, and only anchors with several contents need a closer look. Of those, each
content is fetched once, and a bucket of anchors is indexed at a time: the Burrows-Wheeler
transform of the contents is compressed to runs, the suffix array is sampled at the ends of runs,
and the longest match of every position with any other follows from those of the samples, one byte
less for each step away from the sample before it. Matches of ``LENGTH`` bytes or more are marked.

An anchor with more than ``LIST`` contents is split: by halves of the places that the anchor can
have in a string, and by the bytes that all strings of a half hold. In the end such a part is one
string, so every group comes down to few contents, however many texts share a passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bloom_bits, maybe_in, read, shared_dir, small_batches, stored

LENGTH, GRAM = 200, 32
PLACES = LENGTH - GRAM + 1
LIST, BUCKET_BYTES, PIECE = 512, 1_000_000, 1 << 20
#: Bits of the Bloom filters of repeated anchors and of texts, which only spare moving what has no match.
BITS = 1 << 26
_LOW = np.uint64((1 << 24) - 1)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches of GRAM bytes that start at each byte."""
    h, factor, width = text.astype(np.uint64) + np.uint64(1), _MULT, 1
    with np.errstate(over="ignore"):
        while width < GRAM:
            h = h[:-width] * factor + h[width:]
            factor, width = factor * factor, 2 * width
        return _mixed(h)


def segments(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """start, end, place of the anchor (all in the text) and its hash, for each segment of a text."""
    for at in range(0, len(text) - LENGTH + 1, PIECE):
        part = np.frombuffer(text, np.uint8, min(PIECE + LENGTH - 1, len(text) - at), at)
        h = gram_hashes(part)
        n = len(part) - LENGTH + 1
        # The smallest hash in each stretch of PLACES, the first of equals: minima from both ends of blocks of that size.
        value = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        blocks = np.full(-(-len(value) // PLACES) * PLACES, np.iinfo(np.uint64).max, np.uint64)
        blocks[: len(value)] = value
        blocks = blocks.reshape(-1, PLACES)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        anchor = (np.minimum(back[:n], ahead[PLACES - 1 : PLACES - 1 + n]) & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.concatenate([first[1:], [n]]) - 1
        yield at + first, at + last + LENGTH, at + anchor[first], h[anchor[first]].view(np.int64)


_SEGMENTS = "k1 long, k2 long, s int, e int, p int, a long, h long"


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of the segments with their counts in a batch."""
    for batch in batches:
        found = [a for text in batch.column(0) for _, _, _, a in segments(text.as_py())]
        if found:
            a, c = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c.astype(np.int64))], ["a", "c"])


def _segment(batches: Iterator[pa.RecordBatch], repeated: Broadcast) -> Iterator[pa.RecordBatch]:
    """Segments whose anchors may occur twice."""
    for batch in batches:
        for k1, k2, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            text = text.as_py()
            view = memoryview(text)
            for found in segments(text):
                s, e, p, a = (x[maybe_in(repeated.value, found[3])] for x in found)
                h = np.fromiter((xxhash.xxh3_64_intdigest(view[i:j]) for i, j in zip(s.tolist(), e.tolist(), strict=True)), np.uint64, len(s)).view(np.int64)
                keys = [pa.array(np.full(len(s), k, np.int64)) for k in (k1, k2)]
                yield pa.RecordBatch.from_arrays([*keys, *(pa.array(x.astype(np.int32)) for x in (s, e, p)), pa.array(a), pa.array(h)], ["k1", "k2", "s", "e", "p", "a", "h"])


def _of_texts(texts: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts whose key k1 may be among the keys, which are all that a join with them has to move, and the others."""
    held = texts.sparkSession.sparkContext.broadcast(bloom_bits(keys.select("k1").distinct(), BITS))

    def part(inside: bool) -> DataFrame:
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                k1 = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                yield batch.filter(pa.array(maybe_in(held.value, k1) == inside))

        return texts.mapInArrow(keep, texts.schema)

    return part(True), part(False)


_PIECES = "a long, h long, at int, key long, ch long, lo int, hi int, anchor int, content binary"


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contents of the segments wanted of each text."""
    for batch in batches:
        out = []
        for text, wanted in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            text = text.as_py()
            out += [(w["a"], w["h"], 0, w["a"], w["h"], 0, PLACES, w["p"] - w["s"], text[w["s"] : w["e"]]) for w in wanted]
        yield _pieces(out)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [x.split()[0] for x in _PIECES.split(", ")])


def _signed(h: int) -> int:
    return h - 2**64 if h >= 2**63 else h


def halves(at: int, key: int, lo: int, hi: int, anchor: int, content: bytes) -> Iterator[tuple[int, int, int, int, int, bytes]]:
    """at, key, lo, hi, anchor, content of the two parts of a piece: strings whose anchor stands lo to hi - 1 bytes after
    their start. The key is of the bytes that all strings of a part hold.
    """
    middle = (lo + hi + 1) // 2
    for low, high in ((lo, middle), (middle, hi)):
        first, last = max(anchor - high + 1, 0), min(anchor - low, len(content) - LENGTH)
        if low < high and first <= last:
            common = content[anchor - low : anchor - high + 1 + LENGTH]
            new = xxhash.xxh3_64_intdigest(common, seed=(key ^ low << 8 ^ high) & (2**64 - 1))
            yield at + first, _signed(new), low, high, anchor - first, content[first : last + LENGTH]


def _halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            for at, key, lo, hi, anchor, content in halves(r["at"], r["key"], r["lo"], r["hi"], r["anchor"], r["content"]):
                out.append((r["a"], r["h"], at, key, _signed(xxhash.xxh3_64_intdigest(content)), lo, hi, anchor, content))
        yield _pieces(out)


class RunIndex:
    """Run-length Burrows-Wheeler transform of texts with the suffix array sampled at the heads of runs.

    Texts are joined with a mark between them. ``heads`` are the samples, ``above`` the suffixes just
    before them in order.
    """

    def __init__(self, texts: list[bytes]) -> None:
        self.starts = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        joined = b"\x00".join(texts) + b"\x00"
        self.text = np.frombuffer(joined, np.uint8).astype(np.uint64) + np.uint64(1)
        ends = self.starts + np.array([len(t) for t in texts])
        self.text[ends] = 0
        n = len(self.text)
        self.end_of = np.repeat(ends, np.diff(np.concatenate([self.starts, [n]])))
        order = self._sorted(n)
        before = self.text[order - 1]
        # No two marks are alike, so each text's start is the head of a run and matches end with texts.
        head = np.concatenate([[False], (before[1:] != before[:-1]) | (before[1:] == 0)])
        self.runs = int(head.sum()) + 1
        at = np.flatnonzero(head)
        self.heads, self.above = order[at], order[at - 1]

    def _sorted(self, n: int) -> np.ndarray:
        """The suffix array, by ranks of two or three times the length each, from seven characters of nine bits."""
        padded = np.concatenate([self.text, np.zeros(7, np.uint64)])
        key = np.zeros(n, np.uint64)
        for k in range(7):
            key = (key << np.uint64(9)) | padded[k : k + n]
        width, rank = 7, key.view(np.int64)
        while True:
            order = np.argsort(rank)
            ordered = rank[order]
            new = np.empty(n, np.int64)
            new[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            if new[order[-1]] == n - 1:
                return order
            # As many following ranks as fit into 63 bits come after the own one.
            steps = 2 if (n + 1) ** 3 < 2**63 else 1
            rank = new
            for k in range(1, steps + 1):
                following = np.zeros(n, np.int64)
                following[: max(n - k * width, 0)] = new[k * width :] + 1
                rank = rank * (n + 1) + following
            width *= steps + 1

    def long_matches(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """x, y, size of the matches of ``least`` bytes or more at the samples, within texts.

        Every other position's longest match with the suffix before it is that of the last sample
        before the position, less the bytes between, so these cover all long matches.
        """
        x, y = self.heads, self.above
        room = np.minimum(self.end_of[x] - x, self.end_of[y] - y)
        x, y, room = x[room >= least], y[room >= least], room[room >= least]
        size, open_ = np.zeros(len(x), np.int64), np.arange(len(x))
        step = np.arange(64)
        while len(open_):
            i, j = x[open_, None] + size[open_, None] + step, y[open_, None] + size[open_, None] + step
            same = self.text[np.minimum(i, len(self.text) - 1)] == self.text[np.minimum(j, len(self.text) - 1)]
            run = np.where(same.all(1), 64, same.argmin(1))
            size[open_] = np.minimum(size[open_] + run, room[open_])
            open_ = open_[(run == 64) & (size[open_] < room[open_])]
        long_ = size >= least
        return x[long_], y[long_], size[long_]


def repeated_parts(texts: list[bytes], least: int = LENGTH) -> list[tuple[int, int, int]]:
    """number of the text, start, end: what strings of ``least`` bytes cover that also start elsewhere in distinct texts."""
    if len(texts) < 2:
        return []
    index = RunIndex(texts)
    x, y, size = index.long_matches(least)
    at, size = np.concatenate([x, y]), np.concatenate([size, size])
    edge = np.zeros(len(index.text) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    covered = np.concatenate([[False], np.cumsum(edge)[:-1] > 0, [False]])
    first, last = np.flatnonzero(covered[1:] & ~covered[:-1]), np.flatnonzero(covered[:-1] & ~covered[1:])
    of = np.searchsorted(index.starts, first, side="right") - 1
    return [(int(k), int(s - index.starts[k]), int(e - index.starts[k])) for k, s, e in zip(of, first, last, strict=True)]


_MARKS = "a long, h long, x int, y int"


def _match(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = pdf[["a", "h", "at"]].to_numpy(np.int64)
    found = [(*rows[k][:2], rows[k][2] + s, rows[k][2] + e) for k, s, e in repeated_parts(pdf["content"].tolist())]
    return pd.DataFrame(found, columns=["a", "h", "x", "y"])


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<s:int,e:int>>"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans_type = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
    for batch in batches:
        n, removed, sums, spans = [], [], [], []
        for text, found in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
            text = text.as_py()
            merged = _merged([(x["s"], x["e"]) for x in found or []])
            view, kept, at = memoryview(text), hashlib.sha256(), 0
            for s, e in merged:
                kept.update(view[at:s])
                at = e
            kept.update(view[at:])
            n.append(len(text))
            removed.append(sum(e - s for s, e in merged))
            sums.append(kept.hexdigest())
            spans.append([{"s": s, "e": e} for s, e in merged])
        ints = [pa.array(x, pa.int64()) for x in (n, removed, [len(s) for s in spans])]
        yield pa.RecordBatch.from_arrays([batch.column(0), *ints, pa.array(sums, pa.string()), pa.array(spans, spans_type)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def _marks(texts: DataFrame, kinds: DataFrame, path: str) -> DataFrame:
    """a, h, x, y: bytes x to y of such segments are repeated, of anchors with several contents."""
    several = kinds.groupBy("a").agg(F.count("*").alias("kinds")).where("kinds > 1").select("a")
    wanted = kinds.join(several, "a").groupBy("rep.k1", "rep.k2").agg(F.collect_list(F.struct("a", "h", "rep.s", "rep.e", "rep.p")).alias("wanted"))
    wanted = stored(wanted, f"{path}/wanted", "zstd")
    pieces = _of_texts(texts, wanted)[0].join(wanted, ["k1", "k2"]).select("text", "wanted").mapInArrow(_fetch, _PIECES)
    found, level = None, 0
    while True:
        whole = F.struct("a", "h", "at", "lo", "hi", "anchor", "content")
        reps = pieces.groupBy("key", "ch").agg(F.count("*").alias("c"), F.min_by(whole, F.struct("a", "h", "at")).alias("r")).select("key", "ch", "c", "r.*")
        reps = stored(reps, f"{path}/reps{level}", "zstd")
        sizes = reps.groupBy("key").agg(F.count("*").alias("kinds"), F.sum(F.octet_length("content")).alias("bytes"))
        sizes = stored(sizes.where("kinds > 1"), f"{path}/sizes{level}")
        few, many = sizes.where(F.col("kinds") <= LIST), sizes.where(F.col("kinds") > LIST).select("key")
        total = few.agg(F.sum("bytes")).first()[0] or 0
        bucket = F.pmod(F.xxhash64("key"), F.lit(-(-total // BUCKET_BYTES) or 1))
        now = reps.join(few.select("key"), "key").select("a", "h", "at", "content", bucket.alias("bucket"))
        now = stored(now.groupBy("bucket").applyInPandas(_match, _MARKS), f"{path}/marks{level}")
        found = now if found is None else found.unionByName(now)
        if level:  # at first these are texts that occur more than once, which are marked as a whole already
            twice = reps.where("c > 1").select("key", "ch")
            found = found.unionByName(stored(pieces.join(twice, ["key", "ch"]).select("a", "h", F.col("at").alias("x"), (F.col("at") + F.octet_length("content")).alias("y")), f"{path}/twice{level}"))
        if many.isEmpty():
            return found
        level += 1
        pieces = stored(reps.join(many, "key").select(*[x.split()[0] for x in _PIECES.split(", ")]).mapInArrow(_halve, _PIECES), f"{path}/pieces{level}")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans for each row of docs.

    Removed is each byte (of a text in UTF-8) covered by a string of ``LENGTH`` bytes that also
    starts anywhere else, in the same text or another; spans are the maximal removed runs, from s to
    before e. A null text is empty; empty and shorter texts lose nothing; repeated rows are texts of
    their own, so each loses all that they share; a null id stays null; other columns, whatever
    their names, are ignored; an empty table gives no rows. Strings are compared through 64-bit
    hashes of anchors and contents together, and texts through 128 bits.
    """
    path = shared_dir(docs.sparkSession)
    small_batches(docs.sparkSession, 200)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    texts = texts.select(F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), "text", "doc_id")
    spark = docs.sparkSession
    counts = texts.select("text").mapInArrow(_anchors, "a long, c long").groupBy("a").agg(F.sum("c").alias("c"))
    repeated = spark.sparkContext.broadcast(bloom_bits(counts.where("c > 1").select("a"), BITS))
    found = stored(texts.select("k1", "k2", "text").mapInArrow(lambda batches: _segment(batches, repeated), _SEGMENTS), f"{path}/segments", "zstd")
    kinds = found.groupBy("a", "h").agg(F.count("*").alias("c"), F.min(F.struct("k1", "k2", "s", "e", "p")).alias("rep"))
    kinds = stored(kinds, f"{path}/kinds", "zstd")
    whole = kinds.where("c > 1").select("a", "h", F.lit(0).alias("x"), F.expr("rep.e - rep.s").alias("y"))
    marks = _marks(texts, kinds, path).unionByName(whole)
    spans = found.select("k1", "k2", "s", "a", "h").join(marks, ["a", "h"]).select("k1", "k2", F.expr("s + x").alias("s"), F.expr("s + y").alias("e")).distinct()
    spans = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    spans = stored(spans, f"{path}/spans", "zstd")
    some, none = _of_texts(texts, spans)
    whole = some.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    return whole.unionByName(none.select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))).mapInArrow(_cut, _RESULT)


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read(spark, sf_dir, "documents"))
