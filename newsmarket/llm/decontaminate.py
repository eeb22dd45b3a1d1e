"""Benchmark decontamination by CGK embedding, bit sampling and exact edit verification.

Texts are lower-cased, ASCII signs become blanks, words are compared. An item of L words leaks
into a document if some window of L words (cut at the document's end) is within floor(0.25 * L)
word edits of it.

* Windows are first bounded without loss: an edit destroys at most three word triples, so a
  window within k edits holds L - 2 - 3k of the item's triples. Where that is none (L up to 5, and
  8) pairs are counted, L - 1 - 2k and one at least, as the L - k words that match fall into k + 1
  runs; of an item of one word, the word. The windows of those short items are all confirmed,
  without the walks. The count is a running sum over the document.
* A remaining window, and each item, walks through its words as in the CGK embedding: step j
  writes the word under the pointer, and a random bit of (j, word) says whether the pointer moves
  on. Edit distance becomes Hamming distance between walks. ``REPEATS`` walks are sampled at
  ``BITS`` places each; equal samples make a candidate.
* Candidates are confirmed by their exact edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, small_batches

EDITS = 0.25
REPEATS, BITS, CYCLE = 40, 2, 128
#: Items and their characters in one pass over the documents; a larger benchmark takes several.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 8_000_000

_SIGNS = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_SIGNS).split() if text else []


def edit_distance(a: np.ndarray, b: np.ndarray) -> int:
    """Levenshtein distance of two word sequences, by Myers' bit vectors over the first."""
    if not len(a):
        return len(b)
    at: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        at[w] = at.get(w, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    plus, minus, score = full, 0, len(a)
    for w in b.tolist():
        eq = at.get(w, 0)
        diag = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = (minus | ~(diag | plus)) & full, plus & diag
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1 | 1) & full, (down << 1) & full
        plus, minus = (down | ~(diag | up)) & full, up & diag
    return score


SLOT_BITS = 22


def _gram_words(size: int) -> int:
    """Words in a row of which a window within the edits holds one at least."""
    return 3 if size - 2 - 3 * int(EDITS * size) > 0 else min(size, 2)


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    """A slot for each n words in a row, up to three."""
    x = np.zeros(max(0, len(words) - n + 1), np.int64)
    with np.errstate(over="ignore"):
        for k in range(n):
            x = x * (0x1E3779B97F4A7C15, 0x1E3779B97F4A7C15, 0x2545F4914F6CDD1D)[k] + words[k : k + len(x)]
        x = (x ^ (x >> 31)) * 0x1E3779B97F4A7C15
    return (x >> 20) & ((1 << SLOT_BITS) - 1)


class Grams:
    """The slots of those items that are bounded by runs of n words."""

    def __init__(self, items: list[np.ndarray], n: int):
        own = [i for i, w in enumerate(items) if _gram_words(len(w)) == n]
        slots = [np.unique(_grams(items[i], n)) for i in own]
        self.n, self.items = n, items
        slot = np.concatenate([*slots, np.empty(0, np.int64)])
        item = np.repeat(np.array(own, np.int64), [len(x) for x in slots])
        order = np.argsort(slot, kind="stable")
        self.slot, self.item = slot[order], item[order]
        self.some = np.zeros(1 << SLOT_BITS, bool)
        self.some[self.slot] = True

    def windows(self, text: np.ndarray, unknown: int) -> np.ndarray:
        """(start, words, item) of the windows that hold enough runs of one item."""
        n, out = self.n, [np.empty((0, 3), np.int64)]
        if not len(self.slot):
            return out[0]
        slot = _grams(text, n)
        known = self.some[slot]
        for k in range(n):
            known &= text[k : k + len(slot)] < unknown
        hit = np.flatnonzero(known)
        slot = slot[hit]
        lo, hi = np.searchsorted(self.slot, slot), np.searchsorted(self.slot, slot, "right")
        many = hi - lo
        place = np.repeat(hit, many)
        item = self.item[np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())]
        order = np.lexsort((place, item))
        place, item = place[order], item[order]
        for i, at in zip(*np.unique(item, return_index=True), strict=True):
            size = len(self.items[i])
            own, least = place[at : np.searchsorted(item, i, "right")], max(1, size - (n - 1) - n * int(EDITS * size))
            if len(own) < least:
                continue
            first, last = own[: len(own) - least + 1], own[least - 1 :]
            near = last - first <= size - n
            lowest = np.maximum(last[near] - size + n, 0)
            count = first[near] - lowest + 1
            starts = np.unique(np.repeat(lowest - np.cumsum(count) + count, count) + np.arange(count.sum()))
            out.append(np.stack([starts, np.full(len(starts), size), np.full(len(starts), i)], 1))
        return np.concatenate(out)


class Items:
    """A block of benchmark items with what the search needs; small enough for every task."""

    def __init__(self, rows: list[tuple[int, str]], seed: int = 7):
        rng = np.random.default_rng(seed)
        split = [(i, w) for i, t in rows if (w := words_of(t))]
        self.vocab = {w: k for k, w in enumerate(dict.fromkeys(w for _, words in split for w in words))}
        self.unknown = len(self.vocab)
        self.ids = [i for i, _ in split]
        self.words = [np.array([self.vocab[w] for w in words], np.int64) for _, words in split]
        # The walks' bits are hashes of walk, step and word, so they take the same room for any number of words.
        self.steps = rng.integers(0, 2**63, (2, REPEATS, CYCLE), dtype=np.uint64) | np.uint64(1)
        self.places = rng.random((REPEATS, BITS))
        self.salt = rng.integers(1, 2**62, (REPEATS, BITS + 1), dtype=np.int64) | 1
        self.lengths = sorted({len(w) for w in self.words})
        self.long, self.short = Grams(self.words, 3), [Grams(self.words, n) for n in (1, 2)]
        keys, owners = [], []
        for n in self.lengths:
            own = [i for i, w in enumerate(self.words) if len(w) == n and _gram_words(n) == 3]
            if own:
                text = np.concatenate([np.append(self.words[i], np.full(n, self.unknown + 1)) for i in own])
                k = self.samples(text, np.arange(len(own)) * 2 * n, np.full(len(own), n))
                keys.append(k.ravel())
                owners.append(np.repeat(own, REPEATS))
        self.keys, self.owners = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (keys, owners))
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.owners = self.keys[order], self.owners[order].astype(np.int64)

    def bit(self, walk: np.ndarray, step: int, word: np.ndarray) -> np.ndarray:
        """A random bit, 0 or 1, for each walk, step and word."""
        x = (word.astype(np.uint64) + np.uint64(1)) * self.steps[0, walk, step]
        x = (x ^ (x >> np.uint64(29))) * self.steps[1, walk, step]
        return (x >> np.uint64(63)).astype(np.int64)

    def samples(self, text: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """One key for each window and walk."""
        n, walk = len(start), np.arange(REPEATS)[None, :]
        places = (self.places[None] * 2 * length[:, None, None]).astype(np.int64)  # window, walk, bit
        at = np.zeros((n, REPEATS), np.int64)
        key = np.broadcast_to(length[:, None] * self.salt[None, :, BITS], (n, REPEATS)).copy()
        with np.errstate(over="ignore"):
            for j in range(int(places.max(initial=-1)) + 1):
                word = np.where(at < length[:, None], text[np.minimum(start[:, None] + at, len(text) - 1)], self.unknown + 1)
                for b in range(BITS):
                    key += np.where(places[:, :, b] == j, (word + 1) * self.salt[None, :, b], 0)
                at += self.bit(walk, j % CYCLE, word)
            return key ^ (key >> 29)

    def find(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(text, item id, first word, words, edits): the nearest window for each text and item."""
        if not self.ids:
            return []
        pad = max(self.lengths)
        docs = [words_of(t) for t in texts]
        sizes = np.array([len(d) for d in docs], np.int64)
        begin = np.cumsum(sizes + pad) - sizes - pad
        total = int((sizes + pad).sum())
        text = np.full(total + pad + 2, self.unknown + 1, np.int64)
        get, unknown = self.vocab.get, self.unknown
        for b, d in zip(begin.tolist(), docs, strict=True):
            if d:
                text[b : b + len(d)] = np.fromiter(map(get, d, repeat(unknown)), np.int64, len(d))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}

        def confirm(start: int, item: int) -> None:
            size = len(self.words[item])
            doc = int(np.searchsorted(begin, start, "right")) - 1
            first = int(start - begin[doc])
            window = text[start : start + min(size, int(sizes[doc]) - first)]
            edits = edit_distance(self.words[item], window)
            if edits <= int(EDITS * size):
                best[doc, item] = min(best.get((doc, item), (1 << 30, 0, 0)), (edits, first, len(window)))

        for grams in self.short:
            windows = grams.windows(text, unknown)
            for start, _, item in windows[text[windows[:, 0]] != unknown + 1].tolist():
                confirm(start, item)
        windows = np.unique(self.long.windows(text, unknown)[:, :2], axis=0)
        windows = windows[text[windows[:, 0]] != unknown + 1]
        start, length = windows[:, 0], windows[:, 1]
        for k in range(0, len(start), 1024):
            s, n = start[k : k + 1024], length[k : k + 1024]
            keys = self.samples(text, s, n)
            lo, hi = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, "right")
            found = {(int(w), int(self.owners[x])) for w, r in np.argwhere(hi > lo) for x in range(lo[w, r], hi[w, r])}
            for w, item in found:
                if len(self.words[item]) == int(n[w]):
                    confirm(int(s[w]), item)
        return [(doc, self.ids[item], first, n, edits) for (doc, item), (edits, first, n) in sorted(best.items())]


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Items]:
    """The items in blocks of bounded size, one at a time on the driver."""
    rows: list[tuple[int, str]] = []
    chars = 0
    for row in benchmark.select(id_col, text_col).where(f"{id_col} is not null and {text_col} is not null").orderBy(id_col, text_col).toLocalIterator():
        rows.append((row[0], row[1]))
        chars += len(row[1])
        if len(rows) >= BLOCK_ITEMS or chars >= BLOCK_CHARS:
            yield Items(rows)
            rows, chars = [], 0
    if rows:
        yield Items(rows)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, first_word, window_words, edits: one row for each document row and item that leaks.

    Null or empty texts leak nothing; repeated rows are reported as often as they occur; items
    of under four words are searched as they stand, as they allow no edit; an empty benchmark gives no rows. Of a
    document's windows the nearest counts, then the first.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, first_word int, window_words int, edits int"
    out = spark.createDataFrame([], schema)
    for items in blocks(benchmark):
        held = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = held.value.find(batch.column(1).to_pylist())
                ids = batch.column(0).take(pa.array([x[0] for x in found], pa.int64()))
                rest = [pa.array([x[k] for x in found], kind) for k, kind in ((1, pa.int64()), (2, pa.int32()), (3, pa.int32()), (4, pa.int32()))]
                yield pa.RecordBatch.from_arrays([ids, *rest], ["doc_id", "item_id", "first_word", "window_words", "edits"])

        out = out.unionByName(docs.mapInArrow(run, schema))
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs into which no benchmark item leaks, all columns unchanged; moves no rows."""
    small_batches(docs.sparkSession)
    for items in blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], held=held, text_at=docs.columns.index(text_col)) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[x[0] for x in held.value.find(batch.column(text_at).to_pylist())]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
