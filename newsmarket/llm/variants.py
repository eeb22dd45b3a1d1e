"""Spelling variants: words one edit apart, by an index of grams of variable length.

A gram is a stretch of a word between its edge marks. The dictionary of grams is pruned by
frequency: it holds the ``DICTIONARY`` most frequent of those that occur more than ``FREQUENT``
times among the distinct words, and these are replaced by their extensions, up to ``Q_MAX``
characters, so common beginnings get long grams and rare ones stay short. A word is decomposed into one gram for each position, the shortest that is not extended.
Which gram that is depends on its own characters alone; so an edit touches only the grams that
cover its place, at most ``a`` of a word's grams, wherever it falls. Two words one edit apart share
all others, at equal places before the edit and at places one apart after it, and therefore one at
least of the a + 1 rarest grams of either word. Only those lists are merged, within words of
lengths that fit, and what they bring together is verified.

A list of more than ``LIST`` words is split by a second shared gram, which is one of the a + 2
rarest, then by a third and so on; words that share too few grams for that are compared within
their part, which a few free characters bound. No list is cut.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, shared_dir, small_batches, stored

SHORTEST, LEAST = 5, 3
#: Lengths of grams; a word has at least Q_MAX letters, so no edit touches all its grams.
Q_MIN, Q_MAX = 2, 5
FREQUENT, LIST = 64, 256
#: Grams in the dictionary, which is broadcast: at most so many texts of Q_MAX letters.
DICTIONARY = 1 << 17
SLIP = 97
WORDS_HELD = 300_000

# In Latin-1: A-Z to a-z, other letters of the alphabet as they are, all else to blanks.
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256))


def count_words(text: str, doc_id: int | None, counts: dict[bytes, int]) -> None:
    """Adds a text's words of ``SHORTEST`` letters or more (in Latin-1), after the slips; a null id is written as nothing."""
    start, seen = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), counts.get
    for word, n in Counter(text.encode("latin-1", "replace").translate(_LETTERS).split()).items():
        if len(word) < SHORTEST:
            continue
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % SLIP == 0:
            word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) < SHORTEST:
                continue
        counts[word] = seen(word, 0) + n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, int] = {}

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return batch

    for batch in batches:
        for text, doc_id in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            count_words(text.as_py() or "", doc_id, held)
            if len(held) > WORDS_HELD:
                yield out()
    yield out()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n of all words that occur ``LEAST`` times or more."""
    small_batches(docs.sparkSession)
    counted = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc_id")).mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["gram", "f"])
        held.clear()
        return batch

    for batch in batches:
        for word in batch.column(0).to_pylist():
            padded = f"^{word}$"
            for q in range(Q_MIN, Q_MAX + 1):
                held.update(padded[p : p + q] for p in range(len(padded) - q + 1))
            if len(held) > WORDS_HELD:
                yield out()
    yield out()


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """Of the grams that occur more than FREQUENT times among the words the DICTIONARY most frequent, with their counts."""
    counts = words.select("word").mapInArrow(_count_grams, "gram string, f long").groupBy("gram").agg(F.sum("f").alias("f"))
    top = counts.where(F.col("f") > FREQUENT).orderBy(F.desc("f"), "gram").limit(DICTIONARY).toPandas()
    return dict(zip(top["gram"].tolist(), top["f"].tolist(), strict=True))


def decomposed(word: str, dictionary: dict[str, int]) -> tuple[int, list[tuple[int, str, int]]]:
    """a and the word's grams as (frequency, gram, place), the rarest first.

    The frequency is 0 for a gram that isn't in the dictionary; with the grams' own order it makes
    one order for all words.
    """
    padded, n = f"^{word}$", len(word)
    grams, edges = [], [0] * (n + 4)
    for p in range(n + 1):
        q, most = Q_MIN, min(Q_MAX, n + 2 - p)
        gram = padded[p : p + q]
        while q < most and gram in dictionary:
            q += 1
            gram = padded[p : p + q]
        grams.append((dictionary.get(gram, 0), gram, p))
        edges[p] += 1
        edges[p + q] -= 1
    grams.sort()
    return max(list(accumulate(edges))[1 : n + 1]), grams


def _places(p: int, role: int) -> tuple[int, ...]:
    """Places at which the shorter of two words, or one of equal size, may have a gram that stands at p."""
    return (p, p - 1) if role and p else (p,)


_ENTRIES = "key long, role int, word string, at int, sure int"


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    types = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [x.split()[0] for x in _ENTRIES.split(", ")])


def _key(gram: str, place: int, within: int) -> int:
    """Of a gram at a place in words of a size, or in a list that is split."""
    return xxhash.xxh3_64_intdigest(f"{gram}{place},{within}") - 2**63


def _lists(words: DataFrame, dictionary: Broadcast) -> DataFrame:
    """key, role, word, at, sure: entries of each word in the lists of its a + 1 rarest grams.

    A list holds a gram at a place in words of a size (role 0) and in words one longer (role 1). at is
    the gram's rank among the word's, sure the number of grams that it shares with any near word.
    """

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word in batch.column(0).to_pylist():
                a, grams = decomposed(word, dictionary.value)
                for at, (_, gram, p) in enumerate(grams[: a + 1]):
                    rows += [(_key(gram, place, len(word) - role), role, word, at, len(grams) - a) for role in (0, 1) for place in _places(p, role)]
            yield _entries(rows)

    return words.select("word").mapInArrow(lists, _ENTRIES)


def _split(hot: DataFrame, dictionary: Broadcast, shared: int) -> DataFrame:
    """Entries of long lists by one more shared gram, of which each word has ``shared`` by then."""

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, role, word, at, sure in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, grams = decomposed(word, dictionary.value)
                for more in range(at + 1, min(a + shared, len(grams))):
                    _, gram, p = grams[more]
                    rows += [(_key(gram, place, key), role, word, more, sure) for place in _places(p, role)]
            yield _entries(rows)

    return hot.select(*[x.split()[0] for x in _ENTRIES.split(", ")]).mapInArrow(lists, _ENTRIES)


def _pairs(entries: DataFrame) -> DataFrame:
    """Verified pairs of words in the same list: word, near with word < near."""
    x = entries.where("role = 0").select("key", F.col("word").alias("x"))
    y = entries.select("key", "role", F.col("word").alias("y"))
    fits = (F.col("role") == 1) | (F.col("x") < F.col("y"))
    found = x.join(y, (x["key"] == y["key"]) & fits & (F.levenshtein("x", "y", 1) == 1))
    return found.select(F.least("x", "y").alias("word"), F.greatest("x", "y").alias("near"))


def near_pairs(words: DataFrame, path: str) -> DataFrame:
    """word, near for each pair of words that differ by one code point, once (word < near)."""
    spark = words.sparkSession
    dictionary = spark.sparkContext.broadcast(gram_dictionary(words))
    entries, found, shared = stored(_lists(words, dictionary), f"{path}/lists1"), None, 1
    while True:
        sizes = entries.groupBy("key").agg(F.count_if(F.col("role") == 0).alias("n0"), F.count("*").alias("all_n")).where("n0 > 0 and all_n > 1").drop("n0")
        live = stored(entries.join(sizes, "key"), f"{path}/live{shared}")
        few = stored(_pairs(live.where(F.col("all_n") <= LIST)), f"{path}/pairs{shared}")
        found = few if found is None else found.unionByName(few)
        hot = live.where(F.col("all_n") > LIST)
        if hot.isEmpty():
            return found.distinct()
        shared += 1
        # Two words that share fewer grams than that for sure have nothing left to be split by.
        few = stored(_pairs(hot.where(F.col("sure") < shared)), f"{path}/short{shared}")
        found = found.unionByName(few)
        entries = stored(_split(hot, dictionary, shared), f"{path}/lists{shared}")


def _roots(forms: DataFrame, path: str) -> DataFrame:
    """word, root from word, form; n doubles from word to form at least, so chains have no cycle and few links."""
    at = stored(forms.select("word", F.col("form").alias("root")), f"{path}/roots0")
    for k in range(1, 64):
        up = at.select(F.col("word").alias("root"), F.col("root").alias("above"))
        at = stored(at.join(up, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), f"{path}/roots{k}")
        if at.where("moved").isEmpty():
            break
        at = at.drop("moved")
    return at.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of each word with ``SHORTEST`` letters and ``LEAST`` occurrences or more.

    Words are runs of Latin letters, A-Z lower-cased, in some of which a letter slips away by rule.
    form is the near word (one edit apart) of largest n, the smallest of equals, if it occurs twice
    as often or more, else null; root is where forms lead to, the word itself without one. Null
    texts hold no words; repeated rows count as often as they occur; a null id is written as
    nothing in the rule; other columns, whatever their names, are ignored; an empty table gives no rows.
    """
    path = shared_dir(docs.sparkSession)
    words = stored(word_counts(docs, id_col, text_col), f"{path}/words")
    pairs = near_pairs(words, path)
    both = stored(pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near"))), f"{path}/near")
    of_near = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = both.join(of_near, "near").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    high = -F.col("best.less") >= 2 * F.col("n")
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(high, F.col("best.near")).alias("form"), F.when(high, -F.col("best.less")).alias("form_n"))
    known = stored(known, f"{path}/known")
    roots = _roots(known.where("form is not null"), path)
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read(spark, sf_dir, "documents"))
