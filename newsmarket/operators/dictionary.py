"""Lexicons that are tables: names are looked up by joins, so neither plan nor memory grows with them.

A folded text is cut into words and what stands between them. A name of k words is a run of k words
of the text with the same characters between; so the runs of each length that the lexicon has are
join keys, and equal keys are whole-word occurrences. Signs at a name's edges are compared with
what stands around the run. Texts are not moved, only the ids and keys of those of their runs that a Bloom
filter of the lexicon's keys may hold; the side of the lexicon is broadcast if the planner finds it small,
else both are shuffled by key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmarket.functions.bloom import bloom_bits, maybe_in
from newsmarket.functions.columns import free
from newsmarket.functions.text import fold, strip

#: Bits of the Bloom filter; with more names than it can tell apart more is moved, and nothing else changes.
BITS = 1 << 26
_WORD, _EDGE = r"(?U)\w+", r"(?U)^\W*|\W*$"


def _words(low: Column) -> Column:
    return F.regexp_extract_all(low, F.lit(_WORD), F.lit(0))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _of_runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k words from those of the words; what stands between the words takes no part."""
    run = hashes.view(np.uint64)[: len(hashes) - k + 1] + np.uint64(k)
    with np.errstate(over="ignore"):
        for j in range(1, k):
            run = (run ^ (run >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashes.view(np.uint64)[j : len(hashes) - k + 1 + j]
    return run.view(np.int64)


def _of_whole(hashes: pa.Array) -> pa.Array:
    return pa.array([int(_of_runs(np.array(h, np.int64), len(h))[0]) for h in hashes.to_pylist()], pa.int64())


def lexicon_keys(lexicon: DataFrame, label: str, term: str) -> DataFrame:
    """label, key, before, after of the distinct terms: words and what is between them, and the signs at the edges.

    Null and blank terms and those without any letter or digit name nothing.
    """
    low = fold(strip(F.col(term)))
    out = lexicon.select(F.col(label).alias("label"), low.alias("low")).where("low <> ''")
    out = out.select("label", F.regexp_replace("low", _EDGE, "").alias("key"), F.regexp_extract("low", r"(?U)^\W*", 0).alias("before"), F.regexp_extract("low", r"(?U)\W*$", 0).alias("after"))
    return out.where("key <> '' and label is not null").distinct()


def _around(words: Column, gaps: Column, r: Column) -> Column:
    """struct<key, before, after, starts, ends> of the run of k words from the one numbered at; the last two tell the edges of the text."""
    at, k = r["at"], r["k"]
    inner = F.zip_with(F.slice(words, at, k - 1), F.slice(gaps, at + 1, k - 1), lambda w, g: F.concat(w, g))
    key = F.concat(F.array_join(inner, ""), F.element_at(words, at + k - 1))
    return F.struct(key.alias("key"), F.element_at(gaps, at).alias("before"), F.element_at(gaps, at + k).alias("after"), (at == 1).alias("starts"), (at + k - 1 == F.size(words)).alias("ends"))


def candidates(texts: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, key, gap_before, gap_after, starts, ends of the runs of words that a lexicon may name: all that it does, few others."""
    spark = texts.sparkSession
    sizes = sorted(r["n"] for r in keys.select(F.size(_words(F.col("key"))).alias("n")).distinct().collect())  # a lexicon has few
    named = keys.select(F.arrow_udf(_of_whole, "long")(_hashes(_words(F.col("key")))).alias("h")).distinct()
    held = spark.sparkContext.broadcast((sizes, bloom_bits(named, BITS)))

    @F.arrow_udf("array<struct<at:int,k:int>>")
    def runs_of(hashes: pa.Array) -> pa.Array:
        sizes, bits = held.value
        n = pa.compute.list_value_length(hashes).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(n) - n
        flat, of = hashes.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(n)), n)
        at, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in sizes:
            if k <= len(flat):
                i = np.flatnonzero(maybe_in(bits, _of_runs(flat, k)))
                at.append(i[of[i] == of[i + k - 1]])
                size.append(np.full(len(at[-1]), k))
        at, size = np.concatenate(at), np.concatenate(size)
        order = np.argsort(at, kind="stable")
        at, size = at[order], size[order]
        ends = np.concatenate([[0], np.cumsum(np.bincount(of[at], minlength=len(n)))])
        runs = pa.StructArray.from_arrays([pa.array((at - first[of[at]] + 1).astype(np.int32)), pa.array(size.astype(np.int32))], ["at", "k"])
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), runs)

    found = texts.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), fold(F.col(text_col)).alias("low")).withColumn("words", _words(F.col("low")))
    found = found.withColumn("runs", runs_of(_hashes(F.col("words")))).withColumn("gaps", F.when(F.size("runs") > 0, F.split("low", _WORD, -1)))
    around = F.array_distinct(F.transform("runs", lambda r: _around(F.col("words"), F.col("gaps"), r)))
    return found.select("id", F.explode(around).alias("r")).select("id", F.col("r.key").alias("key"), F.col("r.before").alias("gap_before"), F.col("r.after").alias("gap_after"), "r.starts", "r.ends")


def occurrences(texts: DataFrame, lexicon: DataFrame, id_col: str, text_col: str, label: str = "label", term: str = "term") -> DataFrame:
    """id, label of each label with a term in a text as a whole word, once; null and empty texts have none."""
    keys = lexicon_keys(lexicon, label, term)
    runs = candidates(texts, keys, id_col, text_col)
    hit = runs.join(keys, "key")
    # A sign at the edge of a name must not follow, or be followed by, a letter.
    before = (F.col("before") == "") | (F.col("gap_before").endswith(F.col("before")) & ((F.length("gap_before") > F.length("before")) | F.col("starts")))
    after = (F.col("after") == "") | (F.col("gap_after").startswith(F.col("after")) & ((F.length("gap_after") > F.length("after")) | F.col("ends")))
    return hit.where(before & after).select("id", "label").distinct()


def labelled(texts: DataFrame, lexicon: DataFrame, id_col: str, text_col: str, out: str = "labels", label: str = "label", term: str = "term", also: Column | None = None) -> DataFrame:
    """The texts with a sorted array of the labels found, together with those of ``also`` (an array column) if given.

    Rows that repeat an id get the labels of all their texts; an empty lexicon gives empty arrays.
    """
    key, more = free("dictionary_id", texts), free("dictionary_labels", texts)
    found = occurrences(texts, lexicon, id_col, text_col, label, term).groupBy(F.col("id").alias(key)).agg(F.collect_list("label").alias(more))
    none, known = F.array().cast("array<string>"), free("dictionary_also", texts)
    # ``also`` is computed before the join, so a text that is not asked for afterwards is not moved.
    all_ = texts.withColumn(known, none if also is None else F.coalesce(also, none))
    labels = F.array_union(F.coalesce(F.col(more), none), F.col(known))
    return all_.join(found, all_[id_col] == F.col(key), "left").withColumn(out, F.array_sort(labels)).drop(key, more, known)


def first_known(items: DataFrame, names: DataFrame, id_col: str, lists: list[str], name: str = "name") -> DataFrame:
    """id, label: of each item the first name of the first list that holds any name of the table (a semi join on names)."""

    def entries(k: int, c: str) -> Column:
        return F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x, i: F.struct(F.lit(k).alias("list"), i.alias("at"), x.alias("name_")))

    every = F.flatten(F.array(*[entries(k, c) for k, c in enumerate(lists)]))
    rows = items.select(F.col(id_col).alias(id_col), F.explode(every).alias("e")).select(id_col, "e.*")
    known = names.select(F.col(name).alias("name_")).where("name_ is not null").distinct()
    return rows.join(known, "name_", "left_semi").groupBy(id_col).agg(F.min_by("name_", F.struct("list", "at")).alias("label"))
