"""Collocations: phrases of two to four words that occur more often than their parts suggest.

Units are ranked by frequency and counted pair by pair. At first a unit is a word, and a pair of
neighbours is a phrase of two words; the frequent pairs are then ranked anew and become the units,
and two neighbours that overlap in all but one word are a phrase of one word more. A phrase can't
be frequent unless the two units it consists of are, so each level sees less of the text.

The ranks of the ``HEAD`` most frequent units address tiles of ``TILE`` x ``TILE`` cells directly:
in each task, tiles with many pairs are counted by a dense ``bincount``, the others as sorted
coordinates. Units beyond the head are known by a hash, and a Bloom filter of ``BITS`` bits keeps
out most of those that are not frequent; it only spares work, as counts are filtered at the end.
So what is broadcast has a fixed bound whatever the size of the corpus: 8 bytes for each unit of
the head and the filter, at each level.

Encoded texts lie in short rows, since readers hold 4096 rows of a table at once. A text is cut
anywhere; the next row's first units are repeated, and pairs that start there count in the next row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bloom_bits, maybe_in, read, shared_dir, small_batches, stored

LEAST, LONGEST, TOP, INSIDE = 30, 4, 2000, 80
NO_LANG = "und"
HEAD, TILE, BITS = 1 << 17, 1 << 10, 1 << 26
#: Pairs counted at once in a task, and words that a task holds at once.
CHUNK, WORDS_HELD = 1 << 20, 100_000
#: Units in a row of the encoded texts, without the next row's; units that a task works on at once; MB of an Arrow batch to a task and rows of one with counts from it; MB of a row group of encoded texts.
ROW, UNITS, BATCH_MB, BATCH, GROUP_MB = 1 << 10, 1 << 17, 4, 1 << 16, 16
#: A tile with so many pairs in a chunk is counted densely.
DENSE = TILE * TILE // 8
_SIDE = HEAD // TILE

# Signs and line ends that part pieces become line feeds, tabs become blanks.
_SIGNS = bytes.maketrans(b".,;:!?\x0b\x0c\x0d\t", b"\n\n\n\n\n\n\n\n\n ")
_BREAK, _NOTHING = -1, -2


def split_words(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8 with A-Z lower-cased; a line feed stands where a piece ends; empty entries mean nothing."""
    return text.lower().translate(_SIGNS).replace(b"\n", b" \n ").split(b" ") if text else []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hashes (int64) of pairs of codes."""
    return _mixed(_mixed(left.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) + right.astype(np.uint64)).view(np.int64)


def word_hash(word: bytes, seed: int) -> int:
    """As Spark's ``xxhash64(lang, word)``, where seed is ``word_hash(lang, 42)``."""
    h = xxhash.xxh64_intdigest(word, seed & (2**64 - 1))
    return h - 2**64 if h >= 2**63 else h


class Codes:
    """Codes of frequent units by their hashes: the rank in the head, beyond it a number from the hash, else -1.

    bits is None if all frequent units are in the head.
    """

    def __init__(self, head: np.ndarray, bits: np.ndarray | None) -> None:
        self.order = np.argsort(head, kind="stable").astype(np.int64)
        self.keys, self.bits = head[self.order], bits

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.ones(len(hashes), bool)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            known = self.keys[at] == hashes
            out[known], open_ = self.order[at[known]], ~known
        if self.bits is not None:
            open_ &= maybe_in(self.bits, hashes)
            out[open_] = (HEAD + (hashes.view(np.uint64)[open_] >> np.uint64(2))).view(np.int64)
        return out

    def joined(self, units: np.ndarray) -> np.ndarray:
        """Codes of each unit with its right neighbour."""
        out = np.full(max(len(units) - 1, 0), -1, np.int64)
        at = np.flatnonzero((units[:-1] >= 0) & (units[1:] >= 0)) if len(units) else []
        if len(at):
            out[at] = self.of(pair_hash(units[at], units[at + 1]))
        return out


def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Tile and cell of pairs of ranks in the head, as one number."""
    tile = (left // TILE) * _SIDE + right // TILE
    return tile * (TILE * TILE) + (left % TILE) * TILE + right % TILE


def _key_counts(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    tile = (keys // (TILE * TILE)).astype(np.uint16)
    sizes = np.bincount(tile, minlength=_SIDE * _SIDE)
    for t in np.flatnonzero(sizes >= DENSE):
        counts = np.bincount(keys[tile == t] % (TILE * TILE), minlength=TILE * TILE)
        found = np.flatnonzero(counts)
        yield (t // _SIDE) * TILE + found // TILE, (t % _SIDE) * TILE + found % TILE, counts[found]
    found = keys[(sizes < DENSE)[tile]]
    del tile
    found.sort()
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.empty(0, np.int64)
    counts, found = np.diff(first, append=len(found)), found[first]
    t, c = found // (TILE * TILE), found % (TILE * TILE)
    yield (t // _SIDE) * TILE + c // TILE, (t % _SIDE) * TILE + c % TILE, counts


def _far_counts(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    if len(a):
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        yield a[first], b[first], np.diff(np.concatenate([first, [len(a)]]))


def tile_counts(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """left, right, count of distinct pairs of codes."""
    head = (left < HEAD) & (right < HEAD)
    yield from _key_counts(_keys(left[head], right[head]))
    yield from _far_counts(left[~head], right[~head])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            for nothing in (b"", b"\n"):
                counts.pop(nothing, None)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["lang", "word", "c"])
        held.clear()

    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            held.setdefault(lang, Counter()).update(split_words(text.as_py()))
            if sum(map(len, held.values())) > WORDS_HELD:
                yield from out()
    yield from out()


class _WordCodes(dict):
    """Codes of a language's words; what a text has beyond those remembered is looked up at once."""

    def __init__(self, codes: Codes, lang: str) -> None:
        super().__init__({b"": _NOTHING, b"\n": _BREAK})
        self.codes, self.seed = codes, word_hash(lang.encode(), 42)

    def units(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in set(words) if w not in self]
        if new:
            found = self.codes.of(np.fromiter((word_hash(w, self.seed) for w in new), np.int64, len(new)))
            self.update(zip(new, found.tolist(), strict=True))
        out = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return out[out != _NOTHING]


def _encode(batches: Iterator[pa.RecordBatch], codes: Broadcast, longest: int = LONGEST) -> Iterator[pa.RecordBatch]:
    """Rows of ROW units and the longest - 1 after them; if fewer come after, the row ends with a break."""
    of: dict[str, _WordCodes] = {}
    units, n = [], 0

    def out() -> Iterator[pa.RecordBatch]:
        held = np.concatenate(units).astype(np.int64)
        units.clear()
        for at in range(0, len(held), UNITS):
            rows = [held[i : i + ROW + longest - 1].tobytes() for i in range(at, min(at + UNITS, len(held)), ROW)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["units"])

    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            if sum(map(len, of.values())) > WORDS_HELD:
                of.clear()
            if lang not in of:
                of[lang] = _WordCodes(codes.value, lang)
            units += [of[lang].units(split_words(text.as_py())), [_BREAK]]
            n += len(units[-2]) + 1
            if n >= UNITS:
                yield from out()
                n = 0
    if units:
        yield from out()


def _row_pairs(rows: list[np.ndarray], codes: list[Broadcast]) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours in encoded rows, but for those that the next row has too."""
    units, own = np.concatenate(rows), np.concatenate([np.arange(len(row)) < ROW for row in rows])
    for c in codes:
        units = c.value.joined(units)
    both = (units[:-1] >= 0) & (units[1:] >= 0) & own[: max(len(units) - 1, 0)]
    return units[:-1][both], units[1:][both]


def _count_pairs(batches: Iterator[pa.RecordBatch], codes: list[Broadcast]) -> Iterator[pa.RecordBatch]:
    """Counts of neighbours among the units that the codes of the levels so far make of the words."""
    keys, left, right, n = [], [], [], 0

    def out() -> Iterator[pa.RecordBatch]:
        near, a, b = np.concatenate(keys), np.concatenate(left), np.concatenate(right)
        for held in (keys, left, right):
            held.clear()
        for counts in (_key_counts(near), _far_counts(a, b)):
            for found in counts:
                for at in range(0, len(found[0]), BATCH):
                    yield pa.RecordBatch.from_arrays([pa.array(x[at : at + BATCH].astype(np.int64)) for x in found], ["left", "right", "c"])

    for batch in batches:
        column = batch.column(0)
        for at in range(0, len(column), UNITS // ROW):
            a, b = _row_pairs([np.frombuffer(row.as_py(), np.int64) for row in column.slice(at, UNITS // ROW)], codes)
            head = (a < HEAD) & (b < HEAD)
            keys.append(_keys(a[head], b[head]))
            left.append(a[~head])
            right.append(b[~head])
            n += len(a)
            if n >= CHUNK:
                yield from out()
                n = 0
    if keys:
        yield from out()


def _codes_of(units: DataFrame, most: int) -> Broadcast:
    """Codes of a level's frequent units: h, f. Collects ``most`` hashes and BITS bits at most."""
    spark = units.sparkSession
    head = units.select("h", "f").orderBy(F.desc("f"), "h").limit(most).toPandas()["h"].to_numpy(np.int64)
    bits = None
    if len(head) == most and units.count() > most:
        bits = bloom_bits(units.select("h"), BITS)
    return spark.sparkContext.broadcast(Codes(head, bits))


def _with_codes(units: DataFrame, codes: Broadcast) -> DataFrame:
    """Adds code to units: h and more."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(batch.schema.get_field_index("h")).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes.value.of(h))], [*batch.schema.names, "code"])

    return units.mapInArrow(add, f"{units._jdf.schema().toDDL()}, code long")


def _with_pair_hash(pairs: DataFrame) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pair_hash(left, right))], ["left", "right", "f", "h"])

    return pairs.mapInArrow(add, "left long, right long, f long, h long")


def _worst_cut(k: int) -> Column:
    """The lowest score of a phrase of k words over its cuts, ties to the earliest: struct<score, cut, l, r>."""
    cuts = []
    for cut in range(1, k):
        l, r = F.element_at("first", cut), F.element_at("last", k - cut)
        score = F.expr(f"(cast(2000000 as decimal(7,0)) * f) div (cast(first[{cut - 1}] as decimal(19,0)) + last[{k - cut - 1}])")
        cuts.append(F.struct(score.alias("score"), F.lit(cut).alias("cut"), l.alias("l"), r.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP, head: int = HEAD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the ``top`` best phrases of 2 to ``longest`` words.

    a, l, r count the phrase and the parts of its worst cut, n all words of the language; the score
    is floor(2000000 * a / (l + r)). Phrases within a longer one that takes ``INSIDE`` per cent of
    their occurrences are dropped. A null language is ``und``; null and empty texts hold no words;
    repeated rows count as often as they occur; other columns, whatever their names, are ignored; an
    empty table gives no rows. ``head`` bounds the units that address tiles, at each level. Counts are exact but for units whose 64-bit hashes are equal (with
    10^8 frequent units of a level, a chance of about 3e-4 that there are any two).
    """
    if longest < 2 or least < 1 or not 0 < head <= HEAD:
        raise ValueError("phrases have two words or more and occur once at least; the head has up to HEAD units")
    spark, path = docs.sparkSession, shared_dir(docs.sparkSession)
    small_batches(spark, mb=BATCH_MB)
    texts = docs.select(F.col(text_col).cast("binary").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"))
    words = texts.mapInArrow(_count_words, "lang string, word binary, c long").groupBy("lang", "word").agg(F.sum("c").alias("f"))
    words = stored(words.select("lang", F.col("word").cast("string").alias("phrase"), "f"), f"{path}/words")
    all_words = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= least).withColumn("h", F.xxhash64("lang", "phrase"))
    codes = [_codes_of(frequent, head)]
    first = codes[0]
    encoded = stored(texts.mapInArrow(lambda batches: _encode(batches, first, longest), "units binary"), f"{path}/encoded", codec="zstd", **{"parquet.block.size": str(GROUP_MB << 20)})
    units = _with_codes(frequent, first).select("code", "lang", "phrase", "f", F.array("f").alias("first"), F.array("f").alias("last"), F.col("phrase").alias("end"))
    units = stored(units, f"{path}/units1")
    levels = []
    for k in range(2, longest + 1):
        so_far = codes[1:]
        counted = encoded.mapInArrow(lambda batches, c=tuple(so_far): _count_pairs(batches, c), "left long, right long, c long")
        pairs = counted.groupBy("left", "right").agg(F.sum("c").alias("f")).where(F.col("f") >= least)
        pairs = stored(_with_pair_hash(pairs), f"{path}/pairs{k}")
        codes.append(_codes_of(pairs, head))
        pairs = _with_codes(pairs, codes[-1])
        before = units.select(F.col("code").alias("left"), "lang", F.col("phrase").alias("start"), "first")
        after = units.select(F.col("code").alias("right"), "last", "end")
        grown = lambda c: F.concat(c, F.array("f"))
        new = pairs.join(before, "left").join(after, "right")
        new = new.select("left", "right", "code", "lang", F.concat_ws(" ", "start", "end").alias("phrase"), "f", grown("first").alias("first"), grown("last").alias("last"), "end")
        units = stored(new, f"{path}/units{k}")
        levels.append(units)
    kept = []
    for k, level in enumerate(levels, 2):
        if k < longest:
            longer = levels[k - 1]
            most = longer.select(F.col("left").alias("code"), "f").unionByName(longer.select(F.col("right").alias("code"), "f"))
            most = most.groupBy("code").agg(F.max("f").alias("most"))
            level = level.join(most, "code", "left").where(f"most is null or cast(100 as decimal(3,0)) * most < cast({INSIDE} as decimal(3,0)) * f")
        kept.append(level.withColumn("cut", _worst_cut(k)).select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score"))
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("int")
    best = out.withColumn("rank", rank).where(F.col("rank") <= top).join(all_words, "lang")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


_NEXT = ", ".join(f"lead(word, {k}) OVER piece AS w{k}" for k in range(1, LONGEST))
_GRAMS = " UNION ALL ".join(f"SELECT lang, {k} AS k, concat_ws(' ', word, {', '.join(f'w{j}' for j in range(1, k)) or 'NULL'}) AS phrase FROM neighbours WHERE {f'w{k - 1} IS NOT NULL' if k > 1 else 'true'}" for k in range(1, LONGEST + 1))

SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, row_number() OVER () AS nr, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
flat AS (SELECT lang, nr, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
neighbours AS (SELECT lang, word, {_NEXT} FROM flat WINDOW piece AS (PARTITION BY nr ORDER BY i)),
grams AS ({_GRAMS}),
f AS (SELECT lang, k, phrase, lang || chr(10) || phrase AS key, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= {LEAST}),
cuts AS (SELECT c.*, j, lang || chr(10) || array_to_string(w[1:j], ' ') AS key_1, lang || chr(10) || array_to_string(w[j+1:], ' ') AS key_2 FROM candidates c, unnest(range(1, k)) AS u(j)),
scored AS (
  SELECT c.lang, c.k, c.phrase, a, j, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * a // (x.f + y.f) AS score
  FROM cuts c JOIN f x ON x.key = key_1 JOIN f y ON y.key = key_2),
worst AS (SELECT lang, k, phrase, a, min(struct_pack(score := score, j := j, l := l, r := r)) AS cut FROM scored GROUP BY ALL),
inner_parts AS (SELECT lang, unnest([array_to_string(w[1:k-1], ' '), array_to_string(w[2:], ' ')]) AS phrase, a FROM candidates WHERE k > 2),
most AS (SELECT lang, phrase, max(a) AS most FROM inner_parts GROUP BY ALL),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase) AS rank, phrase, a, cut.l AS l, cut.r AS r, cut.score AS score
  FROM worst LEFT JOIN most USING (lang, phrase) WHERE most IS NULL OR 100 * CAST(most AS HUGEINT) < {INSIDE} * CAST(a AS HUGEINT))
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}
"""
