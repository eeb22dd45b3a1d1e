"""Toxicity by noisy-channel deobfuscation.

A character language model is counted over all documents. A word that mixes letters with signs or
digits, or ends in them, or repeats a letter, or is spaced out letter by letter, is a lattice: a
letter stands for itself (what repeats it may go), a sign or digit for the letters it resembles or
for nothing. Viterbi decoding under the language model restores it; the word as it stands counts
too, and words glued by signs count whole and in their parts. The words (and their beginnings) are
scored by a logistic model that is fitted on a bounded sample of labelled documents.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, shared_dir, small_batches, stored

#: Labelled documents that the model is fitted on, at most; those of the smallest hashes.
FIT_ROWS = 20_000
#: Terms of the model, at most: those of the largest weight of evidence, of those with more than LEAST_EVIDENCE.
TERMS, LEAST_EVIDENCE = 400, 8.0
FAR_BEHIND = 8.0  # states of glued words this much less likely than the best are dropped
ORDER, SIZE = 4, 28  # letters a-z, other letters, and 0 for the edge of a word
LONGEST = 24  # characters of a word that is decoded at once; longer ones in windows of twice that

# Letters that a sign or digit may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "¡": "i",
}
MASKS = "*#_"
VOWELS = "aeiou"
SPACERS = ".-_*~' "

_FOLD = np.zeros(0x250, np.uint8)
for _c in range(0x250):
    _base = unicodedata.normalize("NFD", chr(_c).lower())[:1]
    _FOLD[_c] = ord(_base) - 96 if "a" <= _base <= "z" else 27 if chr(_c).isalpha() else 0
OTHER = "ø"  # stands for every letter that folds to none of a-z
_LETTERS = {k: chr(96 + k) for k in range(1, 27)} | {27: OTHER}
_SIGN = "@$!|+€£(<¡*#"
_ODD = re.compile(rf"[^\W\d_][\d{_SIGN}_.\-~]+[^\W\d_]|^[\d@$!|+€£(<¡]+[^\W\d_]|[^\W\d_][\d{_SIGN}_]+$|(.)\1\1")
_SPACED = re.compile(r"(?<![^\W_])[^\W_](?:[ .\-_*~]{1,2}(?:[^\W_]|[@$!|+])(?![^\W_])){3,}")
_RUN = re.compile(r"(.)\1{3,}", re.DOTALL)
# Signs that no obfuscation uses part words.
_BREAKS = re.compile(rf"[^\w{_SIGN}.\-~'’]+")
_GLUE = re.compile(rf"[{_SIGN}.\-~_]+")
_EDGES = re.compile(rf"^[^\w@$!|+€£(<¡]+|[^\w{_SIGN}]+$")
_PLAIN_EDGES = ".,;:?\"')]}[{…»«“”‘’"


def classes(text: str) -> np.ndarray:
    """The letter class of each character."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 0x250, _FOLD[np.minimum(codes, 0x24F)], np.uint8(27)).astype(np.int32)


# Letters as they fold; marks and zero-width characters go.
_FLAT = {c: _LETTERS[int(_FOLD[c])] for c in range(0x250) if _FOLD[c]} | dict.fromkeys([*range(0x300, 0x370), 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
# Letters of other scripts that look like ours, read so within a word that has ours.
TWINS = dict(zip("аеорсухіѕјԁһκνοαρτυι", "aeopcyxisjdhkvoaptui", strict=True))
_TRIPLE = re.compile(r"(.)\1\1")


def flat(word: str) -> str:
    """A word in lower case with its letters folded to a-z or OTHER; signs and digits stay."""
    if word.isascii():
        return word
    plain = word.translate(_FLAT)
    if plain.isascii() or all(ch < "\u0250" for ch in plain):
        return plain
    mixed = any("a" <= ch <= "z" for ch in plain)
    return "".join((TWINS.get(ch, OTHER) if mixed else OTHER) if ch >= "\u0250" and ch.isalpha() else ch for ch in plain)


def letters_of(flat_word: str) -> str:
    return flat_word if flat_word.isalpha() else "".join(filter(str.isalpha, flat_word))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of four letters in a row within a word, with edges."""
    total = np.zeros(SIZE**ORDER, np.int64)
    for batch in batches:
        texts = [t for t in batch.column(0).to_pylist() if t]
        for k in range(0, len(texts), 64):
            c = np.concatenate([[0, 0, 0], classes(" ".join(texts[k : k + 64])), [0]])
            x3 = c[3:]
            x2 = c[2:-1]
            x1 = np.where(x2 == 0, 0, c[1:-2])
            x0 = np.where(x1 == 0, 0, c[:-3])
            total += np.bincount((((x0 * SIZE + x1) * SIZE + x2) * SIZE + x3)[(x2 > 0) | (x3 > 0)], minlength=SIZE**ORDER)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])


def letter_model(docs: DataFrame) -> np.ndarray:
    """Log-probability of a letter after three, shape (SIZE,) * 4, smoothed over shorter histories.

    The counts cover every document; the table has SIZE ** 4 entries whatever the corpus.
    """
    counts = np.zeros(SIZE**ORDER)
    for gram, n in docs.select("text").mapInArrow(_grams, "gram long, n long").groupBy("gram").agg(F.sum("n")).toLocalIterator():
        counts[gram] = n
    counts = counts.reshape((SIZE,) * ORDER)
    p = np.full((SIZE,) * ORDER, 1.0 / SIZE)
    for order in range(ORDER):
        c = counts.sum(axis=tuple(range(ORDER - 1 - order))) if order < ORDER - 1 else counts
        kinds = (c > 0).sum(-1, keepdims=True)
        p = (c + (kinds + 1) * p) / (c.sum(-1, keepdims=True) + kinds + 1)
    return np.log(p).astype(np.float32)


def ways(chars: str, k: int) -> tuple[int, list[tuple[int, float]], float | None]:
    """What the k-th character of a flat word may stand for: its own letter class (0: none), (letter, cost)
    choices, and the cost of leaving it out. A letter is only left out (None here) after its like.
    """
    ch = chars[k]
    if ch.isalpha():
        return (ord(ch) - 96 if "a" <= ch <= "z" else 27), [(ord(ch) - 96 if "a" <= ch <= "z" else 27, -0.05)], None
    options = [(ord(x) - 96, -0.7) for x in LOOKS_LIKE.get(ch, "")]
    options += [(ord(x) - 96, -2.5) for x in VOWELS if ch in MASKS]
    return 0, options, -0.3 if ch in SPACERS or k and ch == chars[k - 1] else -2.5


def _repeat_cost(chars: str, k: int) -> float | None:
    """Of leaving out a letter that repeats the one before it: little in a run of three."""
    if not k or chars[k] != chars[k - 1]:
        return None
    return -0.5 if chars[k + 1 : k + 2] == chars[k] or k > 1 and chars[k - 2] == chars[k] else -3.0


def decode(chars: str, model: np.ndarray, glued: bool = False) -> str:
    """The likeliest letters behind a flat word, or behind several ``glued`` ones; the states are the last three letters."""
    states: dict[tuple[int, int, int], tuple[float, str]] = {(0, 0, 0): (0.0, "")}
    for k in range(len(chars)):
        letter, options, skip = ways(chars, k)
        again = _repeat_cost(chars, k) if letter else None
        if glued and k:
            edge = max((s + float(model[a, b, c, 0]) - 1.0, o) for (a, b, c), (s, o) in states.items())
            states[0, 0, 0] = max(states.get((0, 0, 0), edge), edge)
            least = max(s for s, _ in states.values()) - FAR_BEHIND
            states = {x: v for x, v in states.items() if v[0] >= least}
        new: dict[tuple[int, int, int], tuple[float, str]] = {}
        for (a, b, c), (score, out) in states.items():
            found = [((b, c, x), score + cost + float(model[a, b, c, x]), out + _LETTERS[x]) for x, cost in options]
            left_out = skip if not letter else again if letter == c else None
            if left_out is not None:
                found.append(((a, b, c), score + left_out, out))
            for state, s, o in found:
                if state not in new or (s, o) > new[state]:
                    new[state] = (s, o)
        states = new
    return max((s + float(model[a, b, c, 0]), o) for (a, b, c), (s, o) in states.items())[1]


class Restorer(dict):
    """Maps a word in lower case to its restored words, remembering up to ``most`` words at a time.

    They are the whole word, what stands between signs that no obfuscation uses, and, as other signs
    may be letters or separate words, also what stands between those: each as it stands and, if it
    is a lattice, decoded. ``may(flat word, anywhere)`` can tell that no decoding is of use.
    """

    most = 200_000

    def __init__(self, model: np.ndarray, may: Callable[[str, bool], bool] = lambda word, anywhere: True):
        super().__init__()
        self.model, self.may = model, may

    def __missing__(self, word: str) -> tuple[str, ...]:
        out = self.readings(word)
        if len(self) >= self.most:
            self.clear()
        if len(word) <= 4 * LONGEST:
            self[word] = out
        return out

    def readings(self, word: str) -> tuple[str, ...]:
        core = flat(word.strip(_PLAIN_EDGES))
        if core.isalpha() and not _TRIPLE.search(core):
            return (core,)
        core = _RUN.sub(r"\1\1\1", _EDGES.sub("", core))
        pieces = [p for p in _BREAKS.split(core) if p]
        found = self._one(core) if len(core) <= LONGEST or len(pieces) == 1 else []
        if not core.isalpha():
            parts = [g for p in pieces for g in _GLUE.split(p)]
            for part in dict.fromkeys([*pieces, *parts]):
                part = _EDGES.sub("", part)
                if part != core and len(part) > 2:
                    found += self._one(part)
        return tuple(dict.fromkeys(found))

    def _one(self, core: str) -> list[str]:
        """A piece as it stands, and decoded; of a long lattice, what begins at any letter."""
        plain = letters_of(core)
        found = [plain] if plain else []
        if plain and _ODD.search(core):
            if len(core) > LONGEST:
                found += decoded_windows(core, self.model, self.may, glued=True)
            elif self.may(core, False):
                found.append(decode(core, self.model))
        return found


def decoded_windows(run: str, model: np.ndarray, may: Callable[[str, bool], bool], glued: bool = False) -> Iterator[str]:
    """Each beginning of a word in overlapping windows: what has up to LONGEST characters lies in one of them."""
    for k in range(0, max(1, len(run) - LONGEST), LONGEST):
        window = run[k : k + 2 * LONGEST]
        if may(window, True):
            letters = decode(window, model, glued)
            yield from (letters[i:] for i in range(len(letters) - 2))


def restored_words(text: str | None, words: Restorer) -> set[str]:
    """The distinct restored words of a whole text."""
    if not text:
        return set()
    low = text.lower()
    out = {x for w in set(low.split()) for x in words[w]}
    return out.union(spaced_words(low, words))


def spaced_words(low: str, words: Restorer) -> list[str]:
    """Words spelled letter by letter: each run is decoded in windows, and as single letters before a word
    join its run, a word may start at any letter of it.
    """
    out = []
    for m in _SPACED.finditer(low):
        run = flat(m.group())
        if any(ch.isalpha() for ch in run):
            out += decoded_windows(run, words.model, words.may)
    return out


def _terms(word: str) -> list[str]:
    """A word and its beginnings."""
    return [] if len(word) < 3 else [f"={word}", *(word[:n] for n in range(4, min(9, len(word) + 1)))]


def _lattice_of(head: str) -> str:
    """A pattern of all flat words whose decoding may begin with ``head``."""
    stands = lambda x: x + "".join(c for c, of in LOOKS_LIKE.items() if x in of) + (MASKS if x in VOWELS else "")
    return "".join(f"[{re.escape(stands(x))}](?:{x}|[^a-z{OTHER}])*" for x in head)


class Scorer:
    """What a task needs: the letter model, the terms and their weights."""

    most = 200_000

    def __init__(self, model: np.ndarray, terms: list[str], weights: np.ndarray, bias: float):
        self.model, self.terms, self.weights, self.bias = model, {t: k for k, t in enumerate(terms)}, weights, bias
        self.heads = {t.lstrip("=")[:4] for t in terms}
        self.of_word: dict[str, tuple[int, ...]] = {}
        self.words: Restorer | None = None

    def _begin(self) -> None:
        """Once in each worker."""
        any_head = "|".join(sorted(map(_lattice_of, self.heads))) or "(?!)"
        at_start, anywhere = re.compile(f"[^a-z{OTHER}]*(?:{any_head})").match, re.compile(any_head).search
        self.words = Restorer(self.model, lambda word, inside: bool((anywhere if inside else at_start)(word)))

    def found(self, text: str | None) -> list[int]:
        if self.words is None:
            self._begin()
        if not text:
            return []
        low, known, hits = text.lower(), self.of_word, set()
        for w in set(low.split()):
            ids = known.get(w)
            if ids is None:
                ids = self._look(w)
                if len(known) >= self.most:
                    known.clear()
                if len(w) <= 4 * LONGEST:
                    known[w] = ids
            if ids:
                hits.update(ids)
        for word in spaced_words(low, self.words):
            hits.update(self._ids(word))
        return sorted(hits)

    def _look(self, w: str) -> tuple[int, ...]:
        """Terms of a raw word; a plain word whose first letters begin no term needs no more."""
        core = w if w.isalpha() else w.strip(_PLAIN_EDGES)
        if core.isalpha() and flat(core)[:4] not in self.heads and not _TRIPLE.search(core):
            return ()
        return tuple({i for word in self.words.readings(w) for i in self._ids(word)})

    def _ids(self, word: str) -> list[int]:
        return [self.terms[t] for t in _terms(word) if t in self.terms] if word[:4] in self.heads else []

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weights[self.found(text)].sum())
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _fit(rows: list[tuple[list[int], int]], n: int) -> tuple[np.ndarray, float]:
    """Logistic regression with an L2 penalty, by accelerated gradient steps."""
    x = np.zeros((len(rows), n + 1), np.float32)
    for k, (ids, _) in enumerate(rows):
        x[k, ids] = 1
    x[:, n] = 1
    y = np.array([r[1] for r in rows], np.float32)
    penalty = np.append(np.full(n, 0.5 / len(rows)), 0).astype(np.float32)
    step = 1 / (0.25 * np.linalg.norm(x.T @ x / len(rows), 2) + penalty.max())
    w = v = np.zeros(n + 1, np.float32)
    for k in range(800):
        g = x.T @ (1 / (1 + np.exp(-(x @ v))) - y) / len(rows) + penalty * v
        w, old = v - step * g, w
        v = w + (k / (k + 3)) * (w - old)
    return w[:n], float(w[n])


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray, path: str) -> Scorer:
    """A scorer fitted on up to FIT_ROWS labelled documents outside the held-out fifth.

    Equal texts count once. Terms are gathered from the toxic ones and counted in the others; without
    both kinds of label the score is a constant.
    """
    labels = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
    labels = labels.where("_id is not null and _toxic in (0, 1)").where(~held_out("_id")).groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    few = stored(labels.orderBy(F.xxhash64("_id"), "_id").limit(FIT_ROWS), f"{path}/few")  # bounded, so it may be broadcast
    rows = docs.select(F.col("doc_id").alias("_id"), "text").join(F.broadcast(few), "_id").select("_toxic", "text").dropDuplicates(["_toxic", "text"])
    held = docs.sparkSession.sparkContext.broadcast(model)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Restorer(held.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sorted(restored_words(t, known)) for t in batch.column(1).to_pylist()], pa.list_(pa.string()))], ["toxic", "words"])

    sample = stored(rows.mapInArrow(words, "toxic int, words array<string>"), f"{path}/sample")
    sizes = dict(sample.groupBy("toxic").count().collect())
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Scorer(model, [], np.zeros(0), 40.0 if bad else -40.0)

    def counted(kind: int, wanted: list[str] | None) -> dict[str, int]:
        keep = None if wanted is None else docs.sparkSession.sparkContext.broadcast(set(wanted))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n: Counter = Counter()
            for batch in batches:
                for words in batch.column(0).to_pylist():
                    terms = {t for w in words for t in _terms(w)}
                    n.update(terms if keep is None else terms & keep.value)
            yield pa.RecordBatch.from_arrays([pa.array(list(n)), pa.array(list(n.values()), pa.int64())], ["term", "n"])

        got = sample.where(F.col("toxic") == kind).select("words").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
        # What can't reach the least evidence, were it in no other document, is not counted there.
        most = F.col("n") * F.log((F.col("n") + 0.5) / (bad + 1) * (good + 1) / 0.5)
        return dict((got if wanted is not None else got.where(most > LEAST_EVIDENCE)).collect())

    in_bad = counted(1, None)
    in_good = counted(0, list(in_bad))

    def evidence(t: str) -> float:
        p, q = (in_bad[t] + 0.5) / (bad + 1), (in_good.get(t, 0) + 0.5) / (good + 1)
        return in_bad[t] * math.log(p / q) if p > 3 * q else 0.0

    terms = sorted((t for t in in_bad if evidence(t) > LEAST_EVIDENCE), key=lambda t: (-evidence(t), t))[:TERMS]
    scorer = Scorer(model, terms, np.zeros(len(terms)), 0.0)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = scorer.terms
        for batch in batches:
            ids = [sorted({at[t] for w in words for t in _terms(w) if t in at}) for words in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int32())), batch.column(0)], ["ids", "toxic"])

    fitted = [(r["ids"], r["toxic"]) for r in sample.mapInArrow(hits, "ids array<int>, toxic int").collect()]
    scorer.weights, scorer.bias = _fit(fitted, len(terms))
    return scorer


def held_out(col: str):
    return F.crc32(F.col(col).cast("string")) % 5 == 0


def trained(docs: DataFrame, labels: DataFrame) -> Scorer:
    small_batches(docs.sparkSession)
    return fit(docs, labels, letter_model(docs), shared_dir(docs.sparkSession))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, restored terms found: one row for each row of docs.

    Null and empty texts get the score of a text without any term. Labels, lang, source and
    doc_id are no inputs of a score. held_out is null for a null doc_id.
    """
    held = docs.sparkSession.sparkContext.broadcast(trained(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([scorer.score(t) for t in batch.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs with a score under 0.5, all columns unchanged; moves no rows."""
    held = docs.sparkSession.sparkContext.broadcast(trained(docs, labels))

    def run(batches: Iterator[pa.RecordBatch], text_at=docs.columns.index("text")) -> Iterator[pa.RecordBatch]:
        scorer = held.value
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t) < 0.5 for t in batch.column(text_at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
