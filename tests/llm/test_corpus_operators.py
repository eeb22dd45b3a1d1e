"""Phrases, spelling variants and repeated passages against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsmarket.llm import phrases, repeats, variants

DOCS = "doc_id long, text string, lang string, source string, word string, gram string, k1 long, rank int"


def docs(spark, rows):
    """Documents with columns whose names clash with ours."""
    return spark.createDataFrame([(i, t, lang, "s", "w", "g", 1, 2) for i, t, lang in rows], DOCS)


def lower(x):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in x)


# Phrases


def brute_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang or "und", tuple(words[i : i + k])] += 1
    found = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, w), a in found.items():
        inside = any(lg == lang and len(x) > len(w) and any(x[i : i + len(w)] == w for i in range(len(x))) and 100 * b >= 80 * a for (lg, x), b in found.items())
        if not inside:
            cuts = [(2000000 * a // (f[lang, w[:j]] + f[lang, w[j:]]), j) for j in range(1, len(w))]
            score, j = min(cuts)
            out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:j]], f[lang, w[j:]]))
    return {(lang, k, p.decode(), -a, lt, r, n[lang], -s) for lang, rows in out.items() for k, (s, a, p, lt, r) in enumerate(sorted(rows)[:top], 1)}


def corpus(rng, n=60):
    vocab, out = ["a", "B", "c", "é", "x-y", "\x1c", "New", "York", "city", "ÀB"], []
    for i in range(n):
        words = [rng.choice(["New York city", "new york", *vocab]) for _ in range(rng.randrange(0, 60))]
        text = "".join(w + rng.choice([" ", "  ", "\t", " ", ". ", "\n", "!", " "]) for w in words)
        out.append((i, rng.choice([text, text, text, None, ""]), rng.choice(["en", "de", None])))
    return out + [(n + 1, "a " * 500, "en"), (n + 1, "a " * 500, "en")]


@pytest.mark.parametrize("head", [phrases.HEAD, 3])
def test_phrases_brute(spark, head):
    rows = corpus(random.Random(head))
    got = phrases.collocations(docs(spark, rows), least=5, top=40, head=head)
    assert {tuple(r) for r in got.collect()} == brute_phrases(rows, 5, 40)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(docs(spark, [])).collect() == []
    assert phrases.collocations(docs(spark, [(1, None, None), (2, "", "en")])).collect() == []


def test_word_hash_is_sparks(spark):
    word, lang = "naïve", "und"
    assert spark.range(1).select(F.xxhash64(F.lit(lang), F.lit(word))).first()[0] == phrases.word_hash(word.encode(), phrases.word_hash(lang.encode(), 42))


def test_tiles_dense_and_sparse():
    rng = np.random.default_rng(1)
    left = np.concatenate([rng.integers(0, 900, 300_000), rng.integers(0, phrases.HEAD, 5000), phrases.HEAD + rng.integers(0, 5, 100)])
    right = np.concatenate([rng.integers(0, 900, 300_000), rng.integers(0, phrases.HEAD, 5000), rng.integers(0, 5, 100)])
    got = Counter()
    for a, b, c in phrases.tile_counts(left, right):
        for row in zip(a.tolist(), b.tolist(), c.tolist(), strict=True):
            got[row[:2]] += row[2]
    assert got == Counter(zip(left.tolist(), right.tolist(), strict=True))


class Held:
    def __init__(self, value):
        self.value = value


def test_phrase_batches_are_bounded(monkeypatch):
    """However long the texts, rows of encoded texts and batches of counts have a fixed size, and no pair is lost or counted twice at a cut."""
    monkeypatch.setattr(phrases, "BATCH", 100, raising=False)
    rng = np.random.default_rng(2)
    words = rng.integers(0, 40, 200_000)
    texts = [" ".join(f"w{w}" for w in words), "w1 w2", "", *(" ".join(["w3"] * n) for n in range(1020, 1032))]
    seed = phrases.word_hash(b"en", 42)
    hashes = np.array([phrases.word_hash(b"w%d" % w, seed) for w in range(40)])
    pairs = np.array([(a, b) for a in range(40) for b in range(40)])
    codes = [Held(phrases.Codes(hashes, None)), Held(phrases.Codes(phrases.pair_hash(pairs[:, 0], pairs[:, 1]), None))]
    batch = phrases.pa.RecordBatch.from_pydict({"text": [t.encode() for t in texts], "lang": ["en"] * len(texts)})
    encoded = list(phrases._encode(iter([batch]), codes[0]))
    assert max(len(row.as_py()) for b in encoded for row in b.column(0)) <= 8 * (1024 + 3)
    ids = [np.array([int(w[1:]) for w in t.split()], np.int64) for t in texts]
    for so_far, units in (([], ids), (codes[1:], [x[:-1] * 40 + x[1:] for x in ids])):
        got, want = Counter(), Counter()
        for b in phrases._count_pairs(iter(encoded), so_far):
            assert b.num_rows <= 100
            for left, right, c in zip(*(x.to_pylist() for x in b.columns), strict=True):
                got[left, right] += c
        for x in units:
            want.update(zip(x[:-1].tolist(), x[1:].tolist(), strict=True))
        assert got == want


# Spelling variants


def brute_variants(rows):
    n = Counter()
    for d, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    form = {w: min(xs, key=lambda x: (-n[x], x)) for w, xs in near.items() if xs}
    form = {w: x for w, x in form.items() if n[x] >= 2 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


@pytest.mark.parametrize(("frequent", "longest"), [(64, 64), (2, 3)])
def test_variants_brute(spark, monkeypatch, frequent, longest):
    monkeypatch.setattr(variants, "FREQUENT", frequent)
    monkeypatch.setattr(variants, "LIST", longest)
    rng = random.Random(longest)
    base = ["".join(rng.choice("abé×ÿz") for _ in range(rng.randrange(5, 12))) for _ in range(40)] + ["aaaaa", "aaaaaaaaaa", "abababab"]
    words = ["chainaa"] * 6 + ["chainab"] * 24 + ["chaincb"] * 96
    for w in base:
        words += [w] * rng.choice([3, 6, 12, 40])
        for _ in range(6):
            i = rng.randrange(len(w))
            words += [rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abé") + w[i:], w[:i] + rng.choice("abé") + w[i + 1 :]])] * rng.choice([1, 3, 5])
    rng.shuffle(words)
    rows = [(k, "".join(w.upper() if rng.random() < 0.1 and w.isascii() else w + rng.choice([" ", "1", "—", "漢"]) for w in words[k * 40 : k * 40 + 40]), "en") for k in range(len(words) // 40 + 1)]
    rows += [(900, None, "en"), (901, "", "en"), rows[0]]
    want = brute_variants(rows)
    got = {tuple(r) for r in variants.spelling_variants(docs(spark, rows)).collect()}
    assert got == want and any(w[1] for w in want) and any(w[2] != w[1] for w in want if w[1])


def test_affected_grams_are_bounded():
    """Near words share all but ``a`` grams of either, at places that fit, whatever the dictionary."""
    rng = random.Random(3)
    for _ in range(3000):
        w = "".join(rng.choice("ab") for _ in range(rng.randrange(5, 10)))
        i, c = rng.randrange(len(w) + 1), rng.choice("abc")
        x = rng.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])
        if x == w or len(x) < 5:
            continue
        dictionary = {"".join(rng.choice("ab^$") for _ in range(rng.randrange(2, 5))): rng.randrange(3, 9) for _ in range(30)}
        (a, gw), (b, gx) = variants.decomposed(w, dictionary), variants.decomposed(x, dictionary)
        left = Counter(g for _, g, _ in gw) & Counter(g for _, g, _ in gx)
        assert left.total() >= max(len(gw) - a, len(gx) - b) >= 1


def test_variants_of_nothing(spark):
    assert variants.spelling_variants(docs(spark, [])).collect() == []


# Repeated passages


def brute_repeats(texts, size=repeats.LENGTH):
    seen, out = Counter(), []
    texts = [(t or "").encode() for t in texts]
    for b in texts:
        seen.update(b[i : i + size] for i in range(len(b) - size + 1))
    for b in texts:
        covered = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                covered[i : i + size] = b"\1" * size
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out.append((len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("longest", "bucket"), [(512, 1_000_000), (3, 2000)])
def test_repeats_brute(spark, monkeypatch, longest, bucket):
    monkeypatch.setattr(repeats, "LIST", longest)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", bucket)
    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choice("abcdefgé") for _ in range(rng.randrange(2, 7))) for _ in range(n))
    passage = text(70)
    texts = [None, "", "x" * 150, "y" * 700, text(100), text(300)]
    texts += [texts[4], texts[5][:500] + text(30), "z" + "y" * 500]
    texts += [text(rng.randrange(0, 40)) + " " + passage + " " + text(rng.randrange(0, 40)) for _ in range(25)]
    texts += [passage[:k] for k in (190, 199, 200, 201, 230, 260)] + ["é" * 100, "é" * 101, "a\x00b" * 90, "a\x00b" * 90 + "c"]
    got = repeats.without_repeats(docs(spark, [(i, t, "en") for i, t in enumerate(texts)])).collect()
    assert [tuple(r)[1:5] for r in sorted(got)] == brute_repeats(texts)
    for r in got:  # the spans are those of the digest
        b, at, kept = (texts[r["doc_id"]] or "").encode(), 0, b""
        for s in r["spans"]:
            kept, at = kept + b[at : s["s"]], s["e"]
        assert hashlib.sha256(kept + b[at:]).hexdigest() == r["kept_sha256"]


def test_repeats_of_equal_rows_and_nothing(spark):
    long_ = "".join(random.Random(1).choices("abcdef ", k=1000))
    got = repeats.without_repeats(docs(spark, [(1, long_, "en"), (1, long_, "en"), (None, long_[:150], "en")])).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"], r["n_spans"]) for r in got) == [(0, 0, 0), (1, 1000, 1), (1, 1000, 1)]
    assert repeats.without_repeats(docs(spark, [])).collect() == []


def test_segments_across_pieces(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 300)
    text = bytes(random.Random(2).choices(b"abcd", k=5000))
    starts = [w for s, e, _, _ in repeats.segments(text) for i, j in zip(s.tolist(), e.tolist(), strict=True) for w in range(i, j - repeats.LENGTH + 1)]
    assert starts == list(range(len(text) - repeats.LENGTH + 1))
    hashes = {w: a for s, e, _, h in repeats.segments(text) for i, j, a in zip(s.tolist(), e.tolist(), h.tolist(), strict=True) for w in range(i, j - repeats.LENGTH + 1)}
    assert [a for s, e, _, h in repeats.segments(text[777:1200]) for i, j, a in zip(s.tolist(), e.tolist(), h.tolist(), strict=True) for w in range(i, j - repeats.LENGTH + 1)] == [hashes[777 + w] for w in range(1200 - 777 - repeats.LENGTH + 1)]


def test_run_index_compresses_copies():
    base = bytes(random.Random(4).choices(b"abcd", k=300))
    copies = sorted({base[k : k + 260] + bytes([65 + k]) for k in range(40)})
    index = repeats.RunIndex(copies)
    assert index.runs < len(index.text) / 8
    assert all(index.text[x : x + n].tolist() == index.text[y : y + n].tolist() for x, y, n in zip(*index.long_matches(200), strict=True))
