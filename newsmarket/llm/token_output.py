"""Token ids as ORC: run-length coded integers, row indexes and Bloom filters on document ids.

Documents are dealt by ranges of doc_id, encoded, and written as one ORC file a range, sorted by
doc_id. Stripes can be read in parallel; a filter on doc_id prunes files and stripes by their
minima and maxima, row groups by the row index, and the rest by the Bloom filter.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, read, shared_dir, small_batches

END = 2
STRIPE_BYTES, INDEX_ROWS, BLOOM_FPP = 16 << 20, 1000, 0.01
SCHEMA = "doc_id long, block int, row long, n_tokens int, ids array<int>"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Characters of a piece that is remembered, at most.
LONGEST_KEPT = 64
#: White space that touches other white space: its run is split by the vocabulary's own rules.
_RUNS = re.compile(r"[ \n]\s")
#: Before a blank or line feed between visible characters.
_SAFE = re.compile(r"(?<=\S)(?=[ \n]\S)")
_SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class Encoder(dict):
    """Ids (little-endian bytes) of texts, by way of remembered pieces.

    A piece is a blank or line feed and what follows up to the next one; one after a blank is kept
    without it. The vocabulary's splitting never joins characters across a blank or line feed that
    stands between visible characters, so a text's ids are those of its pieces in a row; white
    space in runs, and at an end, stays within its piece. A text that holds an added token's
    content is encoded whole; with ``plain_added`` such content counts as plain text instead of
    the token. Letters, and signs after them, are words of their own to the splitting, so they go
    to the model directly. Up to ``most`` pieces are remembered; then the half learned first, which
    holds the common ones, stays.
    """

    most = 600_000

    def __init__(self, path: str, plain_added: bool = False):
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_added
        self.added = [] if plain_added else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.blank = self.tokenizer.id_to_token(self.tokenizer.encode(" ", add_special_tokens=False).ids[0])
        self.line, self.tokenize, self.tails = self.whole("\n"), self.tokenizer.model.tokenize, {"": b""}
        # Bytes stand as printable characters in the vocabulary; others than those follow from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {c: c for c in plain} | {c: 256 + k for k, c in enumerate(c for c in range(256) if c not in plain)}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _word(self, letters: str, before: str) -> bytes:
        mapped = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.tokenize(before + mapped)]
        return _PACKERS[len(ids)](*ids) if len(ids) < len(_PACKERS) else np.array(ids, "<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        after_line = piece[:1] == "\n"
        core = piece.rstrip(_SIGNS)
        letters = core[1:] if after_line else core
        if not letters.isalpha():
            ids = self.whole(piece if after_line else " " + piece)
        else:
            tail = self.tails.get(piece[len(core) :])
            if tail is None:
                if len(self.tails) > 50_000:
                    self.tails.clear()
                tail = self.tails[piece[len(core) :]] = self.whole(piece[len(core) :])
            ids = (tail and self.get(core)) or (self.line + self._word(letters, "") if after_line else self._word(letters, self.blank))
            ids += tail
        if len(piece) <= LONGEST_KEPT:
            self[piece] = ids
        return ids

    def _pieces(self, text: str) -> list[str]:
        """The first piece as it stands, then the others."""
        if not text[-1].isspace() and not _RUNS.search(text):
            return text.replace("\n", " \n").split(" ")
        first, *rest = _SAFE.split(text)
        return [first, *(p[1:] if p[0] == " " else p for p in rest)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self) >= self.most:
            kept = dict(islice(self.items(), self.most // 2))
            self.clear()
            self.update(kept)
        get, out = self.__getitem__, []
        for t in texts:
            if not t or any(a in t for a in self.added):
                out.append(self.whole(t or ""))
            else:
                pieces = self._pieces(t)
                pieces[0], first = "", pieces[0]
                out.append(self.whole(first) + b"".join(map(get, pieces)))
        return out


_PACKERS = [struct.Struct(f"<{n}I").pack for n in range(40)]
_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder_of(path: str, plain_added: bool = False) -> Encoder:
    """The encoder of this Python worker; its pieces stay known from task to task."""
    if (path, plain_added) not in _encoders:
        _encoders[path, plain_added] = Encoder(path, plain_added)
    return _encoders[path, plain_added]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = END, plain_added: bool = True) -> None:
    """Write (doc_id, block, row, n_tokens, ids) for each row of docs; a null text counts as empty.

    An added token's content in a text is plain text unless ``plain_added`` is false, when the ids are
    those of the library's encode as it comes. Repeated ids stay as rows of their own, in the order of their texts; null ids come first.
    """
    small_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, encoder, tail = 0, encoder_of(tokenizer, plain_added), np.array([end], "<u4").tobytes()
        for batch in batches:
            rows = [ids + tail for ids in encoder.encode(batch.column(2).to_pylist())]
            sizes = np.array([len(r) // 4 for r in rows], np.int32)
            flat = pa.Array.from_buffers(pa.int32(), int(sizes.sum()), [None, pa.py_buffer(b"".join(rows))])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.arange(row, row + len(rows))), pa.array(sizes), lists], ["doc_id", "block", "row", "n_tokens", "ids"])
            row += len(rows)

    dealt = (
        docs.select(F.col("doc_id").cast("long"), F.col("text"))
        .repartitionByRange(partitions(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .select("doc_id", F.spark_partition_id().alias("block"), "text")
    )
    (
        dealt.mapInArrow(encode, SCHEMA)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.row.index.stride", INDEX_ROWS)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", BLOOM_FPP)
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, block, row, n_tokens, ids; filters on doc_id reach the files' indexes."""
    return spark.read.schema(SCHEMA).orc(path)


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of written tokens, in ascending doc_id order.

    Starts are sums over the blocks before (a row for each file, so it is small), then within a block.
    """

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            flat, at = np.ascontiguousarray(ids.values.to_numpy(), "<i4").view(np.uint8), ids.offsets.to_numpy() * 4
            sums = [zlib.crc32(flat[at[k] : at[k + 1]]) for k in range(len(ids))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(at) // 4, pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "block", "row", "n_tokens", "ids_crc32"])

    rows = tokens.select("doc_id", "block", "row", "ids").mapInArrow(crc, "doc_id long, block int, row long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = tokens.groupBy("block").agg(F.sum("n_tokens").alias("n"))
    totals = totals.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    return rows.join(F.broadcast(totals), "block").select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def encode_and_digest(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/tokens"
    write_tokens(docs, path, tokenizer_path(), plain_added=False)
    return digests(read_tokens(spark, path))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_digest(read(spark, sf_dir, "documents"))
