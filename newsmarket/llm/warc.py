"""WARC archives with a two-level capture index.

Pages become WARC records, one gzip member each, in one archive for each partition. The index
sorts captures by reversed-host URL key into compressed blocks; a sparse directory keeps each
block's first and last key and place. A lookup searches the directory, reads the block's range, and
then the record's range.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import json
import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, read, shared_dir, small_batches, stored

LEAST_REVISIT = 1000
BLOCK_LINES = 2000
#: Directory rows up to which lookups broadcast it; beyond, all blocks are read and joined by key.
DIRECTORY_ROWS = 500_000
DATE = "2024-01-01T00:00:00Z"

_CAPTURE = "url_key string, page_id long, file string, offset long, length long"
_DIRECTORY = "first_key string, last_key string, file string, offset long, length long, lines long"
_RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"


def url_key(url: str | None) -> str:
    """Host labels reversed, then the rest: ``com,example,www)/path``. Empty for a null url."""
    if not url:
        return ""
    rest = url.split("://", 1)[-1]
    cut = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    host, path = rest[:cut].lower(), rest[cut:].split("#", 1)[0] or "/"
    name, _, port = host.rpartition("@")[2].partition(":")
    return ",".join(reversed(name.split("."))) + (f":{port}" if port not in ("", "80", "443") else "") + ")" + path


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path by its scheme; Hadoop's names of object stores stand for their plain ones."""
    scheme, colon, rest = path.partition("://")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3", "abfss": "abfs"}.get(scheme, scheme) + colon + rest)


class _Out:
    """A file that appears under its name when it is complete; a repeated task writes it again."""

    def __init__(self, path: str):
        self.store, self.path = _opened(path)
        self.store.create_dir(os.path.dirname(self.path), recursive=True)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.stream, self.size = self.store.open_output_stream(self.part, compression=None), 0

    def add(self, data: bytes) -> tuple[int, int]:
        at = self.size
        self.stream.write(data)
        self.size += len(data)
        return at, len(data)

    def close(self) -> None:
        self.stream.close()
        self.store.move(self.part, self.path)


def _ranges(path: str):
    store, inner = _opened(path)
    return store.open_input_file(inner)


def record_bytes(page_id: int | None, url: str | None, html: str | None, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member; a revisit carries the headers of its payload, not the payload."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    name = "null" if page_id is None else page_id
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url, safe=_URL_SAFE) if url is not None else 'urn:null'}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"WARC-X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[5:5] = [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


_URL_SAFE = "".join(chr(c) for c in range(33, 127) if chr(c) not in '<>"')


def parsed(member: bytes) -> dict:
    """Fields of a record read back; the digest of a response is taken from its payload again."""
    import hashlib

    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    revisit = fields["WARC-Type"] == "revisit"
    digest = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
    if not revisit and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(fields["WARC-X-Payload-Length"])):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda x: None if x == "<urn:page:null>" else int(x[10:-1])
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": None if fields["WARC-Target-URI"] == "urn:null" else fields["WARC-Target-URI"],
        "payload_bytes": int(fields["WARC-X-Payload-Length"]),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number(fields["WARC-Refers-To"]) if revisit else None,
        "html": None if revisit else payload.decode("utf-8", "surrogatepass"),
    }


def write_archives(pages: DataFrame, path: str) -> DataFrame:
    """Write a record for each row of pages; returns the captures.

    Of the rows with equal payloads of LEAST_REVISIT bytes or more, that with the largest page_id
    is the response and the others revisit it; rows that share that page_id are all responses, as
    are rows with a null page_id. Null html is an empty payload.
    """
    spark = pages.sparkSession
    small_batches(spark)
    pages = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    meta = pages.where(F.octet_length("html") >= LEAST_REVISIT).where("page_id is not null").select("page_id", F.sha1("html").alias("digest"))
    last = meta.groupBy("digest").agg(F.max("page_id").alias("last"), F.min("page_id").alias("first")).where("first < last").select("digest", "last")
    revisits = meta.join(last, "digest").where("page_id < last").select("page_id", "digest", F.col("last").alias("refers_to")).distinct()
    sent = pages.withColumn("digest", F.sha1("html"))
    sent = sent.join(revisits, ["page_id", "digest"], "left")
    sent = sent.select("page_id", "url", "html", "digest", "refers_to").sortWithinPartitions("page_id", "url", "digest")  # so a task run again writes the same bytes
    sent = sent.withColumn("part", F.spark_partition_id())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            rows = batch.to_pylist()
            if rows and out is None:
                name = f"{path}/part-{rows[0]['part']:05d}.warc.gz"
                out = _Out(name)
                head = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:%s>\r\nWARC-Date: %s\r\nContent-Length: 0\r\n\r\n\r\n\r\n" % (str(uuid.uuid5(uuid.NAMESPACE_URL, name)).encode(), DATE.encode())
                out.add(gzip.compress(head, mtime=0))
            places = [out.add(record_bytes(r["page_id"], r["url"], r["html"], r["digest"], r["refers_to"])) for r in rows]
            yield pa.RecordBatch.from_pylist([{"url_key": url_key(r["url"]), "page_id": r["page_id"], "file": name, "offset": a, "length": n} for r, (a, n) in zip(rows, places, strict=True)], schema=pa.schema([("url_key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))
        if out is not None:
            out.close()

    return sent.mapInArrow(write, _CAPTURE)


def build_index(captures: DataFrame, path: str) -> DataFrame:
    """Sort captures by key into compressed blocks under ``path``; returns the block directory."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, lines, rows = None, [], []

        def flush() -> None:
            data = gzip.compress("\n".join(json.dumps(x) for x in lines).encode(), 6, mtime=0)
            at, n = out.add(data)
            rows.append((lines[0][0], lines[-1][0], name, at, n, len(lines)))
            lines.clear()

        for frame in frames:
            if len(frame) and out is None:
                name = f"{path}/index-{frame['part'].iloc[0]:05d}.gz"
                out = _Out(name)
            for row in frame.itertuples(index=False):
                lines.append((row.url_key, None if pd.isna(row.page_id) else int(row.page_id), row.file, int(row.offset), int(row.length)))
                if len(lines) >= BLOCK_LINES:
                    flush()
        if lines:
            flush()
        if out is not None:
            out.close()
        yield pd.DataFrame(rows, columns=["first_key", "last_key", "file", "offset", "length", "lines"])

    dealt = captures.repartitionByRange(partitions(captures.sparkSession), "url_key", "page_id").sortWithinPartitions("url_key", "page_id")
    return dealt.withColumn("part", F.spark_partition_id()).mapInPandas(pack, _DIRECTORY)


def _lines(file: str, offset: int, length: int) -> list[list]:
    with _ranges(file) as f:
        return [json.loads(x) for x in gzip.decompress(f.read_at(length, offset)).decode().split("\n")]


def all_captures(directory: DataFrame) -> DataFrame:
    """Every capture, read from the index blocks by their ranges."""

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for b in frame.itertuples(index=False):
                out = pd.DataFrame(_lines(b.file, b.offset, b.length), columns=["url_key", "page_id", "file", "offset", "length"])
                yield out.assign(page_id=out["page_id"].astype("Int64"))

    return directory.repartition(partitions(directory.sparkSession), "file", "offset").mapInPandas(unpack, _CAPTURE)


def lookup(urls: DataFrame, directory: DataFrame) -> DataFrame:
    """Captures of the urls (column url), one row for each url and capture of its key; null urls have none."""
    keys = urls.select("url").where("url is not null").distinct().withColumn("url_key", _key_of("url"))
    return keys.join(lookup_keys(keys.select("url_key"), directory), "url_key").select("url", "url_key", "page_id", "file", "offset", "length")


def _key_of(column: str) -> Column:
    return F.pandas_udf(lambda s: s.map(url_key), "string")(column)


def lookup_keys(keys: DataFrame, directory: DataFrame) -> DataFrame:
    """Captures of the keys (column url_key): binary search in the directory, then in the blocks hit, which are
    read by their ranges. Keys that are asked for in a row share the blocks read.

    A directory of more than DIRECTORY_ROWS blocks (1e9 captures) is not sent to the tasks: then all
    blocks are read and joined by key.
    """
    keys = keys.select("url_key").distinct()
    rows = directory.select("first_key", "last_key", "file", "offset", "length").limit(DIRECTORY_ROWS + 1)
    sparse = sorted(tuple(r) for r in rows.collect())
    if len(sparse) > DIRECTORY_ROWS:
        return all_captures(directory).join(keys, "url_key", "left_semi")
    held = keys.sparkSession.sparkContext.broadcast(sparse)

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks_at, lasts = held.value, [r[1] for r in held.value]
        blocks: dict[int, list[list]] = {}
        for frame in frames:
            found = []
            for key in frame["url_key"]:
                k = bisect.bisect_left(lasts, key)
                while k < len(lasts) and blocks_at[k][0] <= key:
                    if k not in blocks:
                        if len(blocks) >= 16:
                            blocks.clear()
                        blocks[k] = _lines(*blocks_at[k][2:])
                    at = bisect.bisect_left(blocks[k], key, key=lambda x: x[0])
                    while at < len(blocks[k]) and blocks[k][at][0] == key:
                        found.append(blocks[k][at])
                        at += 1
                        if len(found) >= 10_000:  # a key may have very many captures
                            yield _frame(found)
                            found = []
                    k += 1
            yield _frame(found)

    dealt = keys.repartitionByRange(partitions(keys.sparkSession), "url_key").sortWithinPartitions("url_key")
    return dealt.mapInPandas(find, _CAPTURE)


def _frame(captures: list[list]) -> pd.DataFrame:
    return pd.DataFrame(captures, columns=["url_key", "page_id", "file", "offset", "length"]).astype({"page_id": "Int64"})


def read_records(captures: DataFrame, with_html: bool = True) -> DataFrame:
    """The records behind captures, read by their ranges in the order of their places."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        now, f = None, None
        for batch in batches:
            out = []
            for file, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if file != now:
                    now, f = file, _ranges(file)
                record = parsed(f.read_at(length, offset))
                out.append(record if with_html else record | {"html": None})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("html", pa.string())]))

    dealt = captures.select("file", "offset", "length").repartitionByRange(partitions(captures.sparkSession), "file", "offset")
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(load, _RECORD)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    captures = stored(write_archives(read(spark, sf_dir, "pages"), f"{path}/warc"), f"{path}/captures")
    directory = stored(build_index(captures, f"{path}/index"), f"{path}/directory")
    keys = read(spark, sf_dir, "pages").select(_key_of("url").alias("url_key"))
    return read_records(lookup_keys(keys, directory), with_html=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
last AS (SELECT d, max(page_id) AS m FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN m IS NOT NULL AND page_id < m THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < m THEN m END AS refers_to
FROM p LEFT JOIN last ON p.d = last.d AND p.n >= 1000
"""
