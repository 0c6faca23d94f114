"""WARC archives of pages, and a globally ordered index of their captures.

Writing: equal payloads (told apart by SHA-256 and length) share one response record, that
of the largest page id; the others become revisit records that name it. Each output
partition is sorted by URL key, capture time and page id and written by Spark's text
writer, one record after another, as one gzip file on whatever store Spark can reach. So
every file is a locally sorted capture run. A file takes as many records as `FILE_BYTES`
holds of the size that one page in a thousand exceeds; a task that has more begins another.

Reading: files come back as whole binary rows and are walked record by record by their
declared lengths, so a payload may hold anything, also text that looks like a record. The
payload of each response is hashed again.

Index merge: the index rows are dealt into ranges of URL key, time and page id, small enough
for a task; within a range the runs are merged by a loser tree. A single URL with very
many captures is cut by time and id.

Null payloads are empty. A null URL is written as `urn:x-capture:none`, blanks and control
characters in URLs are escaped. Equal page ids with equal payloads are each a response. A
null page id stays null; it never becomes the response of others unless all are null.
Columns besides id, URL, payload and time are not archived, whatever their names. An empty
table gives an empty index.
"""

from __future__ import annotations

import hashlib
import io
import sys
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder
from catalith.skew import counted_hot_keys, spread_join

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
NO_URL = "urn:x-capture:none"
ID_PREFIX = "urn:x-capture:page:"
# The revisit profile of the WARC 1.1 standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"
ROWS_PER_RANGE = 100_000
# Payload of one archive, so that a file fits a row when it is read back, with room for large pages beside each other.
FILE_BYTES, LARGE_SHARE, HEAD_BYTES = 64 << 20, 0.999, 1024
ENTRY = (
    "page_id string, target string, captured string, record_type string, refers_to string, payload_bytes bigint,"
    " payload_digest string, run string, offset bigint, length bigint"
)


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a 40-digit hex string, five digits (four letters) at a time."""
    letters = []
    for g in range(8):
        value = F.conv(F.substring(digest, 5 * g + 1, 5), 16, 10).cast("int")
        for j in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(BASE32), F.shiftright(value, j).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels from the right, then path and query, all in lower case."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)", 1)), r"^www\.", "")
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), "#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.lower(rest))


def _decided(pages: DataFrame, page: str, url: str, payload: str, captured: Column, min_bytes: int) -> DataFrame:
    """Pages with their digests and, for revisits, the id of the response."""
    content = F.coalesce(F.col(payload), F.lit(""))
    safe = F.regexp_replace(F.coalesce(F.col(url), F.lit(NO_URL)), r"[\x00-\x20\x7F]", "%20")
    rows = pages.select(
        F.col(page).alias("page"),
        safe.alias("target"),
        F.date_format(F.coalesce(captured, F.timestamp_seconds(F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
        content.alias("content"),
        F.octet_length(content).cast("bigint").alias("n"),
        F.unhex(F.sha2(content, 256)).alias("strong"),
    )
    key = ["strong", "n"]
    winners = rows.select("page", *key).groupBy(*key).agg(F.max("page").alias("response"), F.count(F.lit(1)).alias("copies"))
    hot = counted_hot_keys(winners, key, "copies")
    joined = spread_join(rows, winners, key, spread_by=["page", "target"], grouped=True, hot=hot)
    again = (F.col("n") >= min_bytes) & (F.col("copies") > 1) & ~F.col("response").eqNullSafe(F.col("page"))
    return joined.withColumn("refers_to", F.when(again, F.col("response"))).drop("strong", "response", "copies")


def _record() -> Column:
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n"), F.lit(RECORD_END)
    )
    revisit = F.col("refers_to").isNotNull()
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))
    own_id = F.coalesce(F.col("page").cast("string"), F.lit(""))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit(f"WARC-Record-ID: <{ID_PREFIX}"), own_id, F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("target")),
        F.concat(F.lit("WARC-Date: "), F.col("captured")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_of_hex(F.sha1(F.col("content").cast("binary")))),
        F.when(revisit, F.concat(F.lit(f"WARC-Refers-To: <{ID_PREFIX}"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(RECORD_END), http, F.when(revisit, "").otherwise(F.col("content")))


def write_archives(
    pages: DataFrame,
    folder: str,
    captured: Column,
    page: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = 0,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write one record per page into gzip WARC files below `folder`."""
    size = pages.agg(F.percentile_approx(F.octet_length(payload), LARGE_SHARE)).first()[0] or 0
    most = max(1, file_bytes // (size + HEAD_BYTES))
    rows = _decided(pages, page, url, payload, captured, min_bytes)
    sorted_runs = rows.sortWithinPartitions(url_key(F.col("target")), "captured", "page")
    lines = sorted_runs.select(_record().alias("value")).write.option("maxRecordsPerFile", most)
    lines.option("compression", "gzip").option("lineSep", RECORD_END).text(folder)


def _lines(data: io.BufferedIOBase) -> tuple[list[bytes], int]:
    """Header lines up to the empty one, and the bytes read."""
    out, size = [], 0
    while True:
        line = data.readline()
        size += len(line)
        if line in (b"\r\n", b""):
            return out, size
        out.append(line.rstrip(b"\r\n"))


def records(data: io.BufferedIOBase) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header fields, block) of each record of an uncompressed archive."""
    at = 0
    while True:
        lines, size = _lines(data)
        if not lines:
            return
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.decode("utf-8").split(": ", 1) for line in lines[1:])
        n = int(fields["Content-Length"])
        block = data.read(n)
        if len(block) != n or data.read(4) != RECORD_END.encode():
            raise ValueError(f"record at byte {at} is cut off")
        yield at, size + n + 4, fields, block
        at += size + n + 4


class _Inflated(io.RawIOBase):
    """A gzip file as a stream; only a window of it is held in memory."""

    def __init__(self, packed: bytes):
        self.packed, self.at, self.rest = packed, 0, b""
        self.z = zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self.rest:
            if self.z.eof:
                if not self.z.unused_data:
                    return 0
                self.packed, self.at, self.z = self.z.unused_data + self.packed[self.at :], 0, zlib.decompressobj(31)
            feed = self.z.unconsumed_tail
            if not feed:
                feed = self.packed[self.at : self.at + 65536]
                self.at += len(feed)
                if not feed:
                    return 0
            self.rest = self.z.decompress(feed, 1 << 20)
        n = min(len(target), len(self.rest))
        target[:n] = self.rest[:n]
        self.rest = self.rest[n:]
        return n


def _entry(run: str, at: int, size: int, fields: dict[str, str], block: bytes) -> tuple:
    bare = lambda v: v.strip("<>").removeprefix(ID_PREFIX)
    head, _, body = block.partition(b"\r\n\r\n")
    http = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    n, digest = int(http[b"Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        if len(body) != n or b32encode(hashlib.sha1(body).digest()).decode() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its record")
    refers = fields.get("WARC-Refers-To")
    return (
        bare(fields["WARC-Record-ID"]) or None, fields["WARC-Target-URI"], fields["WARC-Date"], fields["WARC-Type"],
        refers and bare(refers), n, digest, run, at, size,
    )


def read_index(spark, folder: str) -> DataFrame:
    """One index entry per record of the archives below `folder`."""
    names = [f.split()[0] for f in ENTRY.split(", ")]
    kinds = [pa.int64() if "bigint" in f else pa.string() for f in ENTRY.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for record in records(io.BufferedReader(_Inflated(content.as_py()), 1 << 16)):
                    rows.append(_entry(run, *record))
                    if len(rows) == 1000:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    run = F.element_at(F.split("path", "/"), -1)
    return files.select(run.alias("run"), "content").mapInArrow(parse, ENTRY).withColumn("urlkey", url_key(F.col("target")))


class LoserTree:
    """Merges sorted streams: each inner node keeps the loser of its match, the winner moves up."""

    def __init__(self, streams: list[Iterator], key):
        self.streams, self.key, self.k = streams, key, max(1, len(streams))
        self.heads = [next(s, None) for s in streams] or [None]
        self.loser = [0] * self.k
        winners = [0] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.loser[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None
        return (self.key(x), a) < (self.key(y), b)

    def __iter__(self) -> Iterator:
        while (row := self.heads[self.winner]) is not None:
            yield row
            w = self.winner
            self.heads[w] = next(self.streams[w], None)
            node = (w + self.k) // 2
            while node:
                if self._before(self.loser[node], w):
                    self.loser[node], w = w, self.loser[node]
                node //= 2
            self.winner = w


def merge_index(index: DataFrame, id_type: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The index in order of URL key, time and page id over all partitions, by merging the sorted runs."""
    index = index.withColumn("page_id", F.col("page_id").cast(id_type))
    place = ["urlkey", "captured", "page_id"]
    ranges = max(1, -(-index.count() // rows_per_range))
    dealt = index.repartitionByRange(ranges, *place).sortWithinPartitions("run", "offset")
    at = [dealt.columns.index(c) for c in ("run", *place)]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A range is small by design; its runs follow one another.
        table = pa.Table.from_batches(list(batches))
        if not table.num_rows:
            return
        run, *keys = (table.column(i).to_pylist() for i in at)
        starts = [0, *(i for i in range(1, len(run)) if run[i] != run[i - 1]), len(run)]
        streams = [iter(range(a, b)) for a, b in zip(starts, starts[1:], strict=False)]
        order = LoserTree(streams, lambda i: (keys[0][i], keys[1][i], keys[2][i] is not None, keys[2][i]))
        yield from table.take(pa.array(list(order))).combine_chunks().to_batches()

    return dealt.mapInArrow(merge, dealt.schema)


def archive(
    pages: DataFrame, folder: str, captured: Column, page: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0
) -> DataFrame:
    """Write the archives, read them back, and return the merged index."""
    spark, kind = pages.sparkSession, pages.schema[page].dataType.simpleString()
    write_archives(pages, folder, captured, page, url, payload, min_bytes)
    index = stage(read_index(spark, folder), staging_folder(spark), "entries")
    merged = merge_index(index, kind)
    return merged.select(
        F.col("page_id").alias(page), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "urlkey", "captured", "run", "offset", "length",
    )
