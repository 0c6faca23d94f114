"""Benchmark decontamination: find and cut passages of a benchmark in documents.

The windows of the benchmark (`width` consecutive normalised words; an item of
fewer words is one window) become a hash set that every task holds. Documents are
scanned window by window; a hash hit is confirmed on the words themselves.

Size of the broadcast: at most `max_windows` windows (or about that) go out at once. A
larger benchmark is cut by hash into as many parts as needed; one scan of the documents
after another finds a part's hits and writes them to a table, and the last scan joins
them to its own. All scans read the uncut text, so the result does not depend on the
number of parts, and neither driver nor task holds more than one part. `docs` is read
once per part, and once more for the last if there are several: its texts must not
change in between.

Null or wordless texts have no words and no hits. Repeated documents and repeated
items are each judged alone. Items without words have no window. The passages of
an item with a null id are found and cut like all others; only `items` has no name
for it. Columns other than the id and the text are neither read nor changed by the
search, whatever their names. An empty table gives no rows; an empty benchmark no hits.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder
from catalith.llm import sieve, wordscan
from catalith.llm.names import unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 10
MAX_WINDOWS = 500_000
# Entries of the table that a hash is first looked up in.
SCREEN_BITS = 20
# What earlier passes found in a row's text; `_hits` beside other columns.
EARLIER = {"starts": "array<int>", "ends": "array<int>", "items": "array<string>"}
HITS = "struct<" + ",".join(f"{c}:{t}" for c, t in EARLIER.items()) + ">"


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(item string, n_words, hash, words): the distinct windows of each item; a null id stays null."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = wordscan.Scanner("not_alnum", lower=True)
        for batch in batches:
            for lo, _, block in scanner.blocks(batch.column(1)):
                words, rows = block.word_hashes(), []
                for i, n in enumerate(block.counts):
                    w = min(width, int(n))
                    a = int(block.first[i])
                    hashes = block.window_hashes(words[a : a + n], w) if w else []
                    seen = {(int(h), block.joined(a + k, a + k + w)) for k, h in enumerate(hashes)}
                    name = batch.column(0)[lo + i].as_py()
                    rows += [(name, w, np.uint64(h).astype(np.int64).item(), t) for h, t in sorted(seen)]
                cols = list(zip(*rows, strict=True)) or [[], [], [], []]
                yield pa.record_batch(
                    [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                     pa.array(cols[3], pa.binary())],
                    ["item", "n_words", "hash", "words"],
                )

    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(scan, "item string, n_words int, hash bigint, words binary")


def window_table(rows: list[tuple[str | None, int, int, bytes]]) -> tuple[dict, dict]:
    """Windows by length, as plain data for a broadcast: the words and items behind each hash, and a screening table."""
    found: dict[int, dict[int, dict[bytes, list[str | None]]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(list)))
    for item, n, h, words in rows:
        found[n][h % (1 << 64)][bytes(words)].append(item)
    by_width = {n: {h: dict(w) for h, w in hs.items()} for n, hs in found.items()}
    screens = {}
    for n, hs in by_width.items():
        screen = screens[n] = np.zeros(1 << SCREEN_BITS, bool)
        screen[np.array(list(hs), np.uint64) >> np.uint64(64 - SCREEN_BITS)] = True
    return by_width, screens


class WindowSet:
    """What a task looks windows up in."""

    def __init__(self, by_width: dict, screens: dict):
        self.by_width, self.screens = by_width, screens

    def hits(self, block: wordscan.Block) -> Iterator[tuple[int, int, list[str | None]]]:
        """(first word, number of words, items) of each window of the set in the block."""
        words = block.word_hashes()
        for n, known in self.by_width.items():
            hashes = block.window_hashes(words, n)
            likely = np.flatnonzero(self.screens[n][hashes >> np.uint64(64 - SCREEN_BITS)])
            if not len(likely):
                continue
            inside = np.zeros(len(hashes), bool)
            inside[block.full_windows(n)] = True
            for k in likely[inside[likely]].tolist():
                if same := known.get(int(hashes[k])):
                    items = same.get(block.joined(k, k + n))
                    if items:
                        yield k, n, items


def _found(docs: DataFrame, text: str, shared: Broadcast) -> DataFrame:
    """(key, starts, ends, items) of the texts with a hit in one part; the key is the text's digest."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, known = wordscan.Scanner("not_alnum", lower=True), WindowSet(*shared.value)
        for batch in batches:
            for lo, _, block in scanner.blocks(batch.column(1)):
                runs, items = document_hits(block, known)
                hit = [i for i, (s, _) in enumerate(runs) if s]
                yield pa.record_batch(
                    [batch.column(0).take(pa.array([lo + i for i in hit], pa.int64())),
                     pa.array([runs[i][0] for i in hit], pa.list_(pa.int32())),
                     pa.array([runs[i][1] for i in hit], pa.list_(pa.int32())),
                     pa.array([items[i] for i in hit], pa.list_(pa.string()))],
                    ["key", *EARLIER],
                )

    rows = docs.select(F.md5(F.col(text)).alias("key"), F.col(text).alias("text")).where("text is not null")
    return rows.mapInArrow(scan, ", ".join(["key string", *(f"{c} {t}" for c, t in EARLIER.items())]))


def _with_found(docs: DataFrame, text: str, found: DataFrame) -> DataFrame:
    """The documents, and last what earlier parts found; only texts that a bit table suspects are shuffled to meet `found`."""
    known = docs.sparkSession.sparkContext.broadcast(sieve.build(found.select(F.xxhash64("key").alias("k")), "k").parts)
    key, mark, hits = unused(docs, "_hit_key", "_hit_mark", "_hits")
    keyed = docs.withColumn(key, F.md5(F.col(f"`{text}`"))).withColumn(mark, F.xxhash64(key))
    named = found.select(F.col("key").alias(key), F.struct(*EARLIER).alias(hits))

    def part(suspected: bool) -> DataFrame:
        def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sifted = sieve.Sieve(*known.value)
            for batch in batches:
                yield batch.filter(pa.array(sifted.passes(batch.column(batch.num_columns - 1).to_numpy()) == suspected))

        return keyed.mapInArrow(sift, keyed.schema)

    columns = [*[f"`{c}`" for c in docs.columns], hits]
    untouched = part(False).withColumn(hits, F.lit(None).cast(HITS))
    return untouched.select(*columns).union(part(True).join(named, key, "left").select(*columns))


def _with_nothing(docs: DataFrame) -> DataFrame:
    return docs.withColumn(unused(docs, "_hits")[0], F.lit(None).cast(HITS))


def _searched(
    docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, width: int, max_windows: int
) -> tuple[DataFrame, Broadcast]:
    """The documents, last what all parts but the last found, and the last part.

    One part at a time is on the driver and in the tasks: what it finds is a table before
    the next one goes out.
    """
    spark = docs.sparkSession
    folder = staging_folder(spark)
    windows = stage(benchmark_windows(benchmark, item, item_text, width), folder, "windows")
    parts = max(1, -(-windows.count() // max_windows))
    # Items that share a window are dealt out too, so that a part has max_windows rows or about that.
    dealt = windows.withColumn("part", F.pmod(F.xxhash64("hash", "item"), F.lit(parts)))
    found, shared = None, None
    for p in range(parts):
        if shared:
            found = stage(_found(docs, text, shared).withColumn("part", F.lit(p)), folder, "found", append=True)
            shared.destroy()
            shared = None
        rows = dealt.where(F.col("part") == p).drop("part").collect()
        shared = spark.sparkContext.broadcast(window_table([tuple(r) for r in rows]))
    if found is None:
        return _with_nothing(docs), shared
    # Equal texts have equal hits: one row of each part.
    texts = found.dropDuplicates(["key", "part"]).groupBy("key").agg(F.collect_list(F.struct(*EARLIER)).alias("hits"))
    texts = texts.select("key", *[F.flatten(f"hits.{c}").alias(c) for c in EARLIER])
    return _with_found(docs, text, stage(texts, folder, "hits")), shared


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """One row per document: its id, n_words, hit runs `starts`/`ends` (word numbers), sorted `items`."""
    kind = docs.schema[doc].dataType.simpleString()
    found = f"`{doc}` {kind}, n_words bigint, starts array<int>, ends array<int>, items array<string>"
    texts = docs.select(F.col(doc), F.col(text).alias("_text"))
    rows, shared = _searched(texts, benchmark, "_text", item, item_text, width, max_windows)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, known = wordscan.Scanner("not_alnum", lower=True), WindowSet(*shared.value)
        for batch in batches:
            for lo, hi, block in scanner.blocks(batch.column(1)):
                runs, items = document_hits(block, known)
                part_of = batch.slice(lo, hi - lo)
                _add_earlier(runs, items, part_of.column(2))
                yield pa.record_batch(
                    [part_of.column(0), pa.array(block.counts, pa.int64()),
                     pa.array([s for s, _ in runs], pa.list_(pa.int32())),
                     pa.array([e for _, e in runs], pa.list_(pa.int32())),
                     pa.array(items, pa.list_(pa.string()))],
                    [doc, "n_words", "starts", "ends", "items"],
                )

    return rows.mapInArrow(scan, found)


def _add_earlier(runs: list, items: list[list[str]], hits: pa.Array) -> None:
    """Join the runs and items that earlier passes found for the same rows."""
    if hits.null_count == len(hits):
        return
    for i, h in enumerate(hits.to_pylist()):
        if h:
            s, e = np.array(h["starts"] + runs[i][0]), np.array(h["ends"] + runs[i][1])
            a, b = wordscan.stretches(wordscan.covered(s, e - s, int(e.max())))
            runs[i], items[i] = (a.tolist(), b.tolist()), sorted({*h["items"], *items[i]})


def document_hits(block: wordscan.Block, known: WindowSet) -> tuple[list[tuple[list[int], list[int]]], list[list[str]]]:
    """Per text of the block: hit runs as word numbers within the text, and items, sorted as strings."""
    runs = [([], []) for _ in range(len(block))]
    items: list[list[str]] = [[] for _ in range(len(block))]
    hits = list(known.hits(block))
    if hits:
        at, widths = np.array([h[0] for h in hits]), np.array([h[1] for h in hits])
        marked = wordscan.covered(at, widths, len(block.starts))
        owner = np.searchsorted(block.first, at, side="right") - 1
        found = defaultdict(set)
        for d, (_, _, names) in zip(owner.tolist(), hits, strict=True):
            found[d].update(n for n in names if n is not None)
        for d, names in found.items():
            a, b = block.first[d], block.first[d + 1]
            s, e = wordscan.stretches(marked[a:b])
            runs[d], items[d] = (s.tolist(), e.tolist()), sorted(names)
    return runs, items


def digest(hits: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The hits as numbers: words, hit words, items, and a digest of the items."""
    n_hit = F.aggregate(
        F.zip_with("starts", "ends", lambda s, e: (e - s).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x
    )
    return hits.select(
        doc,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("starts") > 0).alias("contaminated"),
    )


def cut_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    length: str | None = None,
    item: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """The documents with every hit span cut out of the text.

    Cut is everything from the first byte of a run of hit words to the last; the
    rest of the text stays as it is, and so do texts without a hit. A document of
    which no word is left is removed. `length` names a column that holds the
    text's length in code points; it is set anew where a text changed.
    """
    at, n = docs.columns.index(text), len(docs.columns)
    size_at = docs.columns.index(length) if length else None
    # Every part looks at the whole text: runs are gathered first, and only the last scan cuts.
    rows, last = _searched(docs, benchmark, text, item, item_text, width, max_windows)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, known = wordscan.Scanner("not_alnum", lower=True), WindowSet(*last.value)
        for batch in batches:
            changed: dict[int, str | None] = {}
            for lo, hi, block in scanner.blocks(batch.column(at)):
                runs, items = document_hits(block, known)
                _add_earlier(runs, items, batch.column(n).slice(lo, hi - lo))
                for i, (s, e) in enumerate(runs):
                    if s:
                        changed[lo + i] = _without(block, i, s, e)
            batch = batch.select(list(range(n)))
            yield _replaced(batch, at, size_at, changed) if changed else batch

    return rows.mapInArrow(scan, docs.schema)


def _without(block: wordscan.Block, i: int, starts: list[int], ends: list[int]) -> str | None:
    first, a, b = int(block.first[i]), int(block.offsets[i]), int(block.offsets[i + 1])
    if sum(e - s for s, e in zip(starts, ends, strict=True)) == block.first[i + 1] - first:
        return None
    parts = []
    for s, e in zip(starts, ends, strict=True):
        parts.append(block.raw[a : block.starts[first + s]].tobytes())
        a = int(block.ends[first + e - 1])
    return b"".join([*parts, block.raw[a:b].tobytes()]).decode()


def _replaced(batch: pa.RecordBatch, at: int, size_at: int | None, changed: dict[int, str | None]) -> pa.RecordBatch:
    columns = list(batch.columns)
    texts = columns[at].to_pylist()
    for k, t in changed.items():
        texts[k] = t
    columns[at] = pa.array(texts, columns[at].type)
    if size_at is not None:
        sizes = columns[size_at].to_pylist()
        for k, t in changed.items():
            sizes[k] = None if t is None else len(t)
        columns[size_at] = pa.array(sizes, columns[size_at].type)
    keep = np.ones(batch.num_rows, bool)
    keep[[k for k, t in changed.items() if t is None]] = False
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(keep))
