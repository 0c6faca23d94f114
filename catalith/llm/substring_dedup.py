"""Removal of long passages that an earlier document already holds, found by recompression.

Tokens are renamed in rounds: short runs of one token first, then pairs whose left
name falls into one half of the names and whose right name into the other. A name is
a hash of the names it replaces, so all tasks give equal strings equal names without
talking to each other, and whether two neighbours join depends on a few words around
them only. So equal passages get equal symbols, and symbol borders, inside.

`ZONE` are the places of a window at which borders depend on nothing outside it. There
is always one; the one whose surrounding words (`CONTEXT` to each side) have the least
hash is the window's landmark. Equal windows have equal landmarks, and neighbouring
windows mostly share theirs, so one landmark in about a dozen words is shuffled.
Landmarks seen in two documents reveal candidates; only windows with such a landmark
are hashed in full, on two independent halves of their words' cryptographic digests, and
grouped to verify the repeat.

A window counts for a document if a document with a smaller id holds it anywhere.
Null and wordless texts, and texts below `WIDTH` words, lose nothing. Rows with equal
ids do not take words from each other; a null id neither takes nor loses. A text longer
than a block is handled alone, in memory proportional to it. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder
from catalith.llm import sieve, wordscan
from catalith.skew import counted_hot_keys, spread_join

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 50
LONGEST_RUN = 3
PAIR_ROUNDS = 2
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def reach(rounds: int = PAIR_ROUNDS) -> tuple[int, int]:
    """(words around a border that decide on it, longest symbol in words) after the rounds."""
    around, longest = LONGEST_RUN + 1, LONGEST_RUN
    for _ in range(rounds):
        around, longest = around + longest, 2 * longest
    return around, longest


CONTEXT, LONGEST = reach()
# Borders at CONTEXT .. WIDTH - CONTEXT of a window are the same wherever it stands.
ZONE = WIDTH - 2 * CONTEXT + 1
if ZONE < LONGEST:
    raise ValueError("a window must be sure to hold a border")


def symbol_borders(names: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Word numbers at which the symbols start, after all rounds."""
    n = len(names)
    at = np.arange(n)
    if n < 2:
        return at
    # Runs of two to LONGEST_RUN equal tokens become one symbol; longer ones stay as they are,
    # since every place in them looks the same.
    head = np.concatenate(([True], (names[1:] != names[:-1]) | (owners[1:] != owners[:-1])))
    first = np.flatnonzero(head)
    size = np.diff(np.append(first, n))
    joined = (size > 1) & (size <= LONGEST_RUN)
    keep = head | ~np.repeat(joined, size)
    names = names.copy()
    names[first[joined]] = wordscan.mixed(names[first[joined]] + size[joined].astype(np.uint64))
    names, owners, at = names[keep], owners[keep], at[keep]
    for r in range(PAIR_ROUNDS):
        right = wordscan.mixed(names + np.uint64(0x9E3779B97F4A7C15 * (r + 1) & (1 << 64) - 1)) >> np.uint64(63) == 1
        pair = ~right[:-1] & right[1:] & (owners[1:] == owners[:-1])
        left = np.flatnonzero(pair)
        names = names.copy()
        names[left] = wordscan.mixed(wordscan.mixed(names[left]) + names[left + 1])
        keep = np.ones(len(names), bool)
        keep[left + 1] = False
        names, owners, at = names[keep], owners[keep], at[keep]
    return at


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` values in a row, by doubling."""
    span = 1
    while 2 * span <= width:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    rest = width - span
    return np.minimum(v[: len(v) - rest], v[rest:]) if rest else v


def landmarks(block: wordscan.Block, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first words of all windows that lie in one text, the landmark of each)."""
    windows = block.full_windows(WIDTH)
    if not len(windows):
        return windows, np.zeros(0, np.uint64)
    around = block.window_hashes(words, 2 * CONTEXT)
    value = np.full(len(words), NONE)
    borders = symbol_borders(words, block.owners())
    # A border's context may leave its text, but never for a border in the zone of a full window.
    borders = borders[(borders >= CONTEXT) & (borders <= len(words) - CONTEXT)]
    value[borders] = around[borders - CONTEXT]
    least = _sliding_min(value, ZONE)
    return windows, least[windows + CONTEXT]


def _landmark_rows(rows: DataFrame, kind: str) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = wordscan.Scanner()
        for batch in batches:
            for lo, _, block in scanner.blocks(batch.column(2)):
                windows, marks = landmarks(block, block.word_hashes())
                if not len(windows):
                    continue
                owner = np.searchsorted(block.first, windows, side="right") - 1
                # Neighbouring windows share a landmark: one row for each stretch is enough.
                new = np.concatenate(([True], (marks[1:] != marks[:-1]) | (owner[1:] != owner[:-1])))
                ids = batch.column(0).take(pa.array(owner[new] + lo))
                yield pa.record_batch([pa.array(marks[new].view(np.int64)), ids], ["mark", "doc"])

    return rows.mapInArrow(scan, f"mark bigint, doc {kind}")


def _window_rows(rows: DataFrame, kind: str, known) -> DataFrame:
    """The windows whose landmark may be shared."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, shared = wordscan.Scanner(), sieve.Sieve(*known.value)
        for batch in batches:
            for lo, _, block in scanner.blocks(batch.column(2)):
                windows, marks = landmarks(block, block.word_hashes())
                windows = windows[shared.passes(marks)]
                if not len(windows):
                    continue
                owner = np.searchsorted(block.first, windows, side="right") - 1
                digests = block.word_digests(np.bincount(owner, minlength=len(block)) > 0)
                at = pa.array(owner + lo)
                hashes = [pa.array(block.window_hashes(digests[:, f], WIDTH, f)[windows].view(np.int64)) for f in (0, 1)]
                place = pa.array((windows - block.first[owner]).astype(np.int32))
                yield pa.record_batch(
                    [*hashes, batch.column(0).take(at), batch.column(1).take(at), place], ["h1", "h2", "doc", "text_key", "at"]
                )

    return rows.mapInArrow(scan, f"h1 bigint, h2 bigint, doc {kind}, text_key bigint, at int")


def repeated_windows(docs: DataFrame, held: list[Broadcast], doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, text_key, places): per document the first words of its windows that an earlier document holds.

    The broadcast joins `held`, to be destroyed once the result is written.
    """
    spark, kind = docs.sparkSession, docs.schema[doc].dataType.simpleString()
    rows = _keyed(docs, doc, text).where("doc is not null")
    folder = staging_folder(spark)
    shared = _landmark_rows(rows, kind).groupBy("mark").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    shared = stage(shared.where("lo < hi").select("mark"), folder, "marks")
    known = spark.sparkContext.broadcast(sieve.build(shared, "mark").parts)
    held.append(known)
    windows = _window_rows(rows, kind, known)
    repeats = (
        windows.groupBy("h1", "h2")
        .agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count(F.lit(1)).alias("n"))
        .where("lo < hi")
    )
    key = ["h1", "h2"]
    hot = counted_hot_keys(repeats, key, "n")
    # With n kept, both uses of the repeats have the same columns and share one shuffle.
    found = spread_join(windows, repeats.drop("hi"), key, spread_by=["doc", "at"], grouped=True, hot=hot)
    found = found.where("doc > lo and n > 1")
    return found.groupBy("doc", "text_key").agg(F.collect_set("at").alias("places"))


def _keyed(docs: DataFrame, doc: str, text: str) -> DataFrame:
    return docs.select(F.col(doc).alias("doc"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))


def _kept(block: wordscan.Block, i: int, places: list[int] | None) -> tuple[int, int, bytes]:
    """(words, words removed, what is left joined by spaces) of text i of the block."""
    a, b = int(block.first[i]), int(block.first[i + 1])
    if not places:
        return b - a, 0, block.joined(a, b)
    keep = ~wordscan.covered(np.array(places), WIDTH, b - a)
    spans = zip(block.starts[a:b][keep], block.ends[a:b][keep], strict=True)
    return b - a, int((~keep).sum()), b" ".join(block.buf[s:e].tobytes() for s, e in spans)


def remove_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256, and with `with_text` the kept text.

    Only documents that may lose words are shuffled with their text; which those are is
    told by a bit table of fixed size over their ids.
    """
    spark, kind = docs.sparkSession, docs.schema[doc].dataType.simpleString()
    held: list[Broadcast] = []
    found = stage(repeated_windows(docs, held, doc, text), staging_folder(spark), "places")
    for b in held:
        b.destroy()
    touched = found.select(F.xxhash64("doc", "text_key").alias("key"))
    known = spark.sparkContext.broadcast(sieve.build(touched, "key").parts)
    rows = _keyed(docs, doc, text).withColumn("key", F.xxhash64("doc", "text_key"))
    schema = f"`{doc}` {kind}, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept string" * with_text

    def result(ids: pa.Array, block: wordscan.Block, places: list) -> pa.RecordBatch:
        out = [_kept(block, i, p) for i, p in enumerate(places)]
        columns = [ids, pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                   pa.array([hashlib.sha256(x[2]).hexdigest() for x in out], pa.string())]
        if with_text:
            columns.append(pa.array([x[2].decode() for x in out], pa.string()))
        return pa.record_batch(columns, [doc, "n_words", "n_removed", "kept_sha256", *["kept"] * with_text])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, sifted = wordscan.Scanner(), sieve.Sieve(*known.value)
        for batch in batches:
            batch = batch.filter(pa.array(~sifted.passes(batch.column(3).to_numpy())))
            for lo, hi, block in scanner.blocks(batch.column(2)):
                yield result(batch.column(0).slice(lo, hi - lo), block, [None] * len(block))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sifted = sieve.Sieve(*known.value)
        for batch in batches:
            yield batch.filter(pa.array(sifted.passes(batch.column(3).to_numpy())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = wordscan.Scanner()
        for batch in batches:
            for lo, hi, block in scanner.blocks(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                yield result(part.column(0), block, part.column(2).to_pylist())

    likely = rows.mapInArrow(sift, rows.schema).join(found, ["doc", "text_key"], "left")
    return rows.mapInArrow(whole, schema).unionByName(likely.select("doc", "text", "places").mapInArrow(cut, schema))
