"""Importance resampling towards a target distribution, over hashed n-grams.

A text is lower-cased (A-Z) and its separators are collapsed to single spaces. A scan
with overlapping matches then gives, at each word (a look-behind holds it to word
starts), the spans of the runs of one to `MAX_GRAM` words from there on. A run's bucket
is its checksum modulo `BUCKETS`; the checksum of a longer run goes on from that of the
shorter one. Buckets are counted over all documents and over the whole target, and the
log ratio of the two smoothed distributions is a bucket's gain, a whole number. A
document's weight is the sum of its gains, and Gumbel noise drawn from seed and id turns
the highest scores into a sample without replacement.

Texts are scanned once: buckets are staged (two bytes a feature), and counting and
weighing read them from there. Only `BUCKETS` numbers are broadcast. The draw grows with
the table, so ranks come from a sorted table and one offset for each of its partitions.

Null, empty and wordless texts have no features, weight 0, and are not drawn unless
`min_words` is 0. Texts of any length count whole. Ties in score go to the smaller id,
null ids last; repeated ids keep a row each and share the noise; a null id draws by the
seed alone. Empty tables give no rows; without a target every bucket counts as empty
there. Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_GRAM = 3
BUCKETS = 10_000
MIN_WORDS = 20
SHARE = (5, 100)  # of the documents that are long enough
SEED = 42
# Bytes of UTF-8 with A to Z in lower case, and a space for each byte 00-2F, 3A-60 and 7B-7F that is left then: what
# separates words. No byte of another character is among them.
FOLDED = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)
# Buckets that are put out at once.
BLOCK = 1 << 20


class Scan:
    """The patterns of a task."""

    def __init__(self, max_gram: int = MAX_GRAM, buckets: int = BUCKETS):
        import regex

        self.buckets = buckets
        more = ""
        for _ in range(max_gram - 1):
            more = f"(?:( [^ ]++){more})?+"
        # Group k holds what the run of k words has more than that of k - 1; so the spans of all runs start at group 1.
        self.runs = regex.compile(rf"(?<![^ ])([^ ]++){more}(?![^ ])".encode()).finditer

    def checksums(self, raw: bytes) -> list[int]:
        """The checksum of each run, word by word, shorter runs first."""
        # Lower-cased, every separator a space, and one space between words.
        text = b" ".join(raw.translate(FOLDED).split())
        out = []
        for match in self.runs(text, overlapped=True):
            crc = 0
            for piece in match.groups():
                if piece is None:
                    break
                crc = crc32(piece, crc)
                out.append(crc)
        return out

    def features(self, raw: bytes) -> np.ndarray:
        return (np.array(self.checksums(raw), np.uint32) % np.uint32(self.buckets)).astype("<u2")


def _words(features: int, max_gram: int) -> int:
    """The words of a text with so many runs."""
    short = max_gram * (max_gram + 1) // 2  # runs of a text of max_gram words
    if features >= short:
        return max_gram + (features - short) // max_gram
    return next(w for w in range(max_gram + 1) if sum(max(0, w - k) for k in range(max_gram)) >= features)


def features(rows: DataFrame, key: str, text: str = "text", max_gram: int = MAX_GRAM, buckets: int = BUCKETS) -> DataFrame:
    """(key, n_words, grams): grams are the buckets of all runs of a text, two bytes each."""
    if buckets > 1 << 16:
        raise ValueError("a bucket has two bytes")
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scan(max_gram, buckets)
        for batch in batches:
            lo, size, found = 0, 0, []
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_buffer()
                found.append(scan.features(raw.to_pybytes() if raw else b""))
                size += len(found[-1])
                if size > BLOCK or i == batch.num_rows - 1:
                    words = pa.array([_words(len(f), max_gram) for f in found], pa.int64())
                    grams = pa.array([f.tobytes() for f in found], pa.binary())
                    yield pa.record_batch([batch.column(0).slice(lo, i + 1 - lo), words, grams], ["key", "n_words", "grams"])
                    lo, size, found = i + 1, 0, []

    texts = rows.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return texts.mapInArrow(run, f"key {kind}, n_words bigint, grams binary")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u2"), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    for r in found.select("grams").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to raw frequency of each bucket, smoothed by one, rounded down."""
    n, s_all, t_all = len(raw), float(raw.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
            for s, t in zip(raw.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def gumbel(h: int) -> int:
    """Thousandths of a Gumbel draw from a number below 2**32, rounded down."""
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weights(found: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(key, n_words, n_features, weight, score) from staged features."""
    kind = found.schema["key"].dataType.simpleString()
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = found.select("key", "n_words", F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint").alias("h"), "grams")
    shared = found.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            grams = [np.frombuffer(g.as_buffer(), "<u2") for g in batch.column(3)]
            weight = [int(own[g].sum()) for g in grams]
            score = [w + gumbel(h) for w, h in zip(weight, batch.column(2).to_pylist(), strict=True)]
            numbers = [pa.array(c, pa.int64()) for c in ([len(g) for g in grams], weight, score)]
            yield pa.record_batch([batch.column(0), batch.column(1), *numbers], ["key", "n_words", "n_features", "weight", "score"])

    return rows.mapInArrow(run, f"key {kind}, n_words bigint, n_features bigint, weight bigint, score bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    min_words: int = MIN_WORDS,
    share: tuple[int, int] = SHARE,
    seed: int = SEED,
    max_gram: int = MAX_GRAM,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per document: id, n_features, weight, score, rank (1 for the first drawn; null if not drawn)."""
    spark = docs.sparkSession
    folder = staging_folder(spark)
    found = stage(features(docs, doc, text, max_gram, buckets), folder, "features")
    wanted = target.select(F.lit(0).alias("one"), F.col(target_text).alias("text"))
    gain = gains(bucket_counts(found, buckets), bucket_counts(features(wanted, "one", "text", max_gram, buckets), buckets))
    scored = stage(weights(found, gain, seed), folder, "scores")

    long_enough = F.col("n_words") >= min_words
    ordered = scored.where(long_enough).orderBy(F.desc("score"), F.asc_nulls_last("key"))
    # Written once, so that a repeated task cannot number the rows differently.
    ordered = stage(ordered.withColumn("at", F.monotonically_increasing_id()), folder, "ordered")
    part = F.shiftright("at", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # one a partition
    starts, total = [], 0
    for r in sizes:
        starts.append((r["part"], total))
        total += r["n"]
    offsets = spark.createDataFrame(starts, "part bigint, start bigint")
    place = F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    drawn = total * share[0] // share[1]
    ranked = ordered.withColumn("part", part).join(F.broadcast(offsets), "part")
    ranked = ranked.withColumn("rank", F.when(place <= drawn, place))
    columns = [F.col("key").alias(doc), "n_features", "weight", "score", "rank"]
    others = scored.where(~long_enough).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.select(*columns).unionByName(others.select(*columns))


def drawn(docs: DataFrame, ranked: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The documents whose id was drawn; of a repeated id, all its rows."""
    return docs.join(ranked.where("rank is not null").select(doc).distinct(), doc, "left_semi")
