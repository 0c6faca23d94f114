"""Language identification by string kernels.

A text becomes the set of its byte n-grams of one to three bytes (blended spectrum,
presence only), hashed into `BINS` places, after ASCII letters are lower-cased and other
ASCII characters are taken as spaces. The kernel of two texts is the number of shared
n-grams over the geometric mean of their own numbers. Landmarks from the training sample
approximate it (Nystroem); kernel ridge regression is solved for each language against the
rest. Scoring multiplies batches of presence rows with one matrix, into which landmarks and
weights are folded.

The classifier is fitted on at most about `SAMPLE` labelled texts, spread evenly over the
languages and drawn by a hash of the id, so the driver gets `SAMPLE` rows of `BINS / 8`
bytes whatever the table's size. Every text is scored whole.

Texts that are null or have no letter are `und` with score 0, and so is every text if
there is nothing to learn from. Null languages are not learned, and of others the
`LANGUAGES` most frequent. Ties go to the language first in order. Repeated rows are scored
each; other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.llm import wordscan

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 4096
# Languages that are learned: the most frequent ones, so that a column full of junk stays bounded.
LANGUAGES = 256
LANDMARKS = 96
RIDGE = 1e-3
# Bins of the n-grams of one, two and three bytes.
BIN_BITS = (8, 13, 14)
BINS = sum(1 << b for b in BIN_BITS)
ROWS_AT_ONCE = 128
UNKNOWN = "und"


def _byte_map() -> np.ndarray:
    fold = np.arange(256, dtype=np.uint8)
    fold[:0x80] = 0x20
    fold[0x61:0x7B] = np.arange(0x61, 0x7B)
    fold[0x41:0x5B] = np.arange(0x61, 0x7B)
    return fold


def presence(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, matrix of 0 and 1): which n-grams each text holds."""
    fold = _byte_map()
    for lo, hi, raw, offsets in wordscan.byte_blocks(texts):
        for a in range(0, hi - lo, ROWS_AT_ONCE):
            b = min(hi - lo, a + ROWS_AT_ONCE)
            own = offsets[a : b + 1] - offsets[a]
            codes = fold[raw[offsets[a] : offsets[b]]].astype(np.uint32)
            rows = np.repeat(np.arange(b - a, dtype=np.int64) * BINS, np.diff(own))
            out = np.zeros((b - a) * BINS, np.uint8)
            gram, base = codes, 0
            for n, bits in enumerate(BIN_BITS, 1):
                if n > 1:
                    gram = (gram[:-1] << np.uint32(8)) | codes[n - 1 :]
                place = gram if n == 1 else (gram * np.uint32(2654435761)) >> np.uint32(32 - bits)
                # An n-gram that reaches into the next text belongs to neither.
                inside = np.ones(len(gram), bool)
                for k in range(1, n):
                    ends = own[1:] - k
                    inside[ends[(ends >= 0) & (ends < len(gram))]] = False
                out[(rows[: len(gram)] + base + place)[inside]] = 1
                base += 1 << bits
            yield lo + a, lo + b, out.reshape(b - a, BINS)


class Model:
    """Languages, and a matrix that turns presence rows into scores."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray):
        self.languages, self.weights, self.bias = languages, weights, bias

    def score(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the language, score from 0 to 1) of each row."""
        rows = rows.astype(np.float32)
        size = np.sqrt(np.maximum(rows.sum(axis=1), 1))
        raw = (rows @ self.weights) / size[:, None] + self.bias
        best = raw.argmax(axis=1)
        share = np.clip(raw, 0, 1)
        top = share[np.arange(len(rows)), best]
        return best, np.where(top > 0, top / np.maximum(share.sum(axis=1), 1e-9), 0.0).astype(float)


def fit(rows: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Kernel ridge regression over Nystroem features of presence rows."""
    languages = sorted(set(labels))
    if not languages:
        return None
    x = rows.astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None]
    of = np.array([languages.index(v) for v in labels])
    share = max(1, landmarks // len(languages))
    chosen = np.concatenate([np.flatnonzero(of == k)[:share] for k in range(len(languages))])
    z = x[chosen]
    values, vectors = np.linalg.eigh((z @ z.T).astype(float))
    solid = values > 1e-6 * values.max()
    root = vectors[:, solid] / np.sqrt(values[solid])
    phi = (x @ z.T) @ root
    # Every language weighs the same, however many texts it has.
    weight = 1.0 / np.bincount(of)[of]
    target = (of[:, None] == np.arange(len(languages))).astype(float)
    mean_phi, mean_t = np.average(phi, axis=0, weights=weight), np.average(target, axis=0, weights=weight)
    centred, goal = phi - mean_phi, target - mean_t
    gram = (centred * weight[:, None]).T @ centred
    solved = np.linalg.solve(gram + ridge * np.eye(len(gram)) * len(languages), (centred * weight[:, None]).T @ goal)
    folded = z.T @ (root @ solved)
    return Model(languages, folded.astype(np.float32), (mean_t - mean_phi @ solved).astype(np.float32))


def is_held_out(doc: str = "doc_id") -> Column:
    return F.crc32(F.col(doc).cast("string").cast("binary")) % 4 == 2


def _learned_from(docs: DataFrame, doc: str, text: str, lang: str, sample: int) -> DataFrame:
    """The training sample: (lang, order, text)."""
    usable = docs.where(~is_held_out(doc) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = usable.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), lang).limit(LANGUAGES).collect()
    share = max(1, sample // max(1, len(counts)))
    draw = F.pmod(F.xxhash64(F.col(doc), F.lit("language sample")), F.lit(1 << 30))
    limits = F.create_map(*[v for r in counts for v in (F.lit(r[lang]), F.lit(min(1 << 30, (share << 30) // r["n"])))]) if counts else None
    if limits is None:
        return usable.where(F.lit(False)).select(F.col(lang).alias("lang"), draw.alias("draw"), F.col(text).alias("text"))
    return usable.where(draw < F.try_element_at(limits, F.col(lang))).select(F.col(lang).alias("lang"), draw.alias("draw"), F.col(text).alias("text"))


def train(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model | None:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, rows in presence(batch.column(2)):
                bits = [r.tobytes() for r in np.packbits(rows, axis=1)]
                part = batch.slice(lo, hi - lo)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(bits, pa.binary())], ["lang", "draw", "bits"])

    drawn = _learned_from(docs, doc, text, lang, sample).mapInArrow(pack, "lang string, draw bigint, bits binary").collect()
    drawn.sort(key=lambda r: (r["lang"], r["draw"], bytes(r["bits"])))
    if not drawn:
        return None
    rows = np.unpackbits(np.frombuffer(b"".join(bytes(r["bits"]) for r in drawn), np.uint8).reshape(len(drawn), -1), axis=1)
    return fit(rows[:, :BINS], [r["lang"] for r in drawn])


def predict(docs: DataFrame, model: Model | None, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score."""
    kind = docs.schema[doc].dataType.simpleString()
    # BINS numbers for each language, and plain ones: tasks need not have this package.
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights, model.bias) if model else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        fitted, letter = Model(*shared.value) if shared.value else None, regex.compile(r"\p{L}").search
        for batch in batches:
            texts = batch.column(1)
            for lo, hi, rows in presence(texts):
                part = texts.slice(lo, hi - lo)
                lettered = [bool(t and letter(t)) for t in part.to_pylist()]
                if fitted is None:
                    names, scores = [UNKNOWN] * (hi - lo), [0.0] * (hi - lo)
                else:
                    best, score = fitted.score(rows)
                    names = [fitted.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), lettered, strict=True)]
                    scores = [s if ok else 0.0 for s, ok in zip(score.tolist(), lettered, strict=True)]
                yield pa.record_batch(
                    [batch.column(0).slice(lo, hi - lo), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    [doc, "lang_pred", "score"],
                )

    return docs.select(F.col(doc), F.col(text).alias("_text")).mapInArrow(run, f"`{doc}` {kind}, lang_pred string, score double")
