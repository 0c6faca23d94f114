"""Words of many texts at once, and hashes of words and word windows, as numpy arrays.

Runs inside Arrow batches of a Spark task. A batch is cut into blocks of about
`BLOCK_BYTES` so that memory does not depend on the batch; one text longer than
that is a block of its own. All positions are bytes of UTF-8, in which every byte
of a character outside ASCII is 0x80 or above, so that byte classes and character
classes agree for the word patterns used here.

A rolling hash of words serves to find candidates. What decides does so on digests: a
word's 128-bit cryptographic digest, in two halves, each of which gives an independent
hash of windows of at most some dozens of words.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 1 << 19
# Digests that a task remembers.
REMEMBERED = 100_000
# Odd multipliers of the rolling hashes; any odd 64-bit numbers do.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def byte_classes(separators: str) -> np.ndarray:
    """True for each byte value that belongs to a word. `separators`: "space" or "not_alnum"."""
    word = np.ones(256, bool)
    if separators == "space":  # [^\x20\x09-\x0D]
        word[[0x20, *range(0x09, 0x0E)]] = False
    else:  # [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing
        word[:0x80] = False
        word[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = True
    return word


def lower_ascii() -> np.ndarray:
    fold = np.arange(256, dtype=np.uint8)
    fold[0x41:0x5B] += 32
    return fold


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))


class Block:
    """The words of consecutive texts. `first[i]:first[i + 1]` are the words of text i."""

    def __init__(self, scanner: Scanner, raw: np.ndarray, offsets: np.ndarray):
        self.scanner, self.offsets = scanner, offsets
        self.raw = raw
        self.buf = buf = scanner.fold[raw] if scanner.fold is not None else raw
        inside = np.zeros(len(buf) + 2, bool)
        inside[1:-1] = scanner.word[buf]
        # A word also ends where its text ends.
        before, after = inside[:-2].copy(), inside[2:].copy()
        edges = offsets[(offsets > 0) & (offsets < len(buf))]
        before[edges] = False
        after[edges - 1] = False
        inside = inside[1:-1]
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self)), self.counts)

    def word_hashes(self) -> np.ndarray:
        """A rolling hash of each word: equal for equal words, and only likely different for others."""
        p = self.scanner.bytes
        p.reach(len(self.buf) + 1)
        total = np.zeros(len(self.buf) + 1, np.uint64)
        np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * p.up[: len(self.buf)], out=total[1:])
        h = (total[self.ends] - total[self.starts]) * p.down[self.starts]
        return mixed(h + (self.ends - self.starts).astype(np.uint64) * np.uint64(WORD_BASES[0]))

    def word_digests(self, wanted: np.ndarray | None = None) -> np.ndarray:
        """Two independent strong hashes of each word, one a column; zeros for texts that are not wanted."""
        data = np.where(self.scanner.word[self.buf], self.buf, np.uint8(0x20)).tobytes()
        digest = self.scanner.digests
        if len(digest) > REMEMBERED:
            digest.clear()
        wanted = np.ones(len(self), bool) if wanted is None else wanted
        out = np.zeros((len(self.starts), 2), np.uint64)
        for i in np.flatnonzero(wanted & (self.counts > 0)).tolist():
            words = data[self.offsets[i] : self.offsets[i + 1]].split()
            out[self.first[i] : self.first[i + 1]] = np.frombuffer(b"".join(map(digest.__getitem__, words)), "<u8").reshape(-1, 2)
        return out

    def window_hashes(self, words: np.ndarray, width: int, family: int = 0) -> np.ndarray:
        """Hash of the `width` words from each word on; of no meaning for the last width - 1 of a text.

        `words` are the hashes of all words of the block, or one column of their digests.
        """
        n = len(words)
        if n < width:
            return np.zeros(0, np.uint64)
        p = self.scanner.words[family]
        p.reach(n + 1)
        total = np.zeros(n + 1, np.uint64)
        salt = np.uint64(0x2545F4914F6CDD1D * (family + 1) & (1 << 64) - 1)
        np.cumsum(mixed(words ^ salt) * p.up[:n], out=total[1:])
        return mixed((total[width:] - total[:-width]) * p.down[: n - width + 1])

    def full_windows(self, width: int) -> np.ndarray:
        """Word numbers at which a window of `width` words lies within one text."""
        ok = np.zeros(max(0, len(self.starts) - width + 1), bool)
        if len(ok):
            lo, hi = self.first[:-1], self.first[1:] - width + 1
            edge = np.zeros(len(ok) + 1, np.int32)
            keep = hi > lo
            np.add.at(edge, lo[keep], 1)
            np.add.at(edge, hi[keep], -1)
            ok = np.cumsum(edge[:-1]) > 0
        return np.flatnonzero(ok)

    def joined(self, start: int, stop: int) -> bytes:
        """Words start to stop, joined by single spaces."""
        return b" ".join(self.buf[s:e].tobytes() for s, e in zip(self.starts[start:stop], self.ends[start:stop], strict=True))


class Digests(dict):
    """The digests of words seen so far."""

    def __missing__(self, word: bytes) -> bytes:
        found = self[word] = hashlib.blake2b(word, digest_size=16).digest()
        return found


class Scanner:
    def __init__(self, separators: str = "space", lower: bool = False):
        self.word = byte_classes(separators)
        self.fold = lower_ascii() if lower else None
        self.digests = Digests()
        self.bytes = Powers(BYTE_BASE)
        self.words = [Powers(b) for b in WORD_BASES]

    def blocks(self, texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Block]]:
        """(first row, end row, block) over a column of texts; null counts as empty."""
        for lo, hi, raw, offsets in byte_blocks(texts, limit):
            yield lo, hi, Block(self, raw, offsets)


def byte_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets in them) over a column of texts; null counts as empty."""
    n = len(texts)
    if n == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def covered(starts: np.ndarray, widths: np.ndarray | int, n: int) -> np.ndarray:
    """True for each of n places that lies in one of the stretches."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + widths, -1)
    return np.cumsum(edge[:-1]) > 0


def stretches(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    step = np.diff(np.concatenate(([0], marked.view(np.int8), [0])))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)

