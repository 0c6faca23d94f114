"""Fill-in-the-middle transformation of whole texts, by matches that keep every repetition.

A text is matched once as `(unit)*` with a library that remembers each repetition of a
group. `match.ends(1)` then is the list of all unit ends: its length is the number of
units, and the ends after `a` and `b` units are the two cuts. Nothing steps through the
units. Units are code points by default; any pattern will do (words with their spaces,
grapheme clusters).

Where to cut and which form to write are drawn from a digest of seed and id, so a row's
result depends on nothing but the row, and a lost task draws the same again.

* `plain`: the text as it is: empty and null texts, texts that hold a sentinel, texts that
  are no sequence of units, and all rows the draw leaves out.
* `psm`: <P>prefix<S>suffix<M>middle; `spm`: <S>suffix<P>prefix<M>middle.

Texts of up to `ONE_MATCH` code points are one match; of longer ones each match takes the
next `ONE_MATCH` units, so that the memory for ends is bounded. Prefix, middle and suffix
may be empty. A null id draws by the seed alone; repeated rows get equal results. An empty
table gives no rows. Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The marks of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CODE_POINT = r"."
SEED = 1
TRANSFORMED, SPM = 90, 20  # in percent: texts that are not plain, and of these those written suffix first
ONE_MATCH = 1 << 18
# Bytes of text that are written at once.
BLOCK_BYTES = 1 << 22


def draws(doc: str, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 from seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc}`").cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


class Cutter:
    """The unit pattern, compiled in the task."""

    def __init__(self, unit: str, one_match: int = ONE_MATCH):
        import regex

        self.one_match = one_match
        self.whole = regex.compile(f"({unit})*+", regex.DOTALL).fullmatch
        self.stretch = regex.compile(f"({unit}){{1,{one_match}}}+", regex.DOTALL).match

    def cuts(self, text: str, h1: int, h2: int) -> tuple[int, int, int] | None:
        """(units, end of the prefix, end of the middle), or None if the text is no sequence of units."""
        if len(text) <= self.one_match:
            found = self.whole(text)
            if found is None:
                return None
            ends = found.ends(1)
            n = len(ends)
            a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
            return n, ends[a - 1] if a else 0, ends[b - 1] if b else 0
        starts, n, at = [], 0, 0  # (units before, first code point) of each match
        while at < len(text):
            found = self.stretch(text, at)
            if found is None or found.end() == at:
                return None
            starts.append((n, at))
            n, at = n + len(found.ends(1)), found.end()
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        return n, self._end(text, starts, a), self._end(text, starts, b)

    def _end(self, text: str, starts: list[tuple[int, int]], units: int) -> int:
        """The end of the first `units` units: the match that holds it, once more."""
        before, at = next((s for s in reversed(starts) if s[0] < units), (0, 0))
        return self.stretch(text, at).ends(1)[units - before - 1] if units else 0


def transform(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    unit: str = CODE_POINT,
    seed: int = SEED,
    transformed: int = TRANSFORMED,
    spm: int = SPM,
    one_match: int = ONE_MATCH,
) -> DataFrame:
    """One row per document: id, n (units), form, prefix_chars, middle_chars (code points; null if plain), output."""
    kind = docs.schema[doc].dataType.simpleString()

    def written(cutter: Cutter, text: str, h: list[int]) -> tuple:
        cuts = cutter.cuts(text, h[0], h[1])
        n = cuts[0] if cuts else 0
        if not n or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= transformed:
            return n, "plain", None, None, text
        a, b = cuts[1:]
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h[3] % 100 < spm:
            return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(unit, one_match)
        for batch in batches:
            drawn = list(zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True))
            lo, size, rows = 0, 0, []
            for i in range(batch.num_rows):
                rows.append(written(cutter, batch.column(1)[i].as_py() or "", drawn[i]))
                size += len(rows[-1][4])
                if size > BLOCK_BYTES or i == batch.num_rows - 1:
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.record_batch([batch.column(0).slice(lo, i + 1 - lo), *columns], [doc, *names])
                    lo, size, rows = i + 1, 0, []

    rows = docs.select(F.col(doc), F.col(text).alias("_text"), *[h.alias(f"_h{k}") for k, h in enumerate(draws(doc, seed))])
    schema = f"`{doc}` {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed, from its output and form.

    No part holds a sentinel, and none can arise where a part meets one, so the first
    place of the second sentinel ends the first part.
    """

    def parts(second: str) -> tuple[Column, Column, Column]:
        first = F.substring_index(F.substr(output, F.lit(len(PREFIX) + 1)), second, 1)
        rest = F.substr(output, F.length(first) + len(PREFIX) + len(second) + 1)
        other = F.substring_index(rest, MIDDLE, 1)
        return first, other, F.substr(rest, F.length(other) + len(MIDDLE) + 1)

    prefix, suffix, middle = parts(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(made: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The transformed rows with digests of the output, and of the text restored from it."""
    return made.select(
        doc, "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
