"""Secret scans: fixed patterns, and sliding-window entropy over other candidate strings.

Three patterns find secrets by their form. Besides, every run of characters that keys are
made of is a candidate if it is long enough and mixes digits and letters: per character
class (hex, base64) a window slides over it, and the Shannon entropy of the window's
characters is kept up by counts as one character enters and one leaves. A candidate whose
best window reaches the class's threshold is a secret, unless the allow list knows it
(identifiers, digests in addresses, placeholders) or pattern spans cover all of it already.

All work is done by Spark expressions on the row's own text; nothing is shuffled. A text
without a candidate costs one search per pattern.

Null and empty texts have no spans. Spans are counted in code points, end exclusive, over
whole texts of any length. Repeated rows are scanned each; a null id stays null. Other
columns pass through `redact` unchanged, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.binding import compute_once, let
from catalith.llm.names import unused

# The base patterns, the group whose length counts, and its least length.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}
# What a text must hold for a pattern to be worth running; never stricter than the pattern.
HINTS = {
    "assign": BASE["assign"][0],
    "access": r"AKIA[A-Z0-9]{14}",
    "hex": r"[0-9a-f]{16}",
}
WINDOW = 20
# Runs that may be keys, and what each class of them consists of and must reach: bits per character of the best window.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
HEX_ONLY = r"^[0-9A-Fa-f]+$"
LEAST_BITS = {"entropy_hex": 3.0, "entropy_base64": 3.7}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
KINDS = (*BASE, *LEAST_BITS)
# Candidates that are no secrets: without digits or without letters, UUIDs, words joined to
# paths or names with a short number, placeholders. Repeated groups are possessive, since
# others are matched by recursion, as deep as the candidate is long.
ALLOWED = (
    r"^[^0-9]*$",
    r"^[^A-Za-z]*$",
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"^[A-Za-z]++(?:[_/+-]++[A-Za-z]++)*+[_/+-]*+[0-9]{0,4}+[_/+-]*+$",
    r"(?i)(example|sample|dummy|placeholder|changeme|your[_-]|xxxx|0000000|1234567|abcdefg)",
)
PLACEHOLDER = "[SECRET]"
# Ordered as spans are sorted.
SPAN = "struct<start:int,rank:int,end:int,kind:string>"
BLOCK = 128


def _running(values: Column, combine, zero: Column) -> Column:
    """Running total of an array under an associative `combine`, by blocks: linear, but for a small square term."""

    def block_of(v: Column, b: Column) -> Column:
        return F.slice(v, b * BLOCK + 1, F.lit(BLOCK))

    def totals(v: Column) -> Column:
        last = F.floor((F.size(v) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.aggregate(block_of(v, b), zero, combine))

    def before(t: Column) -> Column:
        return F.transform(t, lambda _, b: F.aggregate(F.slice(t, F.lit(1), b), zero, combine))

    def each(v: Column, start: Column) -> Column:
        def at(_, k: Column) -> Column:
            b = F.floor(k / BLOCK).cast("int")
            own = F.slice(v, b * BLOCK + 1, k - b * BLOCK + 1)
            return combine(F.get(start, b), F.aggregate(own, zero, combine))

        return F.transform(v, at)

    return let(values, lambda v: let(let(totals(v), before), lambda start: each(v, start)))


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _located(text: Column, pattern: str, matches: Column) -> Column:
    """array<struct<start, end, text>>: matches given in order, placed by the lengths of the gaps between them."""
    gaps = F.split(text, pattern, -1)

    def placed(g: Column, m: Column) -> Column:
        own = F.transform(m, lambda x: F.length(x))
        steps = let(own, lambda o: F.transform(o, lambda _, k: F.length(F.get(g, k)) + F.coalesce(F.get(o, k - 1), F.lit(0))))
        return let(
            _running(steps, _sum, F.lit(0)),
            lambda start: F.transform(
                m,
                lambda x, k: F.struct(
                    F.get(start, k).alias("start"), (F.get(start, k) + F.length(x)).alias("end"), x.alias("text")
                ),
            ),
        )

    return let(gaps, lambda g: let(matches, lambda m: placed(g, m)))


def _span(kind: Column, rank: Column, m: Column) -> Column:
    return F.struct(m["start"].alias("start"), rank.alias("rank"), m["end"].alias("end"), kind.alias("kind"))


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def _base_spans(text: Column, kind: str) -> Column:
    """Spans of one base pattern: all its matches in turn, then without those too short."""
    pattern, group, least = BASE[kind]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def long_enough(found: Column, parts: Column) -> Column:
        spans = F.transform(
            found,
            lambda m, k: F.when(
                F.length(F.get(parts, k)) >= least, _span(F.lit(kind), F.lit(KINDS.index(kind)), m)
            ),
        )
        return F.array_compact(spans)

    spans = let(measured, lambda parts: let(_located(text, pattern, matches), lambda found: long_enough(found, parts)))
    return F.when(text.rlike(HINTS[kind]), spans).otherwise(_none())


def best_window_bits(candidate: Column) -> Column:
    """Entropy in bits per character of the best window of WINDOW characters.

    The window's entropy is log2(W) - sum(c * log2 c) / W over its character counts c. The
    sum is kept up: one count grows with the character that enters, one shrinks with the
    one that leaves.
    """
    places = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    weight = F.array(*[F.lit(float(c * math.log2(c)) if c else 0.0) for c in range(WINDOW + 2)])
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best")
    )

    def slide(p: Column, w: Column) -> Column:
        def step(state: Column, k: Column) -> Column:
            enters, leaves = F.get(p, k), F.when(k >= WINDOW, F.get(p, k - WINDOW)).otherwise(-1)

            def moved(e: Column, out: Column) -> Column:
                grown = F.get(state["counts"], e)
                shrunk = F.coalesce(F.get(state["counts"], out), F.lit(0)) + F.when(e == out, 1).otherwise(0)
                added = state["sum"] + F.get(w, grown + 1) - F.get(w, grown)
                total = F.when(out >= 0, added + F.get(w, shrunk - 1) - F.get(w, shrunk)).otherwise(added)
                bits = F.when(k >= WINDOW - 1, math.log2(WINDOW) - total / WINDOW).otherwise(0.0)
                counts = F.transform(
                    state["counts"],
                    lambda c, j: c + F.when(j == e, 1).otherwise(0) - F.when(j == out, 1).otherwise(0),
                )
                return F.struct(counts.alias("counts"), total.alias("sum"), F.greatest(state["best"], bits).alias("best"))

            return let(enters, lambda e: let(leaves, lambda out: moved(e, out)))

        return F.aggregate(F.sequence(F.lit(0), F.size(p) - 1), start, step, lambda s: s["best"])

    return let(places, lambda p: let(weight, lambda w: slide(p, w)))


def _allowed(candidate: Column) -> Column:
    return reduce(Column.__or__, [candidate.rlike(a) for a in ALLOWED])


def _entropy_spans(text: Column, base: Column) -> Column:
    """Candidates of high entropy that are neither on the allow list nor covered by the (sorted) base spans."""
    matches = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))

    def judged(m: Column) -> Column:
        is_hex = m["text"].rlike(HEX_ONLY)
        bits = best_window_bits(F.when(is_hex, F.lower(m["text"])).otherwise(m["text"]))
        # Base spans come by their starts: how far the candidate is covered without a gap.
        covered = F.aggregate(
            base, m["start"], lambda upto, b: F.when(b["start"] <= upto, F.greatest(upto, b["end"])).otherwise(upto)
        )
        free = covered < m["end"]
        spans = [_span(F.lit(k), F.lit(KINDS.index(k)), m) for k in LEAST_BITS]
        hex_bits, base64_bits = LEAST_BITS.values()
        found = let(
            bits,
            lambda b: F.when(is_hex & (b >= hex_bits), spans[0]).when(~is_hex & (b >= base64_bits), spans[1]),
        )
        return F.when(~_allowed(m["text"]) & free, found)

    spans = let(_located(text, CANDIDATE, matches), lambda found: F.array_compact(F.transform(found, judged)))
    return F.when(text.rlike(CANDIDATE), spans).otherwise(_none())


def with_spans(docs: DataFrame, text: str, into: str) -> DataFrame:
    """Adds `into`: the sorted spans of each text."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = F.sort_array(F.concat(*[_base_spans(content, k) for k in BASE]))
    docs = compute_once(docs, {into: base})
    return compute_once(docs, {into: F.sort_array(F.concat(F.col(into), _entropy_spans(content, F.col(into))))})


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, counts and digest of the base spans, and all spans."""
    found = with_spans(docs.select(F.col(doc), F.col(text).alias("_text")), "_text", "_spans")
    of_kind = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("bigint")
    base = F.filter("_spans", lambda s: s["rank"] < len(BASE))
    return found.select(
        doc,
        *[of_kind(k).alias(f"n_{k}") for k in BASE],
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """The documents with each span, or run of overlapping spans, replaced by PLACEHOLDER.

    `length` names a column with the text's code points, set anew where a text changed.
    """
    (name,) = unused(docs, "_secret_spans")
    found = with_spans(docs, text, name)
    content = F.col(f"`{text}`")

    def cut(spans: Column) -> Column:
        ends = _running(F.transform(spans, lambda s: s["end"]), _larger, F.lit(0))

        def pieces(upto: Column) -> Column:
            def piece(s: Column, k: Column) -> Column:
                seen = F.coalesce(F.get(upto, k - 1), F.lit(0))
                gap = F.substring(content, seen + 1, s["start"] - seen)
                return F.when((k > 0) & (s["start"] < seen), F.lit("")).otherwise(F.concat(gap, F.lit(PLACEHOLDER)))

            tail = F.substring(content, F.element_at(upto, -1) + 1, F.length(content))
            return F.concat(F.array_join(F.transform(spans, piece), ""), tail)

        return let(ends, pieces)

    changed = F.when(F.size(name) > 0, cut(F.col(name))).otherwise(content)
    columns = {text: changed}
    result = compute_once(found, columns)
    if length:
        new = F.when(F.size(name) > 0, F.length(content).cast(docs.schema[length].dataType)).otherwise(F.col(f"`{length}`"))
        result = result.withColumn(length, new)
    return result.select(*[f"`{c}`" for c in docs.columns])
