"""Dotted label paths: building, cutting and matching ids such as `db.schema.table.column`."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.functions.binding import let

# The label alphabet, its length limit and the reserved words.
LABEL_PATTERN = r"\A[a-z0-9_-]+\z"
LABEL_ILLEGAL = r"[^a-z0-9_-]"
LABEL_MAX_LENGTH = 255
RESERVED_CONCEPT = "concept"
RESERVED_MAPPINGS = "mappings"
SHARD_FOLDERS = ("tables", "columns", "table_relationships", "concepts")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def labels(path: str | Column) -> Column:
    return F.split(_c(path), r"\.")


def level_count(path: str | Column) -> Column:
    return F.size(labels(path))


def compose_id(*parts: str | Column) -> Column:
    """Join parts with dots; NULL unless every part is there and non-empty."""
    cols = [_c(p) for p in parts]
    whole = F.lit(True)
    for c in cols:
        whole = whole & c.isNotNull() & (c != "")
    return F.when(whole, F.concat_ws(".", *cols))


def leading(path: str | Column, n: int) -> Column:
    """The first `n` labels (the whole path if it has fewer)."""
    return F.substring_index(_c(path), ".", n)


def leaf(path: str | Column) -> Column:
    return F.substring_index(_c(path), ".", -1)


def parent(path: str | Column) -> Column:
    """All labels but the last; NULL for a one-label path."""
    p = labels(path)
    return F.when(F.size(p) > 1, F.array_join(F.slice(p, F.lit(1), F.size(p) - 1), "."))


def subpath(path: str | Column, offset: int, length: int | None = None) -> Column:
    """`length` labels from `offset` (0-based; negative counts from the end).

    A negative length leaves that many labels off the end; no length takes the
    rest.
    """
    p = labels(path)
    n = F.size(p)
    start = F.lit(offset) if offset >= 0 else F.greatest(n + offset, F.lit(0))
    rest = n - start
    take = rest if length is None else (F.lit(length) if length >= 0 else rest + length)
    take = F.greatest(F.least(take, rest), F.lit(0))
    return F.array_join(F.slice(p, start + 1, take), ".")


def ancestors(path: str | Column) -> Column:
    """Array of every prefix of the path, the path itself last."""
    return let(
        labels(path),
        lambda p: F.transform(
            F.sequence(F.lit(1), F.size(p)), lambda i: F.array_join(F.slice(p, F.lit(1), i), ".")
        ),
    )


def is_under(path: str | Column, top: str | Column) -> Column:
    """Path equals `top` or lies below it. `a.bc` is not under `a.b`.

    With a string `top` both halves reach the parquet scan as filters.
    """
    p = _c(path)
    if isinstance(top, str):
        return (p == top) | p.startswith(top + ".")
    return (p == top) | F.startswith(p, F.concat(top, F.lit(".")))


def any_under(paths: str | Column, top: str) -> Column:
    """Some element of the array equals `top` or lies below it."""
    return F.exists(_c(paths), lambda e: is_under(e, top))


def _dotted(parts: list[str]) -> str:
    return "." + ".".join(parts) + "." if parts else "."


def matches(path: str | Column, pattern: str) -> Column:
    """Label pattern in which `*` stands for any number of labels, also none.

    The fixed stretches between stars are looked for from left to right, each at the first
    place after the one before, so the work grows with the length of the path only. A path
    with an empty label matches no star; NULL stays NULL.
    """
    p = _c(path)
    parts = pattern.split(".")
    if "*" not in parts:
        return p == pattern
    stretches: list[list[str]] = [[]]
    for part in parts:
        if part == "*":
            stretches.append([])
        else:
            stretches[-1].append(part)
    front, *inner, back = stretches

    def after(text: Column, place: Column, rest: list[list[str]]) -> Column:
        """`place` is the dot that ends what was found so far."""
        if not rest:
            start = F.length(text) - len(_dotted(back)) + 1
            return text.endswith(_dotted(back)) & (start >= place)
        found = F.position(F.lit(_dotted(rest[0])), text, place)
        return let(found, lambda f: (f > 0) & after(text, f + len(_dotted(rest[0])) - 1, rest[1:]))

    text = F.concat(F.lit("."), p, F.lit("."))
    hit = let(text, lambda t: t.startswith(_dotted(front)) & after(t, F.lit(len(_dotted(front))), [i for i in inner if i]))
    hit = hit & ~text.contains("..")
    # The fixed front of the pattern is also a plain prefix test, which the scan can use.
    return hit & is_under(p, ".".join(front)) if front else hit


def matches_labels(own: Column, pattern: Column) -> Column:
    """The same for arrays of labels, with a pattern from a column: an automaton steps along the labels.

    It is at place k of the pattern once the labels so far match the first k parts; at a
    star it may stay, and may go on without a label.
    """

    def rested(at: Column) -> Column:
        """Also past the stars that an active place stands before. Stars do not follow each other."""
        return F.transform(
            at, lambda on, k: on | ((k > 0) & F.get(at, k - 1) & F.coalesce(F.get(pattern, k - 1) == "*", F.lit(False)))
        )

    places = F.sequence(F.lit(0), F.size(pattern))
    start = F.transform(places, lambda k: k == 0)

    def step(at: Column, label: Column) -> Column:
        def moved(k: Column) -> Column:
            stays = F.get(at, k) & F.coalesce(F.get(pattern, k) == "*", F.lit(False))
            comes = (k > 0) & F.coalesce(F.get(at, k - 1), F.lit(False)) & F.coalesce(F.get(pattern, k - 1) == label, F.lit(False))
            return stays | comes

        return let(F.transform(places, moved), rested)

    return F.aggregate(own, let(start, rested), step, lambda at: F.element_at(at, -1))


def label_status(col: str | Column) -> Column:
    """ok / empty / too_long / not_lowercase / illegal_characters, tested in that order."""
    c = _c(col)
    return (
        F.when(c.isNull() | (c == ""), F.lit("empty"))
        .when(F.length(c) > LABEL_MAX_LENGTH, F.lit("too_long"))
        .when(c.rlike(LABEL_PATTERN), F.lit("ok"))
        .when(F.lower(c).rlike(LABEL_PATTERN), F.lit("not_lowercase"))
        .otherwise(F.lit("illegal_characters"))
    )


def label_suggestion(col: str | Column) -> Column:
    c = _c(col)
    return F.when(label_status(c) == "not_lowercase", F.lower(c))


def label_bad_characters(col: str | Column) -> Column:
    """Sorted distinct characters that may not stand in a label."""
    c = _c(col)
    bad = F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(f"({LABEL_ILLEGAL})"), F.lit(1))))
    return F.when(label_status(c) == "illegal_characters", bad)


def legal_label(col: Column) -> Column:
    return (F.length(col) <= LABEL_MAX_LENGTH) & col.rlike(LABEL_PATTERN)
