"""Joining moments to the spans they fall into, as an equality join.

A span of time is covered by grains (stretches of `grain` seconds), and its grains are
cut into dyadic pieces: stretches of 1, 2, 4, ... grains that start at a multiple of
their own length, at most two of each length. A moment lies in one stretch of each
length. So span and moment meet by equality on (key, length, place), which Spark
shuffles and splits like any other join; there is no nested loop and no sort of a key's
spans. Spans that share no grain with a moment never meet it. What the grain is too
coarse for is decided on the times themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.binding import compute_once

GRAIN = 3600
# Grains are counted from some centuries before the epoch on, so that all numbers are positive.
SHIFT_SECONDS = 1 << 36
# Lengths up to 2 ** LEVELS grains are told apart: with grains of a second, the years 1 to 9999 and more.
LEVELS = 39


def _grain_of(moment: Column, grain: int) -> Column:
    seconds = F.unix_seconds(moment.cast("timestamp")) + F.lit(SHIFT_SECONDS)
    return F.floor(seconds / F.lit(grain)).cast("bigint")


def dyadic_pieces(first: Column, last: Column) -> Column:
    """array<struct<level, place>>: the grains `first` to `last`, both included, as aligned stretches.

    At each length the still uncovered grains run from the first multiple at or after
    `first` to the last one at or before `last + 1`; an odd end there becomes a piece.
    Empty if `last` is before `first`.
    """

    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        low = F.call_function("shiftright", first + size - 1, level)
        high = F.call_function("shiftright", last + 1, level)
        odd_low, odd_high = low % 2 == 1, high % 2 == 1
        piece = lambda place: F.struct(level.alias("level"), place.alias("place"))
        left = F.when((low < high) & odd_low, piece(low))
        # A single stretch must not be taken from both ends.
        right = F.when((low < high) & odd_high & ~(odd_low & (low == high - 1)), piece(high - 1))
        return F.array(left, right)

    # No piece is longer than the whole stretch, so a short one is asked for a few lengths only.
    longest = F.length(F.bin(F.greatest(last - first + 1, F.lit(1)))) - 1
    pieces = F.flatten(F.transform(F.sequence(F.lit(0), longest), at))
    return F.array_compact(pieces)


def interval_join(
    spans: DataFrame, points: DataFrame, key: list[str], start: str, end: str, at: str, grain: int = GRAIN
) -> DataFrame:
    """Every row of `points` with every row of `spans` of its key that holds its moment: start <= at < end.

    No end means the span goes on for ever; an empty or backward span holds nothing, nor
    does one without a start. Points without a moment, and null keys, meet nothing. Columns
    of `spans` other than the key must have names of their own. Equal rows of either side
    each count.
    """
    piece = ["_level", "_place"]
    ever = F.lit((1 << LEVELS) - 1).cast("bigint")
    first, last = _grain_of(F.col(start), grain), F.coalesce(_grain_of(F.col(end), grain), ever)
    held = spans.where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start))))
    cut = compute_once(held, {"_first": first, "_last": last})
    cut = cut.select(*held.columns, F.explode(dyadic_pieces(F.col("_first"), F.col("_last"))).alias("_piece"))
    cut = cut.select(*held.columns, *[F.col(f"_piece.{p[1:]}").alias(p) for p in piece])

    there = compute_once(points.where(F.col(at).isNotNull()), {"_grain": _grain_of(F.col(at), grain)})
    # One stretch of each length holds the moment: its ancestors.
    levels = F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))
    there = there.select(*points.columns, "_grain", levels.alias("_level"))
    there = there.withColumn("_place", F.call_function("shiftright", "_grain", "_level")).drop("_grain")
    # Most lengths do not occur among the spans; their copies of the moments go before they are shuffled.
    used = cut.select("_level").distinct()
    there = there.join(F.broadcast(used), "_level", "left_semi")  # LEVELS + 1 numbers at most
    # Spark guesses the size of the pieces from the rows they were cut from, so it must not broadcast them.
    met = there.hint("merge").join(cut.hint("merge"), [*key, *piece])
    inside = (F.col(start) <= F.col(at)) & (F.col(end).isNull() | (F.col(at) < F.col(end)))
    return met.where(inside).drop(*piece)
