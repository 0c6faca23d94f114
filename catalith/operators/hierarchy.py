"""Queries over dotted-path ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions import paths
from catalith.functions.binding import compute_once, let
from catalith.skew import counted_hot_keys, spread_join

# Ids of one front or label that one task may take.
IDS_PER_TASK = 100_000


def descendants_of(df: DataFrame, id_col: str, top: str) -> DataFrame:
    """Rows at or below one path. The test is pushed to the scan."""
    return df.where(paths.is_under(id_col, top))


def descendants_of_many(df: DataFrame, id_col: str, tops: DataFrame, top_col: str, row_key: list[str]) -> DataFrame:
    """(row, top) for many paths at once: each id meets its own ancestors, an equi-join.

    A popular top has many descendants, so the join is spread.
    """
    up = df.withColumn(top_col, F.explode(paths.ancestors(id_col)))
    return spread_join(up, tops.select(top_col).distinct(), [top_col], spread_by=row_key, grouped=True)


def ancestors_of(df: DataFrame, id_col: str, into: str = "ancestor") -> DataFrame:
    return df.withColumn(into, F.explode(paths.ancestors(id_col)))


def path_match(df: DataFrame, id_col: str, pattern: str) -> DataFrame:
    return df.where(paths.matches(id_col, pattern))


def _slim(patterns: DataFrame, pattern: str) -> DataFrame:
    """(pattern, parts, n_front, front): labels without repeated stars, and those before the first star."""
    parts = F.split(F.col(pattern), r"\.")
    # A star after a star adds nothing.
    slim = F.filter(parts, lambda x, k: ~((x == "*") & (k > 0) & F.coalesce(F.get(parts, k - 1) == "*", F.lit(False))))
    rows = compute_once(patterns.where(F.col(pattern).isNotNull()).select(pattern).distinct(), {"parts": slim})
    star = F.array_position("parts", "*").cast("int")
    rows = rows.withColumn("n_front", F.when(star == 0, F.size("parts")).otherwise(star - 1))
    return rows.withColumn("front", F.array_join(F.slice("parts", F.lit(1), F.col("n_front")), "."))


def path_match_many(df: DataFrame, id_col: str, patterns: DataFrame, pattern: str) -> DataFrame:
    """(row, pattern) for many patterns at once, in which `*` stands for any number of labels, also none.

    An id meets the patterns that begin like it, by equality on the fixed front. Of the
    ids' own fronts only those as long as some pattern's are made. Patterns that begin with
    a star meet the ids that hold the one of their fixed labels that the fewest ids hold;
    only those of nothing but stars meet every id, as they match every id. An automaton
    over the labels decides.

    Fronts and labels are counted apart from the rows. Those of many ids are dropped before
    the rows move if no pattern stands there, and dealt to several tasks if one does.

    NULL ids and patterns match nothing, nor do ids with an empty label match a star.
    Repeated rows each count, repeated patterns once. `df` must not have a column named
    like the pattern's, or one of `_key`, `_labels`, `_lengths`, `_salt`, `_salts`, `parts`, `n_front`.
    """
    wanted = _slim(patterns, pattern)
    ids = df.where(F.col(id_col).isNotNull())

    # Front lengths that occur: a few numbers, one for each length of pattern.
    lengths = wanted.where("n_front > 0").agg(F.collect_set("n_front").alias("_lengths"))
    front = lambda n: F.concat(F.lit("f"), F.call_function("substring_index", F.col(f"`{id_col}`"), F.lit("."), n))
    keys = let(
        paths.labels(F.col(f"`{id_col}`")),
        lambda own: F.concat(
            F.transform(F.filter("_lengths", lambda n: n <= F.size(own)), front),
            F.transform(F.array_distinct(own), lambda label: F.concat(F.lit("l"), label)),
        ),
    )
    held = ids.crossJoin(F.broadcast(lengths)).withColumn("_key", F.explode(keys)).drop("_lengths")

    fronts = wanted.where("n_front > 0").select(pattern, "parts", F.concat(F.lit("f"), "front").alias("_key"))
    starred = wanted.where("n_front = 0").select(pattern, F.explode("parts").alias("_key")).where("_key <> '*'").distinct()
    starred = starred.withColumn("_key", F.concat(F.lit("l"), "_key"))
    counts = held.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    rarest = starred.join(counts, "_key", "left").groupBy(pattern).agg(F.min(F.struct(F.coalesce("_n", F.lit(0)), "_key"))["_key"].alias("_key"))
    anchors = fronts.unionByName(rarest.join(wanted.select(pattern, "parts"), pattern))

    # At most so many entries as there are keys for one task's rows.
    hot = counted_hot_keys(counts, ["_key"], "_n", IDS_PER_TASK)
    asked = hot.join(anchors.select("_key").distinct(), "_key", "left_semi")
    idle = hot.join(anchors.select("_key"), "_key", "left_anti").select("_key")
    held = held.join(F.broadcast(idle), "_key", "left_anti")
    found = spread_join(held, anchors, ["_key"], spread_by=[id_col], grouped=True, hot=asked).drop("_key")

    found = compute_once(found, {"_labels": paths.labels(F.col(f"`{id_col}`"))})
    legal = ~F.array_contains("_labels", "")
    exact = ~F.array_contains("parts", "*")
    hit = F.when(exact, F.col("_labels") == F.col("parts")).otherwise(legal & paths.matches_labels(F.col("_labels"), F.col("parts")))
    found = found.where(hit).drop("_labels", "parts")
    stars = wanted.where(F.size("parts") == 1).where(F.get("parts", F.lit(0)) == "*").select(pattern)
    whole = ids.where(~F.array_contains(paths.labels(F.col(f"`{id_col}`")), ""))
    every = whole.withColumn("_key", F.lit(1)).join(stars.withColumn("_key", F.lit(1)), "_key").drop("_key")
    return found.unionByName(every)


def array_descendants(df: DataFrame, arr: str, top: str) -> DataFrame:
    """Rows whose list has an element at or below the path."""
    return df.where(paths.any_under(arr, top))


def array_contains_exact(df: DataFrame, arr: str, wanted: list[str]) -> DataFrame:
    return df.where(F.arrays_overlap(F.col(arr), F.array(*[F.lit(w) for w in wanted])))


def subtree_counts(df: DataFrame, id_col: str) -> DataFrame:
    """Rows at or below every path that occurs. Counts combine map-side, so a root is no hot key."""
    up = df.select(F.explode(paths.ancestors(id_col)).alias("ancestor"))
    return up.groupBy("ancestor").agg(F.count(F.lit(1)).alias("n"))


def path_functions(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(
        F.col(id_col),
        paths.level_count(id_col).cast("bigint").alias("n_labels"),
        paths.leading(id_col, 2).alias("leading_two"),
        paths.leaf(id_col).alias("leaf"),
        paths.parent(id_col).alias("parent"),
        paths.subpath(id_col, 1, 2).alias("middle"),
        paths.subpath(id_col, -2).alias("last_two"),
    )


def concepts_about(concepts: DataFrame, top: str, id_col: str = "concept_id", links: str = "related_object_ids") -> DataFrame:
    """Concepts anchored at or below a path, or linking to something there.

    Both tests are row-local, so one scan with OR gives what a union and
    distinct of two scans would, without a shuffle.
    """
    return concepts.where(paths.is_under(id_col, top) | paths.any_under(links, top))


def compose(df: DataFrame, parts: list[str], into: str) -> DataFrame:
    return df.withColumn(into, paths.compose_id(*parts))


def label_report(df: DataFrame, col: str, key: Column) -> DataFrame:
    """Status, suggestion and offending characters of a label column."""
    return df.select(
        key.alias("object_key"),
        paths.label_status(col).alias("status"),
        paths.label_suggestion(col).alias("suggestion"),
        F.array_join(paths.label_bad_characters(col), "").alias("bad_chars"),
    )
