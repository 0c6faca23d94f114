"""The shared issue shape and the gate between validation waves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith.functions.binding import compute_once

ISSUE_SCHEMA = T.StructType(
    [
        T.StructField("wave", T.IntegerType(), False),
        T.StructField("rule", T.StringType(), False),
        T.StructField("object_type", T.StringType(), False),
        T.StructField("object_key", T.StringType(), True),
        T.StructField("detail", T.StringType(), True),
        T.StructField("hint", T.StringType(), True),
    ]
)

# A row-local check: rule name, whether a row is bad, and the detail to report.
Check = tuple[str, Column, Column]


def key_text(*cols: str | Column) -> Column:
    """One printable key out of several columns; a missing part prints as empty."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def as_issues(
    df: DataFrame,
    rule: str,
    object_type: str,
    object_key: Column,
    detail: Column,
    hint: Column | None = None,
    wave: int = 2,
) -> DataFrame:
    """Every row of `df` becomes one issue."""
    return df.select(
        F.lit(wave).alias("wave"),
        F.lit(rule).alias("rule"),
        F.lit(object_type).alias("object_type"),
        object_key.cast("string").alias("object_key"),
        detail.cast("string").alias("detail"),
        (hint if hint is not None else F.lit(None)).cast("string").alias("hint"),
    )


def check_rows(
    df: DataFrame,
    object_type: str,
    object_key: Column,
    checks: list[Check],
    wave: int = 1,
) -> DataFrame:
    """Row-local checks in one pass over `df`, however many there are.

    `checks` holds (rule, is_bad, detail); a row gives one issue per rule that
    is bad for it.
    """
    judged = compute_once(df.withColumn("object_key", object_key.cast("string")), {"_hits": hits(checks)})
    return issues_of_hits(judged, "_hits", object_type, F.col("object_key"), wave)


def hits(checks: list[Check]) -> Column:
    """Array of (rule, detail) for the checks a row fails; empty for a clean row."""
    found = [
        F.when(bad, F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail")))
        for rule, bad, detail in checks
    ]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def issues_of_hits(df: DataFrame, hits_col: str, object_type: str, object_key: Column, wave: int) -> DataFrame:
    rows = df.select(object_key.cast("string").alias("object_key"), F.explode(hits_col).alias("hit"))
    return rows.select(
        F.lit(wave).alias("wave"),
        F.col("hit.rule").alias("rule"),
        F.lit(object_type).alias("object_type"),
        "object_key",
        F.col("hit.detail").alias("detail"),
        F.lit(None).cast("string").alias("hint"),
    )


def union_issues(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def no_issues(spark) -> DataFrame:
    return spark.createDataFrame([], ISSUE_SCHEMA)


def gate_waves(issues: DataFrame) -> DataFrame:
    """Issues of the first wave that has any; later waves would only echo them."""
    first_bad = issues.agg(F.min("wave").alias("w")).scalar()
    return issues.where(F.col("wave") == first_bad)


def wave_status(issues: DataFrame, waves: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """One row per wave: its issue count and whether it ran at all.

    A wave runs only when every earlier wave is clean. All counts come from
    one aggregate over the issues.
    """
    counts = [F.count_if(F.col("wave") == w).alias(f"n{w}") for w in waves]
    totals = issues.agg(*counts)
    rows = []
    earlier = F.lit(0)
    for w in waves:
        n = F.col(f"n{w}")
        status = (
            F.when(earlier > 0, F.lit("not reached")).when(n > 0, F.lit("failed")).otherwise(F.lit("passed"))
        )
        rows.append(F.struct(F.lit(w).alias("wave"), n.alias("n_issues"), status.alias("status")))
        earlier = earlier + n
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
