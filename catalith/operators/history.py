"""Applying changes, keeping history, and reading it back."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.operators.intervals import GRAIN, interval_join
from catalith.skew import spread_join


def validated_stamp(old_flag: Column, old_ts: Column, new_flag: Column, run_ts: Column) -> Column:
    """When a row became validated.

    Not validated: none. Newly validated, or validated without a stamp: this
    run. Still validated: as before.
    """
    return F.when(new_flag, F.when(F.coalesce(old_flag, F.lit(False)), F.coalesce(old_ts, run_ts)).otherwise(run_ts))


def history_rows(changes: DataFrame, run_ts: Column) -> DataFrame:
    """The old version of every updated or deleted row, closed at `run_ts`."""
    return changes.where(F.col("op").isin("update", "delete")).select("old.*", run_ts.alias("end_ts"))


def apply_changes(
    cur: DataFrame, changes: DataFrame, key: list[str], run_ts: Column, validated: bool = False, reason: bool = True
) -> DataFrame:
    """The new current state.

    Inserts start at `run_ts` without a reason; updates keep their insert time;
    untouched rows pass through; deleted rows are gone. `run_ts` is one literal
    for the whole run, because lineage joins on equality with it.
    """
    kept = cur.join(changes.select(*key), key, "left_anti").select(*cur.columns)
    live = changes.where(F.col("op") != "delete")
    is_insert = F.col("op") == "insert"
    stamps = {
        "insert_ts": F.when(is_insert, run_ts).otherwise(F.col("old.insert_ts")),
        "update_ts": run_ts,
    }
    if reason:
        stamps["update_reason"] = F.when(~is_insert, F.col("new.update_reason"))
    if validated:
        stamps["validated_ts"] = validated_stamp(
            F.col("old.validated"), F.col("old.validated_ts"), F.col("new.validated"), run_ts
        )
    written = live.select(*[stamps[c].alias(c) if c in stamps else F.col(f"new.{c}").alias(c) for c in cur.columns])
    return kept.unionByName(written)


def audit_row(changes: list[DataFrame], load_id: int, commit_sha: str, run_ts: Column, reset: bool = False) -> DataFrame:
    """One row per run, also when nothing changed."""
    ops = reduce(DataFrame.union, [c.select("op") for c in changes])
    return ops.agg(
        F.count_if(F.col("op") == "insert").alias("inserts"),
        F.count_if(F.col("op") == "update").alias("updates"),
        F.count_if(F.col("op") == "delete").alias("deletes"),
    ).select(
        F.lit(load_id).cast("bigint").alias("load_id"), F.lit(commit_sha).alias("commit_sha"),
        "inserts", "updates", "deletes", F.lit(reset).alias("reset_history"), run_ts.alias("loaded_ts"),
    )


def commit_of_row(rows: DataFrame, audit: DataFrame, update_ts: str = "update_ts") -> DataFrame:
    """Each row with the run that last wrote it.

    One run may have written a large share of all rows, so the join is spread;
    the audit side has one row per run.
    """
    runs = audit.select(F.col("loaded_ts").alias(update_ts), "load_id", "commit_sha")
    return spread_join(rows, runs, [update_ts], "left", spread_by=[c for c in rows.columns if c != update_ts])


def latest_load(audit: DataFrame, commit_sha: str | None = None) -> DataFrame:
    """The most recent run; with a commit also whether the store holds a different one.

    A single aggregate, no sort of the ledger.
    """
    latest = audit.agg(
        F.max(F.struct("loaded_ts", "load_id", "commit_sha")).alias("r")
    ).select("r.load_id", "r.commit_sha", "r.loaded_ts")
    if commit_sha is None:
        return latest
    return latest.withColumn("is_behind", ~F.col("commit_sha").eqNullSafe(F.lit(commit_sha)))


def versions(cur: DataFrame, history: DataFrame) -> DataFrame:
    """Every version of every row; the current one has no end."""
    return history.unionByName(cur.withColumn("end_ts", F.lit(None).cast(dict(history.dtypes)["end_ts"])))


def history_walk(cur: DataFrame, history: DataFrame, key: list[str]) -> DataFrame:
    """Timeline per key with the reason each version ended.

    A version ends exactly when its successor was written, so the successor is
    found by equality on (key, time): no window, and a key with very many
    versions is spread over all tasks. A version without a successor was
    deleted, or is the current one.
    """
    every = versions(cur, history)
    following = every.select(
        *key, F.col("update_ts").alias("end_ts"), F.col("update_reason").alias("end_reason"), F.lit(True).alias("_next")
    )
    walked = every.join(following, [*key, "end_ts"], "left")
    outcome = (
        F.when(F.col("end_ts").isNull(), "current").when(F.col("_next"), "replaced").otherwise("deleted")
    )
    return walked.withColumn("outcome", outcome).drop("_next")


def as_of(cur: DataFrame, history: DataFrame, at: datetime | str) -> DataFrame:
    """The rows as they stood at a moment: written by then, not yet ended."""
    t = F.lit(at).cast(dict(cur.dtypes)["update_ts"])
    return versions(cur, history).where((F.col("update_ts") <= t) & (F.col("end_ts").isNull() | (F.col("end_ts") > t)))


def as_of_moments(
    cur: DataFrame, history: DataFrame, key: list[str], moments: DataFrame, at: str, grain: int = GRAIN
) -> DataFrame:
    """Each row of `moments` (key, `at`, other columns) with the version of its key that stood then.

    `found` is false, and the version's columns are NULL, where the key did not exist yet,
    was deleted, or is unknown. Current rows have no end and are one a key: they meet by
    the key alone. Closed versions meet by an interval join. A key with a very large share
    of the moments or of the versions is split in either. Equal rows of `moments` each
    count; a NULL key or moment finds nothing. Columns of `moments` other than the key must
    not be named like a version's.
    """
    present = cur.where(F.col("update_ts").isNotNull()).withColumn("end_ts", F.lit(None).cast(dict(history.dtypes)["end_ts"]))
    # Versions are rows of their own, often made from fewer: no guess of their size may make Spark broadcast them.
    now = moments.hint("merge").join(present.hint("merge"), key).where(F.col("update_ts") <= F.col(at))
    then = interval_join(history, moments, key, "update_ts", "end_ts", at, grain)
    found = now.unionByName(then, allowMissingColumns=True).withColumn("found", F.lit(True))
    # NULL keys and moments equal nothing, so they stay here.
    lost = moments.hint("merge").join(found.select(*key, at).hint("merge"), [*key, at], "left_anti").withColumn("found", F.lit(False))
    return found.unionByName(lost, allowMissingColumns=True)
