"""Code sets as typed tables that are published together, with a ledger of what was loaded.

    <root>/tables/<table>/load_id=N   the typed rows of one table as load N wrote them
    <root>/ledger/load_id=N           one row per table of load N: hash of its file, row count, time
    <root>/published/load_id=N        which load holds each table; written last

Tables have different columns, so each is a Parquet folder of its own. Readers start from
the newest complete `published` folder: a load that died before it is invisible, the
former version stays readable throughout, and the next load takes the same number and
writes the same folders again. A load replaces the tables it names and carries the
others over. `sweep` removes the folders that no kept publication leads to.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions.cells import typed_cell
from catalith.specs import CONTRACT_AUDIT_SCHEMA

POINTER_SCHEMA = "table string, data_load_id bigint"
DONE = "_SUCCESS"
# Rows of the largest file of a table.
ROWS_PER_FILE = 2_000_000


@dataclass(frozen=True)
class TableShape:
    """The columns of a table in order: (name, type)."""

    table: str
    columns: tuple[tuple[str, str], ...]


def shapes_of(live: DataFrame, tables: list[str]) -> list[TableShape]:
    """The declared shapes of some live tables: metadata, a row per column."""
    rows = live.where(F.col("table").isin(*tables)).select("table", "ordinal", "name", "type").collect()
    found = {t: tuple((r["name"], r["type"]) for r in sorted(rows, key=lambda r: r["ordinal"]) if r["table"] == t) for t in tables}
    return [TableShape(t, c) for t, c in found.items() if c]


@dataclass(frozen=True)
class CodeSets:
    spark: SparkSession
    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _loads(self, *parts: str) -> list[int]:
        """Numbers of the complete loads below a folder: one entry per load or table, never per row."""
        fs, where = self._fs(self.path(*parts))
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        found = [int(n.removeprefix("load_id=")) for n in names if n.startswith("load_id=")]
        complete = lambda n: fs.exists(self._fs(self.path(*parts, f"load_id={n}", DONE))[1])
        return sorted(n for n in found if complete(n))

    # --- reading ---------------------------------------------------------------

    def last_load(self) -> int:
        """Number of the last complete load, 0 before the first."""
        return max(self._loads("published"), default=0)

    def pointers(self, load_id: int | None = None) -> dict[str, int]:
        """Which load holds each table."""
        load_id = self.last_load() if load_id is None else load_id
        if not load_id:
            return {}
        rows = self.spark.read.schema(POINTER_SCHEMA).parquet(self.path("published", f"load_id={load_id}"))
        return {r["table"]: r["data_load_id"] for r in rows.collect()}  # one row per table

    def read(self, table: str, load_id: int | None = None) -> DataFrame:
        """A table as published by a load, the last one by default."""
        held = self.pointers(load_id).get(table)
        if held is None:
            raise KeyError(f"no code set {table!r}")
        return self.spark.read.parquet(self.path("tables", table, f"load_id={held}"))

    def ledger(self) -> DataFrame:
        """What complete loads wrote, oldest first by audit_id."""
        done = [self.path("ledger", f"load_id={n}") for n in self._loads("published")]
        if not done:
            return self.spark.createDataFrame([], CONTRACT_AUDIT_SCHEMA)
        return self.spark.read.schema(CONTRACT_AUDIT_SCHEMA).parquet(*done)

    # --- writing ---------------------------------------------------------------

    def reload(self, rows: DataFrame, headers: DataFrame, shapes: list[TableShape], run_ts: str) -> int:
        """Replace the named tables by the given rows; the number of the load.

        rows: table, line_no, cells. headers: table, sha256, header. Cells are matched to
        columns by the header and become the column's type; an empty one is NULL. Tables
        without rows become empty. Any failure before the last write changes nothing that a
        reader sees.
        """
        load_id = self.last_load() + 1
        named = {s.table for s in shapes}
        data = rows.where(F.col("table").isin(*named)) if named else rows.where(F.lit(False))
        # One pass deals the rows out; each table then reads its own folder only.
        dealt = self.path("staged", f"load_id={load_id}")
        keep = data.select("table", "line_no", "cells")
        keep.write.mode("overwrite").partitionBy("table").parquet(dealt)
        first = headers.where(F.col("table").isin(*named)) if named else headers.where(F.lit(False))
        places = {r["table"]: list(r["header"]) for r in first.select("table", "header").collect()}  # widths of tables
        schema = keep.schema
        own = self.spark.createDataFrame([], schema) if not named else self.spark.read.schema(schema).parquet(dealt)
        for s in shapes:
            at = {name: i for i, name in reversed(list(enumerate(places.get(s.table, []))))}
            cells = [typed_cell(F.get("cells", F.lit(at.get(name, len(at)))), kind).alias(name) for name, kind in s.columns]
            typed = own.where(F.col("table") == s.table).select(*cells)
            typed.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(self.path("tables", s.table, f"load_id={load_id}"))
        counts = own.groupBy("table").agg(F.count(F.lit(1)).alias("row_count"))
        written = first.groupBy("table").agg(F.min("sha256").alias("csv_sha256")).join(counts, "table", "left")
        # Numbered by load and table name, so that a repeated load numbers alike.
        order = {t: i for i, t in enumerate(sorted(named))}
        numbers = self.spark.createDataFrame([(t, load_id * 1_000_000 + i) for t, i in order.items()], "table string, audit_id bigint")
        audit = numbers.join(written, "table").select(
            "audit_id", F.col("table").alias("table_name"), "csv_sha256",
            F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"), F.lit(run_ts).cast("timestamp").alias("loaded_ts"),
        )
        audit.coalesce(1).write.mode("overwrite").parquet(self.path("ledger", f"load_id={load_id}"))
        held = self.pointers() | dict.fromkeys(named, load_id)
        pointers = self.spark.createDataFrame(sorted(held.items()), POINTER_SCHEMA)
        self._drop(self.path("published", f"load_id={load_id}"))
        pointers.coalesce(1).write.mode("overwrite").parquet(self.path("published", f"load_id={load_id}"))
        self._drop(dealt)
        return load_id

    def _drop(self, path: str) -> bool:
        fs, where = self._fs(path)
        return bool(fs.exists(where) and fs.delete(where, True))

    def sweep(self, keep: int = 1) -> list[str]:
        """Remove table versions that none of the last `keep` publications leads to; the folders removed.

        The lists of older publications and the ledger stay: they are small, and the ledger
        counts the loads that have one. Loads must not run meanwhile.
        """
        if keep < 1:
            raise ValueError("the last publication must stay")
        loads = self._loads("published")
        kept = loads[-keep:]
        reached = {(t, n) for p in kept for t, n in self.pointers(p).items()}
        gone = []
        fs, where = self._fs(self.path("tables"))
        names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        for table in sorted(names):
            folder = self._fs(self.path("tables", table))[1]
            for s in fs.listStatus(folder):
                number = int(s.getPath().getName().removeprefix("load_id="))
                if (table, number) not in reached:
                    gone.append(self.path("tables", table, f"load_id={number}"))
        for g in gone:
            self._drop(g)
        return gone


def freshness_ledger(ledger: DataFrame) -> DataFrame:
    """The ledger as `freshness` reads it."""
    return ledger.withColumnRenamed("table_name", "table")
