"""Published state as versioned Parquet folders.

    <root>/state/<relation>/load_id=N/bucket=B   rows of one key bucket
    <root>/history/<relation>/load_id=N          versions closed by run N
    <root>/pointers/load_id=N                    which run holds each bucket
    <root>/load_audit/load_id=N                  one row: run N is complete

The audit row is written last. Readers start from it, so a run that died in
between is invisible, and the next run simply writes the same folders again.
Only buckets that hold a changed key are rewritten: a small change to a very
large relation costs a small write. The pointers carry a digest of each bucket's authored
rows; a new snapshot whose digest is the same need not be compared with it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions.binding import compute_once
from catalith.sources.state import empty_state
from catalith.specs import AUDIT_SCHEMA, RELATIONS, TableSpec

POINTER_SCHEMA = "relation string, bucket int, data_load_id bigint, digest string"
# Parts of a row's hash that are summed up apart, and their hexadecimal digits.
PARTS, DIGITS = 4, 15


@dataclass(frozen=True)
class Store:
    """A publication folder. `buckets` is fixed for its lifetime."""

    spark: SparkSession
    root: str
    buckets: int = 64

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def has(self, *parts: str) -> bool:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(*parts))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def digests(self, spec: TableSpec, rows: DataFrame) -> DataFrame:
        """(bucket, digest): what the authored columns of a bucket's rows are, in whatever order the rows come.

        Each row's hash is cut into numbers, and a bucket's digest is made of their sums:
        equal rows give equal sums, partial sums combine before the shuffle, and one row
        a bucket is all that is gathered.
        """
        image = F.to_json(F.struct(*spec.columns), {"ignoreNullFields": "false"})
        rows = compute_once(rows.select(self.bucket_of(spec), *spec.columns), {"_hash": F.sha2(image, 256)})
        part = lambda k: F.conv(F.substring("_hash", DIGITS * k + 1, DIGITS), 16, 10).cast("decimal(20,0)")
        sums = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(part(k)).alias(f"_{k}") for k in range(PARTS)])
        text = F.concat_ws(",", *[F.col(c).cast("string") for c in ("_n", *(f"_{k}" for k in range(PARTS)))])
        return sums.select("bucket", F.sha2(text, 256).alias("digest"))

    def changed_buckets(self, spec: TableSpec, digests: dict[int, str], load_id: int) -> list[int]:
        """Buckets whose rows are not what a run published: the only ones that need be compared."""
        held = {p.bucket: p.digest for p in self.pointers(load_id).where(F.col("relation") == spec.name).collect()}
        return sorted(b for b in digests.keys() | held.keys() if b not in held or held[b] is None or digests.get(b) != held[b])

    def bucket_of(self, spec: TableSpec) -> Column:
        return F.pmod(F.xxhash64(*spec.key), F.lit(self.buckets).cast("bigint")).cast("int").alias("bucket")

    # --- reading ---------------------------------------------------------------

    def audit(self) -> DataFrame:
        if not self.has("load_audit"):
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(self.path("load_audit"))

    def last_load(self) -> int:
        """Number of the last complete run, 0 before the first."""
        return self.audit().agg(F.max("load_id")).first()[0] or 0

    def pointers(self, load_id: int) -> DataFrame:
        if load_id == 0:
            return self.spark.createDataFrame([], POINTER_SCHEMA)
        return self.spark.read.schema(POINTER_SCHEMA).parquet(self.path("pointers", f"load_id={load_id}"))

    def state(self, spec: TableSpec, load_id: int | None = None, only: list[int] | None = None) -> DataFrame:
        """A relation as published by a run (the last one by default), or some of its buckets.

        The pointer list has at most `buckets` rows per relation.
        """
        load_id = self.last_load() if load_id is None else load_id
        mine = self.pointers(load_id).where(F.col("relation") == spec.name).collect()
        folders = [
            self.path("state", spec.name, f"load_id={p.data_load_id}", f"bucket={p.bucket}")
            for p in mine
            if only is None or p.bucket in only
        ]
        if not folders:
            return empty_state(self.spark, spec)
        return self.spark.read.schema(spec.stored_schema()).parquet(*folders)

    def history(self, spec: TableSpec) -> DataFrame:
        """Closed versions of complete runs, from the last history reset on."""
        audit = self.audit()
        done = audit.agg(
            F.max("load_id").alias("last"),
            F.coalesce(F.max(F.when(F.col("reset_history"), F.col("load_id"))), F.lit(0)).alias("reset"),
        ).first()
        if not self.has("history", spec.name) or done["last"] is None:
            return self.spark.createDataFrame([], spec.history_schema())
        rows = self.spark.read.schema(spec.history_schema()).option("basePath", self.path("history", spec.name))
        rows = rows.parquet(self.path("history", spec.name))
        kept = F.col("load_id").between(done["reset"], done["last"])
        return rows.where(kept).select(*spec.history_schema().names)

    # --- writing ---------------------------------------------------------------

    def publish(
        self,
        load_id: int,
        changes: dict[str, DataFrame],
        apply,
        history: dict[str, DataFrame],
        audit_row: DataFrame,
        digests: dict[str, dict[int, str]] | None = None,
    ) -> None:
        """Write one run: touched buckets, history, pointers, and last the audit row.

        `apply(spec, current_rows, changes)` gives the new rows of the touched
        buckets. `digests` are those of the new snapshot, by relation and bucket; a
        bucket without one is compared by the next run in any case.
        """
        last = self.last_load()
        digests = digests or {}
        after = {(p.relation, p.bucket): (p.data_load_id, p.digest) for p in self.pointers(last).collect()}
        for name, change in changes.items():
            spec = RELATIONS[name]
            touched = [r.bucket for r in change.select(self.bucket_of(spec)).distinct().collect()]
            if not touched:
                continue
            rows = apply(spec, self.state(spec, last, touched), change)
            target = self.path("state", name, f"load_id={load_id}")
            (
                rows.withColumn("bucket", self.bucket_of(spec))
                # By range, so that a large bucket becomes several files and no task takes a whole one.
                .repartitionByRange("bucket", *spec.key)
                .sortWithinPartitions("bucket", *spec.key)
                .write.mode("overwrite")
                .partitionBy("bucket")
                .parquet(target)
            )
            for b in touched:
                # A bucket that lost its last row has no folder and no pointer.
                after.pop((name, b), None)
                if self.has("state", name, f"load_id={load_id}", f"bucket={b}"):
                    after[(name, b)] = (load_id, digests.get(name, {}).get(b))
        for name, rows in history.items():
            rows.write.mode("overwrite").parquet(self.path("history", name, f"load_id={load_id}"))
        pointer_rows = [(r, b, *v) for (r, b), v in sorted(after.items())]
        self.spark.createDataFrame(pointer_rows, POINTER_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            self.path("pointers", f"load_id={load_id}")
        )
        audit_row.drop("load_id").coalesce(1).write.mode("overwrite").parquet(
            self.path("load_audit", f"load_id={load_id}")
        )
