"""Reading relations as declared: missing columns added, absent lists empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith.specs import TableSpec


def conform(df: DataFrame, spec: TableSpec, stored: bool = False) -> DataFrame:
    """Exactly the declared columns, in order and typed; a NULL list becomes an empty one."""
    schema = spec.stored_schema() if stored else spec.authored_schema()
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        c = c.cast(f.dataType.simpleString())
        if isinstance(f.dataType, T.ArrayType):
            c = F.coalesce(c, F.array().cast(f.dataType.simpleString()))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def empty_state(spark: SparkSession, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.stored_schema())


def introspect_tables(spark: SparkSession, database: str | None = None, skip: tuple[str, ...] = ()) -> DataFrame:
    """Live tables and their columns: table, ordinal, name, type, nullable, is_pk.

    Reads the session catalogue, so this is metadata only. A key column is
    marked by `is_pk` in its field metadata.
    """
    rows = []
    for t in spark.catalog.listTables(database) if database else spark.catalog.listTables():
        if t.name in skip:
            continue
        name = f"{database}.{t.name}" if database else t.name
        for i, f in enumerate(spark.table(name).schema.fields):
            rows.append((t.name, i, f.name, f.dataType.simpleString(), f.nullable, bool(f.metadata.get("is_pk", False))))
    return spark.createDataFrame(
        rows, "table string, ordinal int, name string, type string, nullable boolean, is_pk boolean"
    )
