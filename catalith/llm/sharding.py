"""Sharding along a Hilbert curve, so that each shard holds a compact box of several metadata columns.

Each dimension is cut into `1 << bits` cells, rows are sorted by the curve index of
their cell (ties by content checksum, then id), and the sorted sequence is cut into
runs of equal row counts. A reader that filters on any of the dimensions then skips
most shards by their minimum and maximum.

Law: `rows`; shard sizes differ by one row at most, also if one text, source or
language holds a third of all rows. With fewer rows than shards some shards stay empty.
Null texts have size 8 and the checksum of no bytes. Null values of a dimension share
its first cell. Repeated ids keep one place each. An empty table gives no rows.
The result has its own columns only, so clashing names in the input do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith.checkpoints import stage, staging_folder

BITS = 5
# Bytes of a row besides its text.
ROW_BYTES = 8


def quantised(docs: DataFrame, column: str, bits: int = BITS) -> Column:
    """Cell number of a column: by magnitude for numbers, by hash for anything else; 0 for null."""
    cells = 1 << bits
    kind = docs.schema[column].dataType
    c = F.col(f"`{column}`")
    if isinstance(kind, T.NumericType):
        # Half-octaves: a cell spans a factor of the square root of two.
        level = F.floor(2 * F.log2(F.greatest(F.abs(c.cast("double")), F.lit(0.0)) + 1))
        cell = F.least(level, F.lit(cells - 1))
    else:
        cell = F.pmod(F.xxhash64(c.cast("string")), F.lit(cells - 1)) + 1
    return F.coalesce(cell, F.lit(0)).cast("int")


def with_hilbert_index(df: DataFrame, dims: list[str], bits: int = BITS, name: str = "_curve") -> DataFrame:
    """Adds the Hilbert curve index of the integer columns `dims`, each below `1 << bits`.

    The coordinates are turned into the transposed index one bit plane after the
    other, from the highest: where a coordinate has the bit, the first one's lower
    bits are inverted, else the two exchange the lower bits in which they differ.
    Then the planes are Gray-coded and interleaved. Every step is a projection of
    its own, so that no expression is copied.
    """
    xs = [f"_x{i}" for i in range(len(dims))]
    df = df.withColumns({x: F.col(d) for x, d in zip(xs, dims, strict=True)})
    for plane in range(bits - 1, 0, -1):
        low = (1 << plane) - 1
        for x in xs:
            has = F.getbit(F.col(x), F.lit(plane)) == 1
            if x == xs[0]:
                df = df.withColumn(x, F.when(has, F.col(x).bitwiseXOR(low)).otherwise(F.col(x)))
            else:
                swap = F.col(xs[0]).bitwiseXOR(F.col(x)).bitwiseAND(low)
                df = df.withColumn("_flip", F.when(has, F.lit(low)).otherwise(swap)).withColumn("_swap", F.when(has, F.lit(0)).otherwise(swap))
                df = df.withColumns(
                    {xs[0]: F.col(xs[0]).bitwiseXOR(F.col("_flip")), x: F.col(x).bitwiseXOR(F.col("_swap"))}
                )
    for before, x in zip(xs, xs[1:], strict=False):
        df = df.withColumn(x, F.col(x).bitwiseXOR(F.col(before)))
    # Parity of the higher bits of the last coordinate, at each lower plane.
    df = df.withColumn("_flip", F.lit(0))
    for plane in range(bits - 1, 0, -1):
        df = df.withColumn(
            "_flip",
            F.when(F.getbit(F.col(xs[-1]), F.lit(plane)) == 1, F.col("_flip").bitwiseXOR((1 << plane) - 1)).otherwise(F.col("_flip")),
        )
    df = df.withColumns({x: F.col(x).bitwiseXOR(F.col("_flip")) for x in xs})
    index = F.lit(0).cast("bigint")
    for plane in range(bits - 1, -1, -1):
        for x in xs:
            index = F.shiftleft(index, 1) + F.getbit(F.col(x), F.lit(plane))
    return df.withColumn(name, index).drop(*xs, "_flip", "_swap")


def assign(
    docs: DataFrame, n_shards: int, dims: list[str], doc: str = "doc_id", text: str = "text", bits: int = BITS
) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard, curve."""
    spark = docs.sparkSession
    cells = [f"_d{i}" for i in range(len(dims))]
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc),
        (F.octet_length(content) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        *[quantised(docs, d, bits).alias(c) for d, c in zip(dims, cells, strict=True)],
    )
    folder = staging_folder(spark)
    # Written before it is sorted, so that finding the ranges does not read the texts a second time.
    rows = stage(with_hilbert_index(rows, cells, bits, "curve").drop(*cells), folder, "cells")
    ordered = rows.orderBy("curve", "text_crc32", doc, "size").withColumn("_at", F.monotonically_increasing_id())
    # The sorted table is written once, so a repeated task cannot number the rows differently.
    ordered = stage(ordered, folder, "ordered")
    part = F.shiftright("_at", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the sort: small whatever the data, and all that is counted in one place.
    before = [(int(r["_part"]), int(r["_n"])) for r in sizes.orderBy("_part").collect()]
    total, starts = 0, []
    for p, n in before:
        starts.append((p, total))
        total += n
    offsets = spark.createDataFrame(starts, "_part bigint, _start bigint")
    placed = ordered.withColumn("_part", part).join(F.broadcast(offsets), "_part", "left")
    rank = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)
    placed = placed.withColumn("_rank", rank).withColumn("_shard", F.expr(f"_rank * {n_shards} div {max(total, 1)}"))
    first = F.expr(f"(_shard * {total} + {n_shards - 1}) div {n_shards}")
    return placed.select(
        F.col(doc),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_rank") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def write(docs: DataFrame, shards: DataFrame, path: str, doc: str = "doc_id") -> None:
    """Write the documents into one folder per shard, in slot order; several files where a shard is large."""
    placed = docs.join(shards.select(doc, "shard", "slot", "curve"), doc)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
