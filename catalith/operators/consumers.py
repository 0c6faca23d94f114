"""Questions a consumer of the catalogue asks, and applying a mapping to data."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.skew import spread_join
from catalith.specs import CARDINALITIES

# Buckets of the sketch that tells which relationships may share a key.
SKETCH = 1 << 16


def mapping_choices(mappings: DataFrame, columns: DataFrame, table_id: str | None = None) -> DataFrame:
    """Mappings of every column with their guidance; deliberate drops are flagged, unmapped columns stay."""
    wanted = columns if table_id is None else columns.where(F.col("table_id") == table_id)
    cols = wanted.select(F.col("column_id").alias("source_column_id"))
    maps = mappings.select("source_column_id", "mapping_name", "target_expression", "use_when")
    # The column side is unique; the mapping side may repeat one column very often.
    found = spread_join(maps, cols, ["source_column_id"], "inner", spread_by=["mapping_name"])
    status = F.when(F.col("target_expression").isNull(), "dropped").otherwise("mapped")
    bare = cols.join(mappings.select("source_column_id").distinct(), "source_column_id", "left_anti")
    return found.withColumn("status", status).unionByName(
        bare.withColumn("status", F.lit("unmapped")), allowMissingColumns=True
    )


def _physical(table_id: str, df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"{table_id}.{c}") for c in df.columns])


def _quoted(expression: str, ids: list[str]) -> str:
    """Column ids in an expression as quoted column names (literals are left alone)."""
    names = "|".join(re.escape(i) for i in sorted(ids, key=len, reverse=True))
    pattern = re.compile(rf"('[^']*(?:''[^']*)*')|(?<![\w.])({names})(?![\w.])")
    return pattern.sub(lambda m: m.group(1) or f"`{m.group(2)}`", expression)


def apply_mapping(
    frames: dict[str, DataFrame],
    source_table: str,
    source_key: list[str],
    joins: list[tuple[str, str | list[tuple[str, str]]]],
    expression: str,
    kind: str = "scalar",
    into: str = "mapped",
) -> DataFrame:
    """Compute a mapped column at the grain of the source table.

    `joins` lists, in order, the tables to reach and either the equal column ids
    (here, there) or the recorded join condition, as `join_paths.joins_of` finds
    them from the relationships. `kind` is scalar (also for window expressions) or aggregate.
    Unmatched source rows stay, as with a left join: the matching part is an
    inner join, the rest an anti join. The aggregate combines map-side.
    """
    if kind not in ("scalar", "aggregate"):
        raise ValueError(f"unknown mapping kind {kind!r}")
    work = _physical(source_table, frames[source_table])
    for table, on in joins:
        other = _physical(table, frames[table])
        if isinstance(on, str):
            condition = F.expr(_quoted(on, [*work.columns, *other.columns]))
            work = work.join(other, condition).unionByName(work.join(other, condition, "left_anti"), allowMissingColumns=True)
            continue
        plain = [f"_k{i}" for i in range(len(on))]
        keyed = work
        for name, (here, there) in zip(plain, on):
            keyed = keyed.withColumn(name, F.col(f"`{here}`"))
            other = other.withColumn(name, F.col(f"`{there}`"))
        # Two joins, since adaptive execution splits a hot key of either side in the inner one only.
        matched = keyed.join(other, plain)
        lone = keyed.join(other.select(*plain), plain, "left_anti")
        work = matched.unionByName(lone, allowMissingColumns=True).drop(*plain)
    value = F.expr(_quoted(expression, work.columns)).alias(into)
    keys = [F.col(f"`{source_table}.{k}`").alias(k) for k in source_key]
    if kind == "scalar":
        return work.select(*keys, value)
    return work.groupBy(*keys).agg(value)


def table_grain(columns: DataFrame, tables: DataFrame) -> DataFrame:
    """Key columns of each table, one row per key column; a table without a key has one row with none.

    Rows, not an array: a very wide table stays spread over the cluster.
    """
    keys = columns.where("is_primary_key").select("table_id", "column_name")
    keyless = tables.select("table_id").join(keys.select("table_id").distinct(), "table_id", "left_anti")
    return keys.unionByName(keyless, allowMissingColumns=True)


def code_lookup(data: DataFrame, code: str, code_set: DataFrame, set_code: str, meaning: str) -> DataFrame:
    """Decode a coded column; `known` is false for codes outside the set, NULL included.

    Spark broadcasts the code set if it is small by its own measure; else the
    join shuffles, and adaptive execution splits the common codes.
    """
    names = code_set.select(F.col(set_code).alias(code), F.col(meaning).alias("meaning"), F.lit(True).alias("_known"))
    joined = data.join(names, code, "left")
    return joined.withColumn("known", F.coalesce("_known", F.lit(False))).drop("_known")


def unknown_codes(decoded: DataFrame, code: str) -> DataFrame:
    return decoded.where(~F.col("known")).groupBy(code).agg(F.count(F.lit(1)).alias("n_rows"))


def cardinality_profile(a: DataFrame, a_on: list[str], b: DataFrame, b_on: list[str]) -> DataFrame:
    """One row: the measured row correspondence between two tables.

    Both sides shrink to one row per key before they meet, so a key with a
    third of the rows is just one row with a large count.
    """
    keys = [f"k{i}" for i in range(len(a_on))]
    left = a.groupBy(*[F.col(c).alias(k) for c, k in zip(a_on, keys)]).agg(F.count(F.lit(1)).alias("n_a"))
    right = b.groupBy(*[F.col(c).alias(k) for c, k in zip(b_on, keys)]).agg(F.count(F.lit(1)).alias("n_b"))
    both = left.join(right, keys, "full_outer")
    matched = F.col("n_a").isNotNull() & F.col("n_b").isNotNull()
    measured = both.agg(
        F.coalesce(F.max(F.when(matched, F.col("n_a") > 1)), F.lit(False)).alias("a_repeats"),
        F.coalesce(F.max(F.when(matched, F.col("n_b") > 1)), F.lit(False)).alias("b_repeats"),
        F.count_if(matched).alias("matched_keys"),
        F.count_if(F.col("n_b").isNull()).alias("keys_only_in_a"),
        F.count_if(F.col("n_a").isNull()).alias("keys_only_in_b"),
    )
    side = lambda flag: F.when(F.col(flag), "many").otherwise("one")
    return measured.select(
        F.concat(side("a_repeats"), F.lit("_to_"), side("b_repeats")).alias("cardinality"),
        "matched_keys", "keys_only_in_a", "keys_only_in_b",
    )


def _side(frame: DataFrame, rel: str, columns: list[str], is_a: bool) -> DataFrame:
    """(rel, key, side): a row for each row of one end of a relationship; rows with a NULL key match nothing."""
    whole = frame.where(reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in columns]))
    key = F.array(*[F.col(f"`{c}`").cast("string") for c in columns])
    return whole.select(F.lit(rel).alias("rel_key"), key.alias("key"), F.lit(is_a).alias("is_a"))


def cardinality_report(
    rels: list[tuple[str, str, list[str], str, list[str], str | None]], frames: dict[str, DataFrame], exact: bool = False
) -> DataFrame:
    """Every recorded relationship measured on the data, in one job, and compared with what is recorded.

    rels: key, first table, its columns, second table, its columns, recorded cardinality;
    one entry a relationship, like the frames it names. Per key both ends are counted in
    one grouped pass over all ends, so a key with a third of the rows is one number.

    First a sketch says which relationships may share a key at all: the hashes of both ends
    fall into `SKETCH` buckets, of which some are held by both. A relationship without such
    a bucket surely shares no key, and its keys are then not grouped. The numbers of keys
    on either side only of a relationship that shares no key are NULL, also where two keys
    fell into one bucket by chance, unless `exact` asks for them.

    status: `agrees`; `contradicted` (recorded `one` where the data have `many`); `narrower`
    (recorded `many`, never seen); `unrecorded`; `unknown value`; `no shared key` (nothing to
    measure). Empty tables share no key; keys are compared as text.
    """
    if not rels:
        raise ValueError("no relationships to measure")
    sides = []
    for rel, a, a_on, b, b_on, _ in rels:
        sides += [_side(frames[a], rel, a_on, True), _side(frames[b], rel, b_on, False)]
    ends = reduce(DataFrame.unionByName, sides)
    if exact:
        asked = ends
    else:
        bucket = F.pmod(F.xxhash64("key"), F.lit(SKETCH))
        sketch = ends.groupBy("rel_key", bucket.alias("bucket")).agg(
            F.bool_or("is_a").alias("in_a"), F.bool_or(~F.col("is_a")).alias("in_b")
        )
        likely = sketch.where("in_a and in_b").select("rel_key").distinct()
        asked = ends.join(F.broadcast(likely), "rel_key", "left_semi")  # one name a relationship
    per_key = asked.groupBy("rel_key", "key").agg(
        F.count_if("is_a").alias("n_a"), F.count_if(~F.col("is_a")).alias("n_b")
    )
    matched = (F.col("n_a") > 0) & (F.col("n_b") > 0)
    measured = per_key.groupBy("rel_key").agg(
        F.max(F.when(matched, F.col("n_a") > 1)).alias("a_many"), F.max(F.when(matched, F.col("n_b") > 1)).alias("b_many"),
        F.count_if(matched).alias("matched_keys"),
        F.count_if(F.col("n_b") == 0).alias("keys_only_in_a"), F.count_if(F.col("n_a") == 0).alias("keys_only_in_b"),
    )
    recorded = ends.sparkSession.createDataFrame([(r[0], r[1], r[3], r[5]) for r in rels], "rel_key string, table_a_id string, table_b_id string, recorded string")
    rows = recorded.join(measured, "rel_key", "left")
    kind = lambda flag: F.when(F.col(flag), "many").otherwise("one")
    shares = F.coalesce("matched_keys", F.lit(0)) > 0
    found = F.when(shares, F.concat(kind("a_many"), F.lit("_to_"), kind("b_many")))
    says = lambda at: F.split_part("recorded", F.lit("_to_"), F.lit(at))
    broken = (F.col("a_many") & (says(1) == "one")) | (F.col("b_many") & (says(2) == "one"))
    status = (
        F.when(~F.col("recorded").isin(*CARDINALITIES), "unknown value").when(~shares, "no shared key").when(F.col("recorded").isNull(), "unrecorded")
        .when(F.col("recorded") == found, "agrees").when(broken, "contradicted").otherwise("narrower")
    )
    return rows.select(
        "rel_key", "table_a_id", "table_b_id", "recorded", found.alias("measured"), status.alias("status"),
        F.coalesce("matched_keys", F.lit(0)).alias("matched_keys"),
        *[F.when(F.lit(exact) | shares, F.col(c)).alias(c) for c in ("keys_only_in_a", "keys_only_in_b")],
    )


def pending_validation(rels: DataFrame, maps: DataFrame) -> DataFrame:
    """Validated and open rows per source, for relationships and mappings.

    rels: table_a_id, validated. maps: source_column_id, validated.
    """
    both = rels.select(
        F.lit("relationship").alias("kind"), F.substring_index("table_a_id", ".", 1).alias("data_source_id"), "validated"
    ).union(
        maps.select(F.lit("mapping"), F.substring_index("source_column_id", ".", 1), "validated")
    )
    return both.groupBy("kind", "data_source_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("validated")).alias("n_pending")
    )
