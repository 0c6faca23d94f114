"""Queries over dotted ids, labels and concepts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.functions import paths
from catalith.operators import hierarchy as H
from catalith.operators import invariants as B
from catalith.operators import references as R
from catalith.operators import shape as P
from catalith.plans import views as V
from catalith.plans.registry import query

BRIEF = ("rule", "object_key", "detail")


@query(
    "compose_id",
    f"with {V.IDS_SQL} select o_orderkey, case when o_orderkey % 11 <> 0 then column_id end as id from ids",
)
def compose_id(spark, d):
    parts = V.ids(spark, d).withColumn("last", F.when(V.mod("o_orderkey", 11) != 0, F.col("column_name")))
    return parts.select("o_orderkey", paths.compose_id("table_id", "last").alias("id"))


@query(
    "split_id",
    f"with {V.IDS_SQL} select column_id, schema_id as owner, data_source_id as database_name,"
    " string_split(schema_id, '.')[2] as schema_name from ids",
)
def split_id(spark, d):
    owner = paths.leading("column_id", 2)
    return V.ids(spark, d).select(
        "column_id", owner.alias("owner"), paths.leading(owner, 1).alias("database_name"), paths.leaf(owner).alias("schema_name")
    )


LABELS_SQL = """
labels_in as (
  select c_custkey, case c_custkey % 5 when 0 then c_name when 1 then lower(replace(c_name, '#', '_'))
         when 2 then replace(c_name, '#', '-') when 3 then '' else repeat('x', 250 + c_custkey % 10) end as label from customer)
"""


@query(
    "check_label",
    f"""with {LABELS_SQL} select cast(c_custkey as varchar) as object_key,
    case when label = '' then 'empty' when length(label) > 255 then 'too_long'
         when regexp_full_match(label, '[a-z0-9_-]+') then 'ok'
         when regexp_full_match(lower(label), '[a-z0-9_-]+') then 'not_lowercase' else 'illegal_characters' end as status,
    case when length(label) <= 255 and not regexp_full_match(label, '[a-z0-9_-]+')
          and regexp_full_match(lower(label), '[a-z0-9_-]+') then lower(label) end as suggestion,
    case when label <> '' and length(label) <= 255 and not regexp_full_match(lower(label), '[a-z0-9_-]+')
         then array_to_string(list_sort(list_distinct(regexp_extract_all(label, '[^a-z0-9_-]'))), '') end as bad_chars
    from labels_in""",
)
def check_label(spark, d):
    c = V.table(spark, d, "customer")
    m = V.mod("c_custkey", 5)
    label = (
        F.when(m == 0, F.col("c_name"))
        .when(m == 1, F.lower(F.replace("c_name", F.lit("#"), F.lit("_"))))
        .when(m == 2, F.replace("c_name", F.lit("#"), F.lit("-")))
        .when(m == 3, "")
        .otherwise(F.repeat(F.lit("x"), (F.lit(250) + V.mod("c_custkey", 10)).cast("int")))
    )
    return H.label_report(c.withColumn("label", label), "label", V.text("c_custkey"))


@query(
    "descendants_of",
    f"with {V.IDS_SQL} select column_id from ids where column_id = 'asia.nation_2' or starts_with(column_id, 'asia.nation_2.')",
)
def descendants_of(spark, d):
    return H.descendants_of(V.ids(spark, d), "column_id", "asia.nation_2").select("column_id")


@query(
    "ancestors_of",
    f"with {V.IDS_SQL} select column_id, unnest([data_source_id, schema_id, table_id, column_id]) as ancestor from ids",
)
def ancestors_of(spark, d):
    return H.ancestors_of(V.ids(spark, d), "column_id").select("column_id", "ancestor")


@query(
    "descendants_of_many",
    f"""with {V.IDS_SQL}, tops as (select schema_id as top from schemas union select table_id from tables where c_custkey % 3 = 0 union select 'asia' union select 'no.such')
    select column_id, top from ids join tops on column_id = top or starts_with(column_id, top || '.')""",
)
def descendants_of_many(spark, d):
    tops = V.schemas(spark, d).select(F.col("schema_id").alias("top"))
    tops = tops.union(V.tables(spark, d).where(V.mod("c_custkey", 3) == 0).select("table_id"))
    tops = tops.union(spark.createDataFrame([("asia",), ("no.such",)], "top string"))
    return H.descendants_of_many(V.ids(spark, d), "column_id", tops, "top", ["column_id"]).select("column_id", "top")


@query(
    "path_match_many",
    f"""with {V.CONCEPTS_SQL},
    patterns as (
      select schema_id || '.*.concept.*' as pattern from schemas union select '*.' || schema_name || '.concept.*' from schemas
      union select table_id || '.*' from tables where c_custkey % 5 = 0 union select '*.' || table_name || '.*.concept.*' from tables where c_custkey % 7 = 0
      union select data_source_id || '.*.concept.k' || (r_regionkey + 1) from sources union select 'asia.*.*.*' union select 'no.such.*'),
    rules as (select pattern, '^' || replace(replace(replace(pattern || '.', '*.', '@'), '.', '[.]'), '@', '([^.]+[.])*') || '$' as rule from patterns)
    select concept_id, pattern from concepts, rules where regexp_matches(concept_id || '.', rule)""",
)
def path_match_many(spark, d):
    """Concepts under each of many patterns, of which some begin with a fixed label and some with a star."""
    schemas, tables = V.schemas(spark, d), V.tables(spark, d)
    star = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("pattern")
    patterns = [
        schemas.select(star(F.col("schema_id"), ".*.concept.*")), schemas.select(star("*.", F.col("schema_name"), ".concept.*")),
        tables.where(V.mod("c_custkey", 5) == 0).select(star(F.col("table_id"), ".*")),
        tables.where(V.mod("c_custkey", 7) == 0).select(star("*.", F.col("table_name"), ".*.concept.*")),
        V.sources(spark, d).select(star(F.col("data_source_id"), ".*.concept.k", V.text(F.col("r_regionkey") + 1))),
        spark.createDataFrame([("asia.*.*.*",), ("no.such.*",)], "pattern string"),
    ]
    wanted = patterns[0]
    for p in patterns[1:]:
        wanted = wanted.union(p)
    return H.path_match_many(V.concepts(spark, d).select("concept_id"), "concept_id", wanted, "pattern").select("concept_id", "pattern")


@query(
    "path_match",
    f"with {V.CONCEPTS_SQL} select concept_id from concepts where starts_with(concept_id, 'asia.') and concept_id like '%.concept.%'",
)
def path_match(spark, d):
    return H.path_match(V.concepts(spark, d), "concept_id", "asia.*.concept.*").select("concept_id")


@query(
    "array_descendants",
    f"""with {V.CONCEPTS_SQL} select concept_id from concepts
    where len(list_filter(related_object_ids, lambda x: x = 'europe' or starts_with(x, 'europe.'))) > 0""",
)
def array_descendants(spark, d):
    return H.array_descendants(V.concepts(spark, d), "related_object_ids", "europe").select("concept_id")


@query(
    "array_contains_exact",
    f"""with {V.CONCEPTS_SQL} select concept_id from concepts
    where list_contains(related_object_ids, 'asia') or list_contains(related_object_ids, 'asia.nation_2')""",
)
def array_contains_exact(spark, d):
    return H.array_contains_exact(V.concepts(spark, d), "related_object_ids", ["asia", "asia.nation_2"]).select(
        "concept_id"
    )


@query(
    "path_functions",
    f"""with {V.IDS_SQL} select column_id, cast(4 as bigint) as n_labels, schema_id as leading_two, column_name as leaf,
    table_id as parent, array_to_string(list_slice(string_split(column_id, '.'), 2, 3), '.') as middle,
    array_to_string(list_slice(string_split(column_id, '.'), 3, 4), '.') as last_two from ids""",
)
def path_functions(spark, d):
    return H.path_functions(V.ids(spark, d), "column_id")


@query(
    "subtree_counts",
    f"""with {V.IDS_SQL}, up as (select unnest([data_source_id, schema_id, table_id, column_id]) as ancestor from ids)
    select ancestor, count(*) as n from up group by ancestor""",
)
def subtree_counts(spark, d):
    return H.subtree_counts(V.ids(spark, d), "column_id")


@query(
    "concepts_about",
    f"""with {V.CONCEPTS_SQL} select distinct concept_id from (
    select concept_id from concepts where concept_id = 'africa' or starts_with(concept_id, 'africa.')
    union all select concept_id from (select concept_id, unnest(related_object_ids) as x from concepts)
    where x = 'africa' or starts_with(x, 'africa.'))""",
)
def concepts_about(spark, d):
    return H.concepts_about(V.concepts(spark, d), "africa").select("concept_id")


@query(
    "leaf_name",
    f"""with {V.IDS_SQL} select 'leaf_name' as rule, column_id as object_key, 'x' || o_orderkey as detail
    from ids where o_orderkey % 19 = 0""",
)
def leaf_name(spark, d):
    wrong = F.when(V.mod("o_orderkey", 19) == 0, F.concat(F.lit("x"), V.text("o_orderkey"))).otherwise(F.col("column_name"))
    return B.leaf_name(V.ids(spark, d).withColumn("name", wrong), "column_id", "name", "columns").select(*BRIEF)


@query(
    "lowercase_identity",
    """select 'lowercase_identity' as rule, cast(c_custkey as varchar) as object_key, 'c_name=' || c_name as detail
    from customer where c_name <> lower(c_name)
    union all select 'lowercase_identity', cast(c_custkey as varchar), 'c_mktsegment=' || c_mktsegment
    from customer where c_mktsegment <> lower(c_mktsegment)""",
)
def lowercase_identity(spark, d):
    c = V.table(spark, d, "customer")
    return B.lowercase_identity(c, ["c_name", "c_mktsegment"], "customer", V.text("c_custkey")).select(*BRIEF)


@query(
    "prefix_redundancy",
    f"""with {V.IDS_SQL} select 'prefix_redundancy' as rule, column_id as object_key, 'wrong.' || schema_id as detail
    from ids where o_orderkey % 23 = 0""",
)
def prefix_redundancy(spark, d):
    stored = F.when(V.mod("o_orderkey", 23) == 0, F.concat(F.lit("wrong."), "schema_id")).otherwise(F.col("schema_id"))
    rows = V.ids(spark, d).withColumn("stored", stored)
    return R.prefix_redundancy(rows, "column_id", "stored", 2, "columns").select(*BRIEF)


@query(
    "reserved_names",
    """select 'reserved_names' as rule, cast(o_orderkey as varchar) as object_key,
    case o_orderkey % 20 when 0 then 'concept' else 'tables' end as detail from orders where o_orderkey % 20 in (0, 7)""",
)
def reserved_names(spark, d):
    m = V.mod("o_orderkey", 20)
    name = F.when(m == 0, "concept").when(m == 7, "tables").otherwise(F.concat(F.lit("t"), V.text("o_orderkey")))
    rows = V.table(spark, d, "orders").select("o_orderkey", name.alias("name"))
    reserved = (paths.RESERVED_CONCEPT, *paths.SHARD_FOLDERS)
    return P.reserved_names(rows, "name", reserved, "tables", V.text("o_orderkey")).select(*BRIEF)


@query(
    "prefix_agreement",
    f"""with {V.IDS_SQL} select 'prefix_agreement' as rule, column_id as object_key, schema_id || ' vs elsewhere.x' as detail
    from ids where o_orderkey % 29 = 0""",
)
def prefix_agreement(spark, d):
    owner = F.when(V.mod("o_orderkey", 29) == 0, "elsewhere.x").otherwise(F.col("schema_id"))
    rows = V.ids(spark, d).withColumn("owner", owner)
    return P.prefix_agreement(rows, "table_id", "owner", "columns", F.col("column_id")).select(*BRIEF)


@query(
    "ref_shape",
    f"""with {V.IDS_SQL} select 'ref_shape' as rule, column_id as object_key,
    case o_orderkey % 4 when 0 then schema_id when 1 then upper(table_id) else column_id end as detail
    from ids where o_orderkey % 4 in (0, 1, 2)""",
)
def ref_shape(spark, d):
    m = V.mod("o_orderkey", 4)
    pointer = (
        F.when(m == 0, F.col("schema_id")).when(m == 1, F.upper("table_id")).when(m == 2, F.col("column_id"))
        .when(V.mod("o_orderkey", 8) == 3, F.col("table_id"))
    )
    return P.ref_shape(V.ids(spark, d).withColumn("p", pointer), "p", "columns", F.col("column_id")).select(*BRIEF)


# Concept names by form, and what is wrong with each in a schema file and in a source file.
CONCEPT_NAMES = {
    0: ("concept.k", None, None),
    1: ("t.concept.k", None, "anchor_in_source_file"),
    2: ("t.c.concept.k", None, "anchor_in_source_file"),
    3: (".concept.k", "leading_dot", "leading_dot"),
    4: ("concept.k.", "trailing_dot", "trailing_dot"),
    5: ("a..concept.k", "double_dot", "double_dot"),
    6: ("A.concept.k", "illegal_label", "illegal_label"),
    7: ("a.b", "no_concept_label", "no_concept_label"),
    8: ("concept.concept.k", "concept_label_repeated", "concept_label_repeated"),
    9: ("a.concept", "concept_label_last", "concept_label_last"),
    10: ("concept.a.k", "concept_label_misplaced", "concept_label_misplaced"),
    11: ("t.c.x.concept.k", "anchor_too_deep", "anchor_in_source_file"),
    12: ("concept", "concept_label_last", "concept_label_last"),
}


def _by_form(column: str, values: dict[int, str | None]) -> str:
    cases = " ".join(f"when {i} then '{v}'" for i, v in values.items() if v is not None)
    return f"case {column} {cases} end"


@query(
    "concept_name_grammar",
    f"""with named as (select o_orderkey, case when o_custkey % 2 = 0
      then {_by_form("o_orderkey % 13", {i: v[1] for i, v in CONCEPT_NAMES.items()})}
      else {_by_form("o_orderkey % 13", {i: v[2] for i, v in CONCEPT_NAMES.items()})} end as reason from orders)
    select 'concept_name_grammar' as rule, cast(o_orderkey as varchar) as object_key, reason as detail
    from named where reason is not null""",
)
def concept_name_grammar(spark, d):
    names = F.create_map(*[F.lit(x) for i, v in CONCEPT_NAMES.items() for x in (i, v[0])])
    in_schema = V.mod("o_custkey", 2) == 0
    rows = V.table(spark, d, "orders").select(
        "o_orderkey",
        F.element_at(names, V.mod("o_orderkey", 13).cast("int")).alias("name"),
        F.when(in_schema, "src.sch").otherwise("src").alias("prefix"),
        F.when(in_schema, "sch").alias("schema_name"),
    )
    return P.concept_name_grammar(rows, "name", "prefix", "schema_name", V.text("o_orderkey")).select(*BRIEF)


@query(
    "concept_shape",
    f"""with {V.CONCEPTS_SQL}, shaped as (select o_orderkey, case when o_orderkey % 5 = 0
      then replace(concept_id, '.concept.', '.') else concept_id end as cid from concepts)
    select 'concept_shape' as rule, cid as object_key, cast(len(string_split(cid, '.')) as varchar) as detail from shaped
    where not (len(string_split(cid, '.')) between 3 and 6 and string_split(cid, '.')[-2] = 'concept')""",
)
def concept_shape(spark, d):
    bad = F.replace("concept_id", F.lit(".concept."), F.lit("."))
    cid = F.when(V.mod("o_orderkey", 5) == 0, bad).otherwise(F.col("concept_id"))
    return B.concept_shape(V.concepts(spark, d).withColumn("cid", cid), "cid").select(*BRIEF)


@query(
    "array_entry_checks",
    f"""with {V.CONCEPTS_SQL}
    select 'array_duplicate_entry' as rule, concept_id as object_key, column_id as detail from concepts where o_orderkey % 3 = 1
    union all select 'array_self_reference', concept_id, concept_id from concepts where o_orderkey % 3 = 2""",
)
def array_entry_checks(spark, d):
    rows = V.concepts(spark, d)
    return P.array_entry_checks(rows, "related_object_ids", "concept_id", "concepts", F.col("concept_id")).select(*BRIEF)


@query(
    "array_reference",
    f"""with {V.CONCEPTS_SQL}, spaces as (select data_source_id as x from sources union select schema_id from schemas
      union select table_id from tables union select column_id from ids union select concept_id from concepts),
    entries as (select concept_id, unnest(related_object_ids) as x from concepts)
    select 'array_reference' as rule, concept_id as object_key, x as detail from entries
    where x not in (select x from spaces)""",
)
def array_reference(spark, d):
    c = V.concepts(spark, d)
    spaces = [
        (V.sources(spark, d), "data_source_id"),
        (V.schemas(spark, d), "schema_id"),
        (V.tables(spark, d), "table_id"),
        (V.ids(spark, d), "column_id"),
        (c, "concept_id"),
    ]
    return R.array_reference(c, "related_object_ids", F.col("concept_id"), spaces, "concepts").select(*BRIEF)


@query(
    "anchor_reference",
    f"""with {V.CONCEPTS_SQL}, anchors as (select concept_id, len(string_split(concept_id, '.')) - 2 as depth,
      array_to_string(list_slice(string_split(concept_id, '.'), 1, len(string_split(concept_id, '.')) - 2), '.') as anchor
      from concepts),
    spaces as (select data_source_id as x, 1 as depth from sources union all select schema_id, 2 from schemas
      union all select table_id, 3 from tables union all select column_id, 4 from ids)
    select 'anchor_reference' as rule, concept_id as object_key,
      case when depth > 4 then 'too deep: ' || anchor else anchor end as detail
    from anchors a where not exists (select 1 from spaces s where s.x = a.anchor and s.depth = a.depth)""",
)
def anchor_reference(spark, d):
    spaces = [
        (V.sources(spark, d), "data_source_id"),
        (V.schemas(spark, d), "schema_id"),
        (V.tables(spark, d), "table_id"),
        (V.ids(spark, d), "column_id"),
    ]
    return R.anchor_reference(V.concepts(spark, d), "concept_id", spaces).select(*BRIEF)
