"""Queries on expression text: references, determinism, shape and translation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.functions import expressions as E
from catalith.operators import lineage as L
from catalith.plans import views as V
from catalith.plans.hierarchy_queries import BRIEF
from catalith.plans.registry import query

WITH = f"with {V.EXPRESSIONS_SQL}"
WITH_REFS = f"with {V.REFS_SQL}"
TABLE_OF = "array_to_string(list_slice(string_split(ref, '.'), 1, 3), '.')"
HINTED = [*BRIEF, "hint"]


@query(
    "column_refs",
    f"""{WITH_REFS} select expr_key, cast(pos as bigint) as pos, ref, cast(len(string_split(ref, '.')) as bigint) as n_parts,
    {TABLE_OF} as table_id from refs""",
)
def column_refs(spark, d):
    out = L.column_refs(V.expressions(spark, d), "expr", "expr_key")
    return out.withColumns({"pos": F.col("pos").cast("bigint"), "n_parts": F.col("n_parts").cast("bigint")})


@query(
    "under_qualified",
    f"""{WITH} select 'column_refs' as rule, expr_key as object_key,
    case form when 3 then 'sales.t1.c1' when 4 then 'pre.' || a || '.c1' when 6 then a || ',q'
              when 11 then 'log' when 16 then 'date' end as detail from expressions where form in ({V.BADLY_QUALIFIED_FORMS})""",
)
def under_qualified(spark, d):
    return L.under_qualified(V.expressions(spark, d), "expr", "expr_key", "column_mappings").select(*BRIEF)


@query(
    "tables_referenced",
    f"""{WITH_REFS}, t as (select expr_key, array_to_string(list_sort(list_distinct(list({TABLE_OF}))), ',') as tables
      from refs group by expr_key)
    select e.expr_key, coalesce(t.tables, '') as tables from expressions e left join t on e.expr_key = t.expr_key""",
)
def tables_referenced(spark, d):
    out = L.tables_referenced(V.expressions(spark, d), "expr", "tables")
    return out.select("expr_key", F.array_join("tables", ",").alias("tables"))


@query(
    "refs_resolve",
    f"""{WITH_REFS}, {V.COLUMNS_SQL}
    select 'refs_resolve' as rule, expr_key as object_key, ref as detail,
      case when form = 7 and lower(ref) in (select column_id from doc_columns) then lower(ref) end as hint
    from refs where ref not in (select column_id from doc_columns)""",
)
def refs_resolve(spark, d):
    return L.refs_resolve(
        V.expressions(spark, d), "expr", "expr_key", V.doc_columns(spark, d), "column_id", "column_mappings"
    ).select(*HINTED)


@query(
    "endpoint_membership",
    f"""{WITH_REFS} select distinct 'endpoint_membership' as rule, expr_key as object_key, {TABLE_OF} as detail
    from refs where {TABLE_OF} <> a and {TABLE_OF} <> b""",
)
def endpoint_membership(spark, d):
    return L.endpoint_membership(V.expressions(spark, d), "expr", "a", "b", F.col("expr_key")).select(*BRIEF)


@query(
    "endpoint_coverage",
    f"""{WITH_REFS}, seen as (select expr_key, list({TABLE_OF}) as t from refs group by 1),
    gaps as (select e.expr_key, array_to_string(list_sort(list_filter([e.a, e.b], lambda x: not list_contains(coalesce(t, []), x))), ',')
      as missing from expressions e left join seen s on e.expr_key = s.expr_key where e.a <> e.b)
    select 'endpoint_coverage' as rule, expr_key as object_key, missing as detail from gaps where missing <> ''""",
)
def endpoint_coverage(spark, d):
    return L.endpoint_coverage(V.expressions(spark, d), "expr", "a", "b", F.col("expr_key")).select(*BRIEF)


@query(
    "no_refs",
    f"{WITH} select 'no_refs' as rule, expr_key as object_key, expr as detail from expressions where form = 12",
)
def no_refs(spark, d):
    return L.no_refs(V.expressions(spark, d), "expr", F.col("expr_key"), "column_mappings").select(*BRIEF)


@query(
    "self_reference",
    f"""{WITH_REFS}, {V.COLUMNS_SQL} select distinct 'self_reference' as rule, expr_key as object_key, ref as detail from refs
    where {TABLE_OF} = b and ref in (select column_id from doc_columns)""",
)
def self_reference(spark, d):
    rows = V.expressions(spark, d).withColumn("source_column_id", F.concat("b", F.lit(".c9")))
    return L.self_reference(
        rows, "expr", "source_column_id", "expr_key", V.doc_columns(spark, d), "column_id"
    ).select(*BRIEF)


@query(
    "volatile_functions",
    f"""{WITH} select expr_key, case when expr is not null then case form when 5 then 'current_date,now' when 17 then 'now' else '' end end as found
    from expressions""",
)
def volatile_functions(spark, d):
    return V.expressions(spark, d).select(
        "expr_key", F.array_join(E.volatile_functions(F.col("expr")), ",").alias("found")
    )


@query(
    "navigation_kind",
    f"""{WITH} select expr_key, case form when 6 then 'subquery' when 11 then 'multiple statements' end as kind
    from expressions""",
)
def navigation_kind(spark, d):
    return V.expressions(spark, d).select("expr_key", E.navigation_kind(F.col("expr")).alias("kind"))


@query(
    "is_predicate",
    f"""{WITH} select expr_key, case when expr is not null then form in (0, 3, 4, 5, 7, 10, 13, 14, 15, 16, 17) end as is_predicate
    from expressions""",
)
def is_predicate(spark, d):
    return V.expressions(spark, d).select("expr_key", E.is_predicate(F.col("expr")).alias("is_predicate"))


@query(
    "translate_expression",
    f"""{WITH_REFS}, {V.PLACED_SQL}, there as (select table_id from placed where system = 'sys2'),
    used as (select distinct expr_key, {TABLE_OF} as table_id from refs),
    lost as (select expr_key, count(*) filter (where table_id not in (select table_id from there)) as n from used group by 1)
    select e.expr_key, case when coalesce(n, 0) > 0 then null when form = 6 then expr
        else replace(replace(expr, a || '.', 'db2.parts.p_' || l_partkey || '.'), b || '.', 'db2.parts.p_' || (l_suppkey * 7) || '.')
      end as physical_expr, cast(coalesce(n, 0) as bigint) as n_missing
    from expressions e left join lost on e.expr_key = lost.expr_key""",
)
def translate_expression(spark, d):
    return L.translate_expression(V.expressions(spark, d), "expr", "expr_key", V.placed(spark, d), "sys2")


@query(
    "expression_rules",
    f"""{WITH} select 'volatile_functions' as rule, expr_key as object_key, case form when 5 then 'current_date,now' else 'now' end as detail
      from expressions where form in (5, 17)
    union all select 'navigation_kind', expr_key, case form when 6 then 'subquery' else 'multiple statements' end
      from expressions where form in (6, 11)
    union all select 'is_predicate', expr_key, expr from expressions where form in (1, 2, 6, 8, 11, 12, 18)""",
)
def expression_rules(spark, d):
    return L.expression_rules(V.expressions(spark, d), "expr", F.col("expr_key"), "table_relationships", True).select(*BRIEF)
