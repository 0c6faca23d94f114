"""Queries on placements, venues, relationships and the relationship graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.operators import expand as D
from catalith.operators import graph as G
from catalith.operators import venues as W
from catalith.operators.references import orphan_references
from catalith.plans import views as V
from catalith.plans.hierarchy_queries import BRIEF
from catalith.plans.registry import query

PLACEMENT = (
    "table_id, system, data_source_id, physical_database_name, physical_schema_name, physical_table_name"
)
SCOPE = ["rule", "data_source_id", "system", "schema_name", "table_name"]
WITH = f"with {V.ENTRIES_SQL}"


def _inputs(spark, d):
    return V.placement_entries(spark, d), V.source_tables(spark, d), V.source_schemas(spark, d)


@query("expand_bare", f"{WITH} select {PLACEMENT} from expanded where form in (0, 1)")
def expand_bare(spark, d):
    entries, tables, _ = _inputs(spark, d)
    return D.expand_bare(entries, tables)


@query("expand_schema_rename", f"{WITH} select {PLACEMENT} from expanded where form = 2")
def expand_schema_rename(spark, d):
    entries, tables, _ = _inputs(spark, d)
    return D.expand_schema_rename(entries, tables)


@query("expand_exhaustive_map", f"{WITH} select {PLACEMENT} from expanded where form = 3")
def expand_exhaustive_map(spark, d):
    entries, tables, _ = _inputs(spark, d)
    return D.expand_exhaustive_map(entries, tables)


ZERO_SQL = (
    V.ENTRIES_SQL
    + """, zero as (
  select 'zero_entry' as rule, data_source_id, system, cast(null as varchar) as schema_name, cast(null as varchar) as table_name
  from entries where form in (0, 1) and data_source_id not in (select data_source_id from src_tables)
  union all select 'empty_schemas_map', data_source_id, system, null, null from entries where form = 5
  union all select 'zero_schema', data_source_id, system, 'bempty', null from entries where form = 6
  union all select 'zero_schema', data_source_id, system, 'b0', null from entries where form = 2
    and data_source_id not in (select data_source_id from src_tables where schema_name = 'b0'))"""
)


@query("zero_expansion", f"with {ZERO_SQL} select * from zero")
def zero_expansion(spark, d):
    return D.zero_expansion(*_inputs(spark, d))


UNKNOWN_SQL = """, unknown as (
  select 'unknown_schema' as rule, data_source_id, system, 'nope' as schema_name, cast(null as varchar) as table_name
  from entries where form = 4
  union all select 'unknown_table', data_source_id, system, 'b' || (first_part % 3), 'tghost' from entries where form = 3
  union all select 'unknown_table', e.data_source_id, e.system, 'b' || (first_part % 3), 't' || first_part from entries e
    where form = 3 and data_source_id not in (select data_source_id from src_tables))"""


@query("documented_exists", f"{WITH}{UNKNOWN_SQL} select * from unknown")
def documented_exists(spark, d):
    return D.documented_exists(*_inputs(spark, d))


@query(
    "physical_names",
    f"""{WITH} select 'physical_database_name' as rule, data_source_id, system, cast(null as varchar) as schema_name,
      cast(null as varchar) as table_name from entries where form = 6
    union all select 'physical_table_name', data_source_id, system, 'b' || (first_part % 3), 'tbad' from entries where form = 3""",
)
def physical_names(spark, d):
    return D.physical_names(V.placement_entries(spark, d))


@query(
    "deploys_nowhere",
    f"""{WITH} select 's' || s_suppkey as data_source_id,
      case when 's' || s_suppkey in (select data_source_id from entries)
        and 's' || s_suppkey not in (select data_source_id from src_tables) then 'no documented tables' else 'no usable entry' end
      as cause
    from supplier where 's' || s_suppkey not in (select data_source_id from expanded)""",
)
def deploys_nowhere(spark, d):
    entries, tables, _ = _inputs(spark, d)
    suppliers = V.table(spark, d, "supplier").select(F.concat(F.lit("s"), V.text("s_suppkey")).alias("data_source_id"))
    return D.deploys_nowhere(suppliers, D.expand_deployments(entries, tables), entries, tables)


@query(
    "suppress_cascade",
    f"""with {ZERO_SQL}{UNKNOWN_SQL}, found as (select * from zero union all select * from unknown
      union all select 'physical_table_name', data_source_id, system, 'b' || (first_part % 3), 'tbad' from entries where form = 3
      union all select 'physical_database_name', data_source_id, system, null, null from entries where form = 6),
    num as (select *, cast(substr(data_source_id, 2) as bigint) as s from found)
    select rule, data_source_id, system, schema_name, table_name from num
    where not (rule = 'unknown_schema' and s % 3 = 0)
      and not (rule = 'unknown_table' and ((s % 5 = 0 and table_name = 'tghost') or (s % 7 = 0 and schema_name = 'b1')))
      and not (rule = 'zero_schema' and ((s % 7 = 0 and schema_name = 'b1')
        or (s % 5 = 0 and schema_name in ('b0', 'b1', 'b2'))))
      and not (rule = 'zero_entry' and (s % 3 = 0 or s % 5 = 0 or s % 7 = 0))""",
)
def suppress_cascade(spark, d):
    entries, tables, schemas = _inputs(spark, d)
    scoped = (
        D.zero_expansion(entries, tables, schemas)
        .union(D.documented_exists(entries, tables, schemas))
        .union(D.physical_names(entries))
    )
    s = V.table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("s"), V.text("s_suppkey")).alias("data_source_id"))
    rejected_schemas = s.where(V.mod("s_suppkey", 3) == 0).withColumn("schema_name", F.lit("nope"))
    three = F.explode(F.array(F.lit("b0"), F.lit("b1"), F.lit("b2")))
    rejected_tables = (
        s.where(V.mod("s_suppkey", 5) == 0).withColumn("schema_name", three).withColumn("table_name", F.lit("tghost"))
    )
    broken = s.where(V.mod("s_suppkey", 7) == 0).withColumn("schema_name", F.lit("b1"))
    kept, _ = D.suppress_cascade(scoped, rejected_schemas, rejected_tables, broken)
    return kept


@query(
    "inventory_index",
    f"""{WITH} select s.data_source_id, s.schema_name, count(t.table_id) as n_tables from src_schemas s
    left join src_tables t on s.data_source_id = t.data_source_id and s.schema_name = t.schema_name group by 1, 2""",
)
def inventory_index(spark, d):
    _, tables, schemas = _inputs(spark, d)
    return D.inventory_index(schemas, tables)


# --- venues ---------------------------------------------------------------------


@query("venue_sets", f"with {V.PLACED_SQL} select table_id, system from placed")
def venue_sets(spark, d):
    return W.venue_sets(V.placed(spark, d))


@query(
    "pair_codeployed",
    f"""with {V.RELATIONSHIPS_SQL}, {V.PLACED_SQL}, {V.DOC_TABLES_SQL}
    select 'pair_codeployed' as rule, rel_key as object_key, table_a_id || ' and ' || table_b_id as detail from relationships r
    where table_a_id in (select table_id from doc_tables) and table_b_id in (select table_id from doc_tables)
      and not exists (select 1 from placed x join placed y on x.system = y.system
                      where x.table_id = r.table_a_id and y.table_id = r.table_b_id)""",
)
def pair_codeployed(spark, d):
    return W.pair_codeployed(
        V.relationships(spark, d), "table_a_id", "table_b_id", "rel_key", V.placed(spark, d), V.doc_tables(spark, d)
    ).select(*BRIEF)


@query(
    "nway_codeployed",
    f"""with {V.EXPRESSION_TABLES_SQL}, {V.PLACED_SQL}, {V.DOC_TABLES_SQL},
    sized as (select expr_key, count(*) as n, count(*) filter (where table_id not in (select table_id from doc_tables)) as unknown
      from expr_tables group by 1),
    full_sets as (select e.expr_key, p.system, count(*) as have from expr_tables e join placed p on e.table_id = p.table_id group by 1, 2)
    select 'nway_codeployed' as rule, s.expr_key as object_key, n || ' table(s) share no system' as detail from sized s
    where unknown = 0 and not exists (select 1 from full_sets f where f.expr_key = s.expr_key and f.have = s.n)""",
)
def nway_codeployed(spark, d):
    return W.nway_codeployed(
        V.expression_tables(spark, d), "tables", "expr_key", V.placed(spark, d), V.doc_tables(spark, d)
    ).select(*BRIEF)


@query(
    "resolve_address",
    f"""with {V.DEPLOYMENTS_SQL} select t.table_id, physical_database_name, physical_schema_name, physical_table_name,
    case when physical_table_name is null then 'not deployed' else 'ok' end as status
    from part_tables t left join deployments d on t.table_id = d.table_id and d.system = 'sys3'""",
)
def resolve_address(spark, d):
    return W.resolve_address(V.part_tables(spark, d), V.deployments(spark, d), "sys3")


@query(
    "venue_inventory",
    f"""with {V.DEPLOYMENTS_SQL} select system, data_source_id, count(*) as n_tables from deployments group by 1, 2""",
)
def venue_inventory(spark, d):
    return W.venue_inventory(V.deployments(spark, d))


@query(
    "subtree_venues",
    f"""with {V.DEPLOYMENTS_SQL} select distinct system from deployments
    where table_id = 'wh.bbrand1' or starts_with(table_id, 'wh.bbrand1.')""",
)
def subtree_venues(spark, d):
    return W.subtree_venues(V.deployments(spark, d), "wh.bbrand1")


@query(
    "joins_in_venue",
    f"""with {V.RELATIONSHIPS_SQL}, {V.PLACED_SQL} select rel_key, x.system from relationships
    join placed x on x.table_id = table_a_id join placed y on y.table_id = table_b_id and y.system = x.system""",
)
def joins_in_venue(spark, d):
    return W.joins_in_venue(V.relationships(spark, d), "table_a_id", "table_b_id", "rel_key", V.placed(spark, d))


@query(
    "relationships_of",
    f"""with {V.RELATIONSHIPS_SQL} select table_a_id as table_id, table_b_id as other_table_id, relationship_name,
      'on ' || rel_key as join_condition, cardinality from relationships where table_a_id = 'wh.parts.t7'
    union all select table_b_id, table_a_id, relationship_name, 'on ' || rel_key,
      case cardinality when 'one_to_many' then 'many_to_one' when 'many_to_one' then 'one_to_many'
        when 'one_to_one' then 'one_to_one' when 'many_to_many' then 'many_to_many' end
    from relationships where table_b_id = 'wh.parts.t7' and table_a_id <> 'wh.parts.t7'""",
)
def relationships_of(spark, d):
    rels = V.relationships(spark, d).withColumn("join_condition", F.concat(F.lit("on "), "rel_key"))
    return W.relationships_of(rels, "wh.parts.t7")


# --- the relationship graph -------------------------------------------------------


def _edges(spark, d):
    """Every part of an order and the order's smallest part of the same brand: so the graph has several components."""
    parts = V.table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = V.table(spark, d, "lineitem").select("l_orderkey", "l_partkey").distinct().join(parts, "l_partkey")
    firsts = lines.groupBy("l_orderkey", "p_brand").agg(F.min("l_partkey").alias("a"))
    pairs = lines.join(firsts, ["l_orderkey", "p_brand"]).where(F.col("a") != F.col("l_partkey"))
    return pairs.select("a", F.col("l_partkey").alias("b"))


EDGES_SQL = """branded as (select distinct l_orderkey, l_partkey, p_brand from lineitem join part on l_partkey = p_partkey),
firsts as (select l_orderkey, p_brand, min(l_partkey) as a from branded group by 1, 2),
edges as (select distinct a, l_partkey as b from branded join firsts using (l_orderkey, p_brand) where a <> l_partkey),
both_ways as (select a, b from edges union select b, a from edges),
components(node, component) using key (node) as (
  select distinct a, a from both_ways
  union
  select e.b, min(c.component) from components c join both_ways e on e.a = c.node join recurring.components r on r.node = e.b
  where c.component < r.component group by e.b)"""


@query("connected_components", f"with recursive {EDGES_SQL} select node, component from components")
def connected_components(spark, d):
    return G.connected_components(_edges(spark, d), "a", "b")


@query("updated_components", f"with recursive {EDGES_SQL} select node, component from components")
def updated_components(spark, d):
    """The same graph, reached from another one: some edges are taken out of it, others come in."""
    after = _edges(spark, d).distinct()
    gone = V.mod(F.xxhash64("a", "b"), 50) == 0
    # Before: without one edge in fifty, and with others that joined neighbouring brands.
    extra = after.where(V.mod(F.xxhash64("b"), 40) == 0).select("a", (F.col("b") + 1).alias("b"))
    extra = extra.join(after, ["a", "b"], "left_anti").distinct()
    before = after.where(~gone).unionByName(extra)
    labels = G.connected_components(before, "a", "b")
    return G.updated_components(labels, after, "a", "b", inserted=after.where(gone), deleted=extra)


@query(
    "linkable_tables",
    f"""with recursive {EDGES_SQL}, {V.EXPRESSION_TABLES_SQL}, {V.DOC_TABLES_SQL},
    placed_in as (select expr_key, e.table_id, coalesce('wh.parts.t' || component, e.table_id) as home
      from expr_tables e left join components c on e.table_id = 'wh.parts.t' || node),
    judged as (select expr_key, count(*) as n, min(home) as low, max(home) as high,
      count(*) filter (where table_id not in (select table_id from doc_tables)) as unknown from placed_in group by 1)
    select 'linkable_tables' as rule, expr_key as object_key, low || ' and ' || high as detail from judged
    where n > 1 and unknown = 0 and low <> high""",
)
def linkable_tables(spark, d):
    found = G.connected_components(_edges(spark, d), "a", "b")
    named = found.select(
        F.concat(F.lit("wh.parts.t"), V.text("node")).alias("node"),
        F.concat(F.lit("wh.parts.t"), V.text("component")).alias("component"),
    )
    return G.linkable_tables(
        V.expression_tables(spark, d), "tables", "expr_key", named, V.doc_tables(spark, d)
    ).select(*BRIEF)


@query(
    "deployment_references",
    f"""with {V.PLACED_SQL}, {V.DOC_TABLES_SQL} select 'orphan_references' as rule, table_id || '|' || system as object_key,
    table_id as detail from placed where table_id not in (select table_id from doc_tables)""",
)
def deployment_references(spark, d):
    key = F.concat_ws("|", "table_id", "system")
    return orphan_references(
        V.placed(spark, d), "table_id", V.doc_tables(spark, d), "table_id", "deployment_tables", key
    ).select(*BRIEF)
