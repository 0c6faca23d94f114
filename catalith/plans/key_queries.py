"""Queries for row shape, uniqueness and references on the order data."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.operators import keys as K
from catalith.operators import references as R
from catalith.operators import shape as P
from catalith.plans import views as V
from catalith.plans.hierarchy_queries import BRIEF
from catalith.plans.registry import query
from catalith.specs import RECOGNISED_KEYS

BRIEF_HINT = (*BRIEF, "hint")


@query(
    "unknown_keys",
    """select 'unknown_keys' as rule, cast(o_orderkey as varchar) as object_key,
    case when o_orderkey % 15 = 0 then 'descripton,zzz' when o_orderkey % 3 = 0 then 'descripton' else 'zzz' end as detail
    from orders where o_orderkey % 3 = 0 or o_orderkey % 5 = 0""",
)
def unknown_keys(spark, d):
    k = "o_orderkey"
    typo = F.when(V.mod(k, 3) == 0, "descripton").otherwise("description")
    extra = F.when(V.mod(k, 5) == 0, "zzz").otherwise("notes")
    keys = F.array(extra, F.lit("owner"), typo)
    body = F.map_from_arrays(keys, F.array(F.lit("1"), F.lit("2"), F.lit("3")))
    rows = V.table(spark, d, "orders").select(k, body.alias("body"))
    return P.unknown_keys(rows, "body", RECOGNISED_KEYS["data_source"], "data_source", V.text(k)).select(*BRIEF)


def _turns(spark, d):
    """Conversation turns with some missing and some blank fields."""
    m = V.mod("turn", 3)
    return V.table(spark, d, "conversations").select(
        F.concat_ws("|", V.text("conv_id"), V.text("turn")).alias("key"),
        F.when(V.mod("conv_id", 4) != 0, F.col("role")).alias("role"),
        F.when(m == 0, F.col("text")).when(m == 1, "  \t").otherwise(F.lit(None)).alias("text"),
    )


TURNS_SQL = """turns as (select conv_id || '|' || turn as key, case when conv_id % 4 <> 0 then role end as role,
  turn % 3 as m from conversations)"""


@query(
    "required_fields",
    f"""with {TURNS_SQL} select 'required_fields' as rule, key as object_key, 'role' as detail from turns where role is null
    union all select 'required_fields', key, 'text' from turns where m <> 0""",
)
def required_fields(spark, d):
    return P.required_fields(_turns(spark, d), ["role", "text"], "turn", F.col("key")).select(*BRIEF)


@query(
    "optional_text",
    f"with {TURNS_SQL} select 'optional_text' as rule, key as object_key, 'text' as detail from turns where m = 1",
)
def optional_text(spark, d):
    return P.optional_text(_turns(spark, d), ["role", "text"], "turn", F.col("key")).select(*BRIEF)


@query(
    "default_flag",
    f"""with {V.RELATIONSHIPS_SQL} select rel_key,
    case when l_orderkey % 5 = 0 then false else validated end as validated from relationships""",
)
def default_flag(spark, d):
    flag = F.when(V.mod("l_orderkey", 5) != 0, F.col("validated"))
    return P.default_flag(V.relationships(spark, d).withColumn("validated", flag), ["validated"]).select(
        "rel_key", "validated"
    )


LINES_SQL = """lines as (select *, dense_rank() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey,
  l_shipdate, l_extendedprice) as place, first_value(l_partkey) over (partition by l_orderkey, l_linenumber order by l_partkey,
  l_suppkey, l_shipdate, l_extendedprice) as first_part from lineitem)"""
LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


@query(
    "first_wins_dedup",
    f"""with {LINES_SQL} select case when place = 1 then 'kept' else 'first_wins_dedup' end as rule,
    l_orderkey || '|' || l_linenumber as object_key,
    case when place = 1 then cast(l_partkey as varchar) else l_partkey || ' after ' || first_part end as detail from lines""",
)
def first_wins_dedup(spark, d):
    lines = V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *LINE_ORDER)
    kept, issues = K.first_wins_dedup(lines, ["l_orderkey", "l_linenumber"], LINE_ORDER, "lineitem")
    key = F.concat_ws("|", V.text("l_orderkey"), V.text("l_linenumber")).alias("object_key")
    # The issue names whole places; the part numbers in them are enough to compare.
    part = F.split("detail", " after ")
    number = lambda c: F.split(c, r"\|")[0]
    return kept.select(F.lit("kept").alias("rule"), key, V.text("l_partkey").alias("detail")).union(
        issues.select("rule", "object_key", F.concat(number(part[0]), F.lit(" after "), number(part[1])))
    )


@query(
    "namespaces_disjoint",
    """select 'namespaces_disjoint' as rule, cast(p_partkey as varchar) as object_key, cast(p_partkey as varchar) as detail
    from part where p_partkey in (select s_suppkey * 3 from supplier)""",
)
def namespaces_disjoint(spark, d):
    parts = V.table(spark, d, "part").select(V.text("p_partkey").alias("id"))
    suppliers = V.table(spark, d, "supplier").select(V.text(F.col("s_suppkey") * 3).alias("id"))
    return K.namespaces_disjoint(parts, "id", suppliers, "id", "part").select(*BRIEF)


@query(
    "unique_address",
    """with addressed as (select event_id, user_id, event_type, min(event_id) over (partition by user_id, event_type,
      date_trunc('day', ts)) as first from events)
    select 'unique_address' as rule, cast(event_id as varchar) as object_key, 'same as ' || first as detail
    from addressed where event_id <> first""",
)
def unique_address(spark, d):
    e = V.table(spark, d, "events").withColumn("day", F.date_trunc("day", "ts"))
    return K.unique_address(e, ["user_id", "event_type", "day"], ["event_id"], "events").select(*BRIEF)


@query(
    "unordered_pair_unique",
    f"""with {V.RELATIONSHIPS_SQL}, pairs as (select l_orderkey, min(l_orderkey) over (partition by least(a_part, b_part),
      greatest(a_part, b_part), relationship_name) as first from relationships)
    select 'unordered_pair_unique' as rule, cast(l_orderkey as varchar) as object_key, 'same as ' || first as detail
    from pairs where l_orderkey <> first""",
)
def unordered_pair_unique(spark, d):
    r = V.relationships(spark, d)
    return K.unordered_pair_unique(
        r, "table_a_id", "table_b_id", "relationship_name", ["l_orderkey"], "table_relationships"
    ).select(*BRIEF)


@query(
    "disambiguation_required",
    f"""with {V.RELATIONSHIPS_SQL}, sized as (select *, count(*) over (partition by a_part) as n from relationships)
    select 'disambiguation_required' as rule, rel_key as object_key, n || ' rows share ' || table_a_id as detail
    from sized where n > 1 and coalesce(trim(use_when), '') = ''""",
)
def disambiguation_required(spark, d):
    r = V.relationships(spark, d)
    return K.disambiguation_required(r, ["table_a_id"], "use_when", ["rel_key"], "table_relationships").select(*BRIEF)


@query(
    "once_per_parent",
    """with entries as (select conv_id, role, turn, min(turn) over (partition by conv_id, role) as first from conversations)
    select 'once_per_parent' as rule, conv_id || '|' || turn as object_key, role as detail from entries where turn <> first""",
)
def once_per_parent(spark, d):
    c = V.table(spark, d, "conversations")
    return K.once_per_parent(c, ["conv_id"], "role", ["turn"], "conversations").select(*BRIEF)


@query(
    "orphan_references",
    """select 'orphan_references' as rule, l_orderkey || '|' || l_linenumber || '|' || l_partkey as object_key,
    cast(l_orderkey as varchar) as detail from lineitem where l_orderkey % 9 = 0
    union all select 'orphan_references', l_orderkey || '|' || l_linenumber || '|' || l_partkey, cast(l_partkey as varchar)
    from lineitem where l_partkey % 8 = 3
    union all select 'orphan_references', cast(o_orderkey as varchar), cast(o_custkey as varchar) from orders where o_custkey % 10 = 4""",
)
def orphan_references(spark, d):
    lines = V.table(spark, d, "lineitem")
    line_key = F.concat_ws("|", V.text("l_orderkey"), V.text("l_linenumber"), V.text("l_partkey"))
    orders = V.table(spark, d, "orders")
    kept_orders = orders.where(V.mod("o_orderkey", 9) != 0)
    kept_parts = V.table(spark, d, "part").where(V.mod("p_partkey", 8) != 3)
    kept_customers = V.table(spark, d, "customer").where(V.mod("c_custkey", 10) != 4)
    edges = [
        R.orphan_references(lines, "l_orderkey", kept_orders, "o_orderkey", "lineitem", line_key),
        R.orphan_references(lines, "l_partkey", kept_parts, "p_partkey", "lineitem", line_key),
        R.orphan_references(orders, "o_custkey", kept_customers, "c_custkey", "orders", V.text("o_orderkey")),
    ]
    out = edges[0].union(edges[1]).union(edges[2])
    return out.select(*BRIEF)


@query(
    "optional_reference",
    """select 'optional_reference' as rule, cast(o_orderkey as varchar) as object_key, cast(o_custkey as varchar) as detail
    from orders where o_orderkey % 3 <> 0 and o_custkey % 10 = 4""",
)
def optional_reference(spark, d):
    rows = V.table(spark, d, "orders").select(
        "o_orderkey", F.when(V.mod("o_orderkey", 3) != 0, F.col("o_custkey")).alias("ref")
    )
    kept = V.table(spark, d, "customer").where(V.mod("c_custkey", 10) != 4)
    return R.optional_reference(rows, "ref", kept, "c_custkey", "orders", V.text("o_orderkey")).select(*BRIEF)


@query(
    "case_hint",
    f"""with {V.IDS_SQL}, refs as (select 'r' || o_orderkey as object_key,
      case when o_orderkey % 17 = 0 then upper(table_id) when o_orderkey % 17 = 1 then table_id || '.no' else table_id end as ref
      from ids), hints as (select lower(table_id) as low, min(table_id) as hint from tables group by 1)
    select 'case_hint' as rule, object_key, ref as detail, hint from refs left join hints on lower(ref) = low
    where ref not in (select table_id from tables)""",
)
def case_hint(spark, d):
    m = V.mod("o_orderkey", 17)
    ref = F.when(m == 0, F.upper("table_id")).when(m == 1, F.concat("table_id", F.lit(".no"))).otherwise(F.col("table_id"))
    refs = V.ids(spark, d).withColumn("ref", ref)
    key = F.concat(F.lit("r"), V.text("o_orderkey"))
    known = R.ids((V.tables(spark, d), "table_id"))
    missing = R.case_hint(R.unresolved(refs, F.col("ref"), key, known), known)
    return missing.select(F.lit("case_hint").alias("rule"), "object_key", F.col("_ref").alias("detail"), "hint")
