"""Queries a consumer of the catalogue runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder
from catalith.operators import consumers as Q
from catalith.operators import join_paths as J
from catalith.plans import views as V
from catalith.plans.registry import query


@query(
    "mapping_choices",
    """with cols as (select 'c' || c_custkey as source_column_id, c_custkey from customer),
    maps as (select 'c' || o_custkey as source_column_id, 'm' || o_orderkey as mapping_name,
      case when o_orderkey % 4 <> 0 then 'x' || o_orderkey end as target_expression from orders where o_custkey % 6 <> 0)
    select c.source_column_id, mapping_name, target_expression,
      case when mapping_name is null then 'unmapped' when target_expression is null then 'dropped' else 'mapped' end as status
    from cols c left join maps m on c.source_column_id = m.source_column_id""",
)
def mapping_choices(spark, d):
    cols = V.table(spark, d, "customer").select(
        F.concat(F.lit("c"), V.text("c_custkey")).alias("column_id"), F.lit("t").alias("table_id")
    )
    maps = V.table(spark, d, "orders").where(V.mod("o_custkey", 6) != 0).select(
        F.concat(F.lit("c"), V.text("o_custkey")).alias("source_column_id"),
        F.concat(F.lit("m"), V.text("o_orderkey")).alias("mapping_name"),
        F.when(V.mod("o_orderkey", 4) != 0, F.concat(F.lit("x"), V.text("o_orderkey"))).alias("target_expression"),
        F.lit("always").alias("use_when"),
    )
    return Q.mapping_choices(maps, cols).select("source_column_id", "mapping_name", "target_expression", "status")


def _frames(spark, d):
    return {
        "shop.sales.orders": V.table(spark, d, "orders"),
        "shop.sales.lineitem": V.table(spark, d, "lineitem"),
        "shop.sales.customer": V.table(spark, d, "customer"),
    }


@query(
    "apply_mapping",
    """select o_orderkey, cast(cast(sum(l_quantity) as bigint) as varchar) as mapped from orders
    left join lineitem on o_orderkey = l_orderkey group by o_orderkey""",
)
def apply_mapping(spark, d):
    """Aggregate at order grain over the lines; orders without lines stay."""
    out = Q.apply_mapping(
        _frames(spark, d),
        "shop.sales.orders",
        ["o_orderkey"],
        [("shop.sales.lineitem", [("shop.sales.orders.o_orderkey", "shop.sales.lineitem.l_orderkey")])],
        "sum(shop.sales.lineitem.l_quantity)",
        kind="aggregate",
    )
    return out.select("o_orderkey", F.col("mapped").cast("bigint").cast("string").alias("mapped"))


@query(
    "apply_mapping_scalar",
    """select o_orderkey, coalesce(c_mktsegment || ' or shop.sales', 'none') as mapped from orders
    left join customer on o_custkey = c_custkey""",
)
def apply_mapping_scalar(spark, d):
    return Q.apply_mapping(
        _frames(spark, d),
        "shop.sales.orders",
        ["o_orderkey"],
        [("shop.sales.customer", [("shop.sales.orders.o_custkey", "shop.sales.customer.c_custkey")])],
        "coalesce(shop.sales.customer.c_mktsegment || ' or shop.sales', 'none')",
    )


@query(
    "table_grain",
    f"""with {V.IDS_SQL} select table_id, column_name from ids where o_orderkey % 8 = 0
    union all select table_id, null from tables where table_id not in (select table_id from ids where o_orderkey % 8 = 0)""",
)
def table_grain(spark, d):
    columns = V.ids(spark, d).withColumn("is_primary_key", V.mod("o_orderkey", 8) == 0)
    return Q.table_grain(columns, V.tables(spark, d))


CODES_SQL = """codes as (select distinct p_type as code, 'meaning of ' || lower(p_type) as meaning from part where p_type <> 'PROMO')"""


def _decoded(spark, d):
    parts = V.table(spark, d, "part")
    codes = parts.where(F.col("p_type") != "PROMO").select(F.col("p_type").alias("code")).distinct()
    codes = codes.withColumn("meaning", F.concat(F.lit("meaning of "), F.lower("code")))
    return Q.code_lookup(parts, "p_type", codes, "code", "meaning")


@query(
    "code_lookup",
    f"""with {CODES_SQL} select p_partkey, p_type, meaning, code is not null as known from part left join codes on p_type = code""",
)
def code_lookup(spark, d):
    return _decoded(spark, d).select("p_partkey", "p_type", "meaning", "known")


@query(
    "unknown_codes",
    "select p_type, count(*) as n_rows from part where p_type = 'PROMO' group by p_type",
)
def unknown_codes(spark, d):
    return Q.unknown_codes(_decoded(spark, d), "p_type")


@query(
    "cardinality_profile",
    """with a as (select o_custkey as k, count(*) as n from orders group by 1), b as (select c_custkey as k, count(*) as n from customer group by 1),
    j as (select a.n as na, b.n as nb from a full outer join b on a.k = b.k)
    select case when max(case when nb is not null then na end) > 1 then 'many' else 'one' end || '_to_'
      || case when max(case when na is not null then nb end) > 1 then 'many' else 'one' end as cardinality,
      count(*) filter (where na is not null and nb is not null) as matched_keys,
      count(*) filter (where nb is null) as keys_only_in_a, count(*) filter (where na is null) as keys_only_in_b from j""",
)
def cardinality_profile(spark, d):
    return Q.cardinality_profile(V.table(spark, d, "orders"), ["o_custkey"], V.table(spark, d, "customer"), ["c_custkey"])


# What the sample's tables are joined by, and what might have been written down about it.
RECORDED = [
    ("order_buyer", "orders", ["o_custkey"], "customer", ["c_custkey"], "many_to_one"),
    ("order_lines", "orders", ["o_orderkey"], "lineitem", ["l_orderkey"], "one_to_one"),
    ("line_part", "lineitem", ["l_partkey"], "part", ["p_partkey"], "many_to_many"),
    ("line_part_supplier", "lineitem", ["l_partkey", "l_suppkey"], "lineitem", ["l_partkey", "l_suppkey"], None),
    ("buyer_land", "customer", ["c_nationkey"], "nation", ["n_nationkey"], "Many_To_One"),
    ("land_world", "nation", ["n_regionkey"], "region", ["r_regionkey"], "one_to_many"),
    ("event_user", "events", ["user_id"], "customer", ["c_custkey"], "many_to_one"),
    ("document_label", "documents", ["doc_id"], "labels", ["doc_id"], "one_to_one"),
    ("part_brand", "part", ["p_brand"], "supplier", ["s_suppkey"], "one_to_one"),
]


def _recorded_sql() -> str:
    def one(rel, a, a_on, b, b_on, said):
        key = lambda cols: ", ".join(f"{c}::varchar as k{i}" for i, c in enumerate(cols))
        there = lambda cols: " and ".join(f"{c} is not null" for c in cols)
        keys = ", ".join(f"k{i}" for i in range(len(a_on)))
        value = f"'{said}'" if said else "cast(null as varchar)"
        return f"""select '{rel}' as rel_key, '{a}' as table_a_id, '{b}' as table_b_id, {value} as recorded,
          count(*) filter (where na > 0 and nb > 0) as matched, max(case when nb > 0 then na end) as top_a, max(case when na > 0 then nb end) as top_b,
          count(*) filter (where nb = 0) as only_a, count(*) filter (where na = 0) as only_b
        from (select {keys}, count(*) filter (where is_a) as na, count(*) filter (where not is_a) as nb from (
          select {key(a_on)}, true as is_a from {a} where {there(a_on)} union all select {key(b_on)}, false from {b} where {there(b_on)}) group by all)"""

    return " union all ".join(one(*r) for r in RECORDED)


@query(
    "cardinality_report",
    f"""with counted as ({_recorded_sql()}),
    measured as (select *, case when matched > 0 then case when top_a > 1 then 'many' else 'one' end || '_to_' || case when top_b > 1 then 'many' else 'one' end end as measured
      from counted)
    select rel_key, table_a_id, table_b_id, recorded, measured,
      case when recorded not in ('one_to_one', 'one_to_many', 'many_to_one', 'many_to_many') then 'unknown value' when matched = 0 then 'no shared key'
        when recorded is null then 'unrecorded' when recorded = measured then 'agrees'
        when (top_a > 1 and starts_with(recorded, 'one')) or (top_b > 1 and ends_with(recorded, 'one')) then 'contradicted' else 'narrower' end as status,
      matched as matched_keys, case when matched > 0 then only_a end as keys_only_in_a, case when matched > 0 then only_b end as keys_only_in_b from measured""",
)
def cardinality_report(spark, d):
    """Nine relationships of eight tables, measured in one job; one shares no key."""
    frames = {t: V.table(spark, d, t) for t in {t for r in RECORDED for t in (r[1], r[3])}}
    return Q.cardinality_report(RECORDED, frames)


@query(
    "pending_validation",
    f"""with {V.RELATIONSHIPS_SQL}
    select 'relationship' as kind, 'wh' as data_source_id, count(*) as n, count(*) filter (where not validated) as n_pending from relationships
    union all select 'mapping', 's' || (o_custkey % 4), count(*), count(*) filter (where o_orderkey % 3 = 0) from orders group by 2""",
)
def pending_validation(spark, d):
    maps = V.table(spark, d, "orders").select(
        F.concat(F.lit("s"), V.text(V.mod("o_custkey", 4)), F.lit(".a.b.c")).alias("source_column_id"),
        (V.mod("o_orderkey", 3) != 0).alias("validated"),
    )
    return Q.pending_validation(V.relationships(spark, d), maps)


# --- ways through the relationships: orders, customers, nations, regions, in two systems ---

# Every order asks for one of five things; `om` is the first order of its nation, by customer `cm`.
PATHS_SQL = """
placed_orders as (
  select o_orderkey as k, c_custkey as c, n_nationkey as n, r_regionkey as r
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
firsts as (select n, min(k) as om, min_by(c, k) as cm from placed_orders group by n),
asked as (
  select p.*, om, cm, k % 5 as form, 'm' || k as key, 'shop.sales.o' || k as o_id, 'shop.crm.c' || c as c_id, 'shop.geo.n' || n as n_id,
         'shop.geo.r' || r as r_id, 'shop.crm.c' || cm as cm_id, 'shop.sales.o' || om as om_id
  from placed_orders p join firsts f using (n)
  where k % 5 <> 3 or k <> om),
judged as (
  select *,
    k % 10 <> 0 and c % 7 <> 0 and (form <> 3 or (om % 10 <> 0 and cm % 7 <> 0)) as in_0,
    c % 5 <> 0 and (form not in (2, 4) or r <> 0) and (form <> 3 or cm % 5 <> 0) as in_1
  from asked),
chosen as (select *, case when in_0 then 'sys0' when in_1 then 'sys1' end as system from judged),
steps as (
  select key, system, 1 as hop, o_id as from_table, c_id as to_table, o_id || '|' || c_id || '|ordered_by' as rel_key from chosen where system is not null
  union all
  select key, system, 2, c_id, n_id, c_id || '|' || n_id || case when c % 9 = 0 then '|billed_in' else '|lives_in' end from chosen
  where system is not null and (form in (1, 2, 4) or (form = 3 and cm <> c))
  union all
  select key, system, 3, n_id, r_id, n_id || '|' || r_id || '|part_of' from chosen where system is not null and form in (2, 4)
  union all
  select key, system, 2, c_id, om_id, om_id || '|' || c_id || '|ordered_by' from chosen where system is not null and form = 3 and cm = c
  union all
  select key, system, 3, n_id, cm_id, cm_id || '|' || n_id || case when cm % 9 = 0 then '|billed_in' else '|lives_in' end from chosen
  where system is not null and form = 3 and cm <> c
  union all
  select key, system, 4, cm_id, om_id, om_id || '|' || cm_id || '|ordered_by' from chosen where system is not null and form = 3 and cm <> c)
"""


def _id(prefix: str, column):
    return F.concat(F.lit(prefix), V.text(column))


def shop_graph(spark, d):
    """(relationships, placements, wanted ways) of orders, customers, nations and regions."""
    o, c, n = V.table(spark, d, "orders"), V.table(spark, d, "customer"), V.table(spark, d, "nation")
    regions = V.table(spark, d, "region").select("r_regionkey")
    n = n.join(regions, n.n_regionkey == regions.r_regionkey)
    # What all relationships, placements and wanted ways are made from is joined once.
    folder = staging_folder(spark)
    c = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_nationkey", "r_regionkey")
    c = stage(c, folder, "buyers")
    # Customers are packed small, but not on the driver.
    o = o.join(c.hint("merge"), o.o_custkey == c.c_custkey).select("o_orderkey", "c_custkey", "n_nationkey", "r_regionkey")
    o = stage(o, folder, "sales")
    sale, buyer = _id("shop.sales.o", "o_orderkey"), _id("shop.crm.c", "c_custkey")
    land, world = _id("shop.geo.n", "n_nationkey"), _id("shop.geo.r", "r_regionkey")

    def rel(df, a, b, name):
        return df.select(a.alias("table_a_id"), b.alias("table_b_id"), F.lit(name).alias("relationship_name"))

    rels = rel(o, sale, buyer, "ordered_by").unionByName(rel(c, buyer, land, "lives_in"))
    rels = rels.unionByName(rel(c.where(V.mod("c_custkey", 9) == 0), buyer, land, "billed_in")).unionByName(rel(n, land, world, "part_of"))
    rels = rels.withColumn("rel_key", F.concat_ws("|", "table_a_id", "table_b_id", "relationship_name"))

    def placed(df, table, *systems):
        found = F.array_compact(F.array(*[F.when(there, F.lit(s)) for s, there in systems]))
        return df.select(table.alias("table_id"), F.explode(found).alias("system"))

    always = F.lit(True)
    deployments = (
        placed(o, sale, ("sys0", V.mod("o_orderkey", 10) != 0), ("sys1", always))
        .unionByName(placed(c, buyer, ("sys0", V.mod("c_custkey", 7) != 0), ("sys1", V.mod("c_custkey", 5) != 0)))
        .unionByName(placed(n, land, ("sys0", always), ("sys1", always)))
        .unionByName(placed(regions, world, ("sys0", always), ("sys1", F.col("r_regionkey") != 0)))
    )
    firsts = o.groupBy("n_nationkey").agg(F.min("o_orderkey").alias("om"))
    form = V.mod("o_orderkey", 5)
    targets = (
        F.when(form == 0, F.array(buyer)).when(form == 1, F.array(land)).when(form == 2, F.array(world))
        .when(form == 3, F.array(_id("shop.sales.o", "om"))).otherwise(F.array(buyer, world))
    )
    wanted = o.join(firsts, "n_nationkey").select(_id("m", "o_orderkey").alias("key"), sale.alias("source"), F.explode(targets).alias("target"))
    return rels, deployments, wanted


def _paths(spark, d) -> J.JoinPaths:
    rels, deployments, wanted = shop_graph(spark, d)
    return J.join_paths(wanted, rels, "table_a_id", "table_b_id", "rel_key", deployments)


@query("join_paths", f"with {PATHS_SQL} select key, system, hop, from_table, to_table, rel_key from steps")
def join_paths(spark, d):
    """One to four hops, in the one system that carries them all."""
    return _paths(spark, d).hops.select("key", "system", "hop", "from_table", "to_table", "rel_key")


@query(
    "join_path_issues",
    f"""with {PATHS_SQL},
    targets as (select key, system, o_id, unnest(case form when 0 then [c_id] when 1 then [n_id] when 2 then [r_id] when 3 then [om_id]
      else [c_id, r_id] end) as target from chosen)
    select 'unreachable_target' as rule, key as object_key, o_id || ' to ' || target as detail from targets where system is null
    union all select 'ambiguous_path', key, 'several shortest ways' from chosen
    where system is not null and ((form in (1, 2, 4) and c % 9 = 0) or (form = 3 and cm <> c and (c % 9 = 0 or cm % 9 = 0)))""",
)
def join_path_issues(spark, d):
    return _paths(spark, d).issues.select("rule", "object_key", "detail")


def _recorded(spark, d):
    """Four tables as they are, the relationships between them, and where they live."""
    frames = {
        "shop.sales.orders": V.table(spark, d, "orders"), "shop.crm.customer": V.table(spark, d, "customer"),
        "shop.geo.nation": V.table(spark, d, "nation"), "shop.geo.region": V.table(spark, d, "region"),
    }
    rels = [
        ("shop.sales.orders", "shop.crm.customer", "ordered_by", "shop.sales.orders.o_custkey = shop.crm.customer.c_custkey", "many_to_one"),
        ("shop.geo.nation", "shop.crm.customer", "home_of", "shop.geo.nation.n_nationkey = shop.crm.customer.c_nationkey", "one_to_many"),
        ("shop.geo.nation", "shop.geo.region", "part_of", "shop.geo.nation.n_regionkey = shop.geo.region.r_regionkey", "many_to_one"),
    ]
    rels = spark.createDataFrame(rels, "table_a_id string, table_b_id string, relationship_name string, join_condition string, cardinality string")
    rels = rels.withColumn("rel_key", F.concat_ws("|", "table_a_id", "table_b_id", "relationship_name"))
    deployments = spark.createDataFrame([(t, "lake") for t in frames], "table_id string, system string")
    return frames, rels, deployments


@query(
    "apply_mapping_through_relationships",
    """select o_orderkey, r_name || '/' || n_name as mapped from orders left join customer on o_custkey = c_custkey
    left join nation on n_nationkey = c_nationkey left join region on n_regionkey = r_regionkey""",
)
def apply_mapping_through_relationships(spark, d):
    """The joins of a mapping to two tables, found from the recorded relationships."""
    frames, rels, deployments = _recorded(spark, d)
    wanted = spark.createDataFrame([("m", "shop.sales.orders", t) for t in ("shop.geo.region", "shop.geo.nation")], "key string, source string, target string")
    paths = J.join_paths(wanted, rels, "table_a_id", "table_b_id", "rel_key", deployments)
    joins = J.joins_of(J.described(paths, rels, "rel_key"), "m")
    return Q.apply_mapping(frames, "shop.sales.orders", ["o_orderkey"], joins, "shop.geo.region.r_name || '/' || shop.geo.nation.n_name")
