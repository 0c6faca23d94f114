"""Catalogue-shaped views over the sample tables, each as a DataFrame and as SQL.

Everything is derived from whole tables by row-local arithmetic, joins on
unique keys and combinable aggregates, so it grows with the data and no key
gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions.binding import compute_once
from catalith.functions.expressions import badly_qualified_of, reference_tokens, tables_of, tokens
from catalith.skew import spread_join


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def mod(col: str | Column, n: int) -> Column:
    return F.pmod(F.col(col) if isinstance(col, str) else col, F.lit(n))


# --- dotted ids: region.nation.customer.order ---------------------------------

SOURCES_SQL = "sources as (select lower(replace(r_name, ' ', '_')) as data_source_id, r_name, r_regionkey from region)"
SCHEMAS_SQL = (
    SOURCES_SQL
    + ", schemas as (select data_source_id || '.' || lower(n_name) as schema_id, data_source_id,"
    " lower(n_name) as schema_name, n_name, n_nationkey from nation join sources on n_regionkey = r_regionkey)"
)
TABLES_SQL = (
    SCHEMAS_SQL
    + ", tables as (select schema_id || '.c' || c_custkey as table_id, schema_id, data_source_id, schema_name,"
    " 'c' || c_custkey as table_name, c_custkey, c_mktsegment"
    " from customer join schemas on c_nationkey = n_nationkey)"
)
IDS_SQL = (
    TABLES_SQL
    + ", ids as (select table_id || '.o' || o_orderkey as column_id, table_id, schema_id, data_source_id,"
    " 'o' || o_orderkey as column_name, o_orderkey, o_orderpriority, o_orderstatus"
    " from orders join tables on o_custkey = c_custkey)"
)


def sources(spark, d) -> DataFrame:
    return table(spark, d, "region").select(
        F.lower(F.replace("r_name", F.lit(" "), F.lit("_"))).alias("data_source_id"), "r_name", "r_regionkey"
    )


def schemas(spark, d) -> DataFrame:
    n = table(spark, d, "nation")
    s = sources(spark, d)
    return n.join(s, n.n_regionkey == s.r_regionkey).select(
        F.concat_ws(".", "data_source_id", F.lower("n_name")).alias("schema_id"),
        "data_source_id",
        F.lower("n_name").alias("schema_name"),
        "n_name",
        "n_nationkey",
    )


def tables(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    s = schemas(spark, d)
    name = F.concat(F.lit("c"), text("c_custkey"))
    return c.join(s, c.c_nationkey == s.n_nationkey).select(
        F.concat_ws(".", "schema_id", name).alias("table_id"),
        "schema_id", "data_source_id", "schema_name", name.alias("table_name"), "c_custkey", "c_mktsegment",
    )


def ids(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    t = tables(spark, d)
    name = F.concat(F.lit("o"), text("o_orderkey"))
    # One customer may hold a third of all orders.
    joined = spread_join(o.withColumnRenamed("o_custkey", "c_custkey"), t, ["c_custkey"], spread_by=["o_orderkey"])
    return joined.select(
        F.concat_ws(".", "table_id", name).alias("column_id"),
        "table_id", "schema_id", "data_source_id", name.alias("column_name"), "o_orderkey", "o_orderpriority",
        "o_orderstatus",
    )


# --- two snapshots of orders --------------------------------------------------

SNAPSHOTS_SQL = """
cur as (
  select o_orderkey, case when o_orderkey % 13 = 0 then null else o_totalprice end as o_totalprice, o_orderpriority,
         cast(null as varchar) as update_reason
  from orders where o_orderkey % 10 <> 0),
new as (
  select o_orderkey, case when o_orderkey % 13 = 0 then null else o_totalprice end as o_totalprice,
         case when o_orderkey % 7 = 0 then '9-CHANGED' else o_orderpriority end as o_orderpriority,
         case when o_orderkey % 14 = 0 then 'priority corrected'
              when o_orderkey % 50 = 0 then 'new order' end as update_reason
  from orders where o_orderkey % 10 <> 1),
joined as (
  select coalesce(n.o_orderkey, c.o_orderkey) as o_orderkey, c.o_orderkey as old_key, n.o_orderkey as new_key,
         c.o_totalprice as old_price, n.o_totalprice as new_price, c.o_orderpriority as old_priority,
         n.o_orderpriority as new_priority, c.update_reason as old_reason, n.update_reason as new_reason
  from new n full outer join cur c on n.o_orderkey = c.o_orderkey),
changes as (
  select *, case when old_key is null then 'insert' when new_key is null then 'delete' else 'update' end as op
  from joined
  where old_key is null or new_key is null or old_price is distinct from new_price
     or old_priority is distinct from new_priority or old_reason is distinct from new_reason)
"""
SNAPSHOT_KEY = ["o_orderkey"]
SNAPSHOT_CONTENT = ["o_totalprice", "o_orderpriority", "update_reason"]


def _snapshot(o: DataFrame) -> DataFrame:
    return o.withColumn("o_totalprice", F.when(mod("o_orderkey", 13) != 0, F.col("o_totalprice")))


def current_orders(spark, d) -> DataFrame:
    o = table(spark, d, "orders").where(mod("o_orderkey", 10) != 0)
    return _snapshot(o).select(
        "o_orderkey", "o_totalprice", "o_orderpriority", F.lit(None).cast("string").alias("update_reason")
    )


def new_orders(spark, d) -> DataFrame:
    o = table(spark, d, "orders").where(mod("o_orderkey", 10) != 1)
    priority = F.when(mod("o_orderkey", 7) == 0, "9-CHANGED").otherwise(F.col("o_orderpriority"))
    reason = F.when(mod("o_orderkey", 14) == 0, "priority corrected").when(mod("o_orderkey", 50) == 0, "new order")
    return _snapshot(o).select(
        "o_orderkey", "o_totalprice", priority.alias("o_orderpriority"), reason.alias("update_reason")
    )


# --- placements: parts are tables, eight systems ------------------------------

DEPLOYMENTS_SQL = """
part_tables as (
  select p_partkey, 'wh.b' || replace(lower(p_brand), '#', '') || '.t' || p_partkey as table_id,
         'wh' as data_source_id, p_brand, p_size from part),
deployments as (
  select distinct table_id, 'sys' || ((l_partkey + l_suppkey % 2) % 8) as system, data_source_id,
         'db' || ((l_partkey + l_suppkey % 2) % 8) as physical_database_name, split_part(table_id, '.', 2) as physical_schema_name,
         'p_' || split_part(table_id, '.', 3) as physical_table_name
  from lineitem join part_tables on l_partkey = p_partkey)
"""


def part_tables(spark, d) -> DataFrame:
    schema = F.concat(F.lit("b"), F.replace(F.lower("p_brand"), F.lit("#"), F.lit("")))
    return table(spark, d, "part").select(
        "p_partkey",
        F.concat_ws(".", F.lit("wh"), schema, F.concat(F.lit("t"), text("p_partkey"))).alias("table_id"),
        F.lit("wh").alias("data_source_id"),
        "p_brand",
        "p_size",
    )


def deployments(spark, d) -> DataFrame:
    """Distinct pairs first, on the numbers, then the names: the shuffle carries two small columns."""
    pairs = (
        table(spark, d, "lineitem")
        .select("l_partkey", mod(F.col("l_partkey") + mod("l_suppkey", 2), 8).alias("s"))
        .distinct()
    )
    t = part_tables(spark, d)
    return pairs.join(t, pairs.l_partkey == t.p_partkey).select(
        "table_id",
        F.concat(F.lit("sys"), text("s")).alias("system"),
        "data_source_id",
        F.concat(F.lit("db"), text("s")).alias("physical_database_name"),
        F.split_part("table_id", F.lit("."), F.lit(2)).alias("physical_schema_name"),
        F.concat(F.lit("p_"), F.split_part("table_id", F.lit("."), F.lit(3))).alias("physical_table_name"),
    )


# --- relationships between parts ordered together -----------------------------

RELATIONSHIPS_SQL = """
pair_rows as (
  select l_orderkey, min(l_partkey) as a, max(l_partkey) as b from lineitem group by l_orderkey
  having min(l_partkey) <> max(l_partkey)),
relationships as (
  select l_orderkey, 'rel' || l_orderkey as rel_key,
         case when l_orderkey % 2 = 0 then a else b end as a_part, case when l_orderkey % 2 = 0 then b else a end as b_part,
         'wh.parts.t' || (case when l_orderkey % 2 = 0 then a else b end) as table_a_id,
         'wh.parts.t' || (case when l_orderkey % 2 = 0 then b else a end) as table_b_id,
         'r' || (l_orderkey % 3) as relationship_name,
         case when l_orderkey % 5 = 0 then null when l_orderkey % 5 = 1 then '  ' else 'case ' || l_orderkey end as use_when,
         case l_orderkey % 6 when 0 then 'one_to_one' when 1 then 'one_to_many' when 2 then 'many_to_one'
              when 3 then 'many_to_many' when 4 then 'Many_To_One' end as cardinality,
         l_orderkey % 4 <> 0 as validated
  from pair_rows)
"""


def relationships(spark, d) -> DataFrame:
    """One relationship per order with two different parts; every other one is reversed."""
    pairs = (
        table(spark, d, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_partkey").alias("a"), F.max("l_partkey").alias("b"))
        .where(F.col("a") != F.col("b"))
    )
    k = "l_orderkey"
    even = mod(k, 2) == 0
    a_part = F.when(even, F.col("a")).otherwise(F.col("b"))
    b_part = F.when(even, F.col("b")).otherwise(F.col("a"))
    kind = (
        F.when(mod(k, 6) == 0, "one_to_one").when(mod(k, 6) == 1, "one_to_many").when(mod(k, 6) == 2, "many_to_one")
        .when(mod(k, 6) == 3, "many_to_many").when(mod(k, 6) == 4, "Many_To_One")
    )
    return pairs.select(
        k,
        F.concat(F.lit("rel"), text(k)).alias("rel_key"),
        a_part.alias("a_part"),
        b_part.alias("b_part"),
        F.concat(F.lit("wh.parts.t"), text(a_part)).alias("table_a_id"),
        F.concat(F.lit("wh.parts.t"), text(b_part)).alias("table_b_id"),
        F.concat(F.lit("r"), text(mod(k, 3))).alias("relationship_name"),
        F.when(mod(k, 5) == 0, F.lit(None))
        .when(mod(k, 5) == 1, "  ")
        .otherwise(F.concat(F.lit("case "), text(k)))
        .alias("use_when"),
        kind.alias("cardinality"),
        (mod(k, 4) != 0).alias("validated"),
    )


# --- expressions --------------------------------------------------------------

# The text of one expression per order line; `a` and `b` are its two tables.
EXPRESSION_FORMS = {
    0: "{a}.c1 = {b}.c1",
    1: "{a}.c1 + {b}.c2 * 2",
    2: "coalesce({a}.c1, 'x.y.z.w') || 'it''s'",
    3: "sales.t1.c1 = {b}.c1",
    4: "pre.{a}.c1 > 0 and {b}.c3 is not null",
    5: "{a}.c1 > now() and current_date is not null",
    6: "(select max(q) from {a})",
    7: "{a}.C1 is distinct from {b}.c1",
    8: "case when {a}.c1 = 1 then {b}.c2 else 0 end",
    9: None,
    10: "(({a}.c1 in (1, 2)))  -- note x.y.z.w",
    11: "{a}.c1 at time zone 'utc'; delete from log",
    12: "42 /* k.l.m.n */ + 1",
    13: 'round({a}."c2" / 2.5) = {a}.c3',
    14: "{a}.c1 =-1",
    15: "cast({a}.c1 as int8) <>-{b}.c2",
    16: "date = {a}.c1",
    17: '"now"() > {a}.c1',
    18: "$$a.b.c.d$$ || E'it\\'s a.b.c.d' || {a}.c1 || '" + "''" * 200 + "'",
}
# Forms with a reference or bare name that does not have four parts.
BADLY_QUALIFIED_FORMS = "3, 4, 6, 11, 16"


def _spark_form(template: str | None, a: Column, b: Column) -> Column:
    if template is None:
        return F.lit(None).cast("string")
    pieces, rest = [], template
    while rest:
        spots = [(rest.find(m), m) for m in ("{a}", "{b}") if m in rest]
        if not spots:
            pieces.append(F.lit(rest))
            break
        at, mark = min(spots)
        if at:
            pieces.append(F.lit(rest[:at]))
        pieces.append(a if mark == "{a}" else b)
        rest = rest[at + 3 :]
    return F.concat(*pieces)


def _sql_form(template: str | None) -> str:
    if template is None:
        return "cast(null as varchar)"
    quoted = "'" + template.replace("'", "''") + "'"
    return f"replace(replace({quoted}, '{{a}}', a), '{{b}}', b)"


EXPRESSIONS_SQL = (
    """
lines as (
  select 'e' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as expr_key,
         'wh.parts.t' || l_partkey as a, 'wh.parts.t' || (l_suppkey * 7) as b, l_partkey, l_suppkey,
         (l_orderkey + l_linenumber) % 19 as form
  from lineitem group by l_orderkey, l_linenumber, l_partkey, l_suppkey),
expressions as (select *, case form """
    + " ".join(f"when {i} then {_sql_form(t)}" for i, t in EXPRESSION_FORMS.items())
    + " end as expr from lines)"
)


def expressions(spark, d) -> DataFrame:
    lines = (
        table(spark, d, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .distinct()
        .select(
            F.concat(
                F.lit("e"), F.concat_ws("-", text("l_orderkey"), text("l_linenumber"), text("l_partkey"), text("l_suppkey"))
            ).alias("expr_key"),
            F.concat(F.lit("wh.parts.t"), text("l_partkey")).alias("a"),
            F.concat(F.lit("wh.parts.t"), text(F.col("l_suppkey") * 7)).alias("b"),
            "l_partkey",
            "l_suppkey",
            mod(F.col("l_orderkey") + F.col("l_linenumber"), len(EXPRESSION_FORMS)).alias("form"),
        )
    )
    expr = None
    for i, template in EXPRESSION_FORMS.items():
        hit = F.col("form") == i
        value = _spark_form(template, F.col("a"), F.col("b"))
        expr = F.when(hit, value) if expr is None else expr.when(hit, value)
    return compute_once(lines, {"expr": expr})


# What the forms above refer to, written by hand: the truth the oracles use.
EXPRESSION_REFS = {
    0: ["{a}.c1", "{b}.c1"],
    1: ["{a}.c1", "{b}.c2"],
    2: ["{a}.c1"],
    3: ["sales.t1.c1", "{b}.c1"],
    4: ["pre.{a}.c1", "{b}.c3"],
    5: ["{a}.c1"],
    6: ["{a}"],
    7: ["{a}.C1", "{b}.c1"],
    8: ["{a}.c1", "{b}.c2"],
    10: ["{a}.c1"],
    11: ["{a}.c1"],
    12: [],
    13: ["{a}.c2", "{a}.c3"],
    14: ["{a}.c1"],
    15: ["{a}.c1", "{b}.c2"],
    16: ["{a}.c1"],
    17: ["{a}.c1"],
    18: ["{a}.c1"],
}
REFS_SQL = (
    EXPRESSIONS_SQL
    + ", ref_lists as (select *, case form "
    + " ".join(
        f"when {i} then cast([" + ", ".join(_sql_form(r) for r in refs) + "] as varchar[])"
        for i, refs in EXPRESSION_REFS.items()
    )
    + " end as refs from expressions),"
    " refs as (select expr_key, a, b, form, unnest(range(len(refs))) as pos, unnest(refs) as ref"
    " from ref_lists where refs is not null and len(refs) > 0)"
)

# Documented columns: c1 and c2 of every part table but each tenth.
COLUMNS_SQL = (
    "doc_columns as (select 'wh.parts.t' || p_partkey || '.c' || i as column_id, 'wh.parts.t' || p_partkey as table_id"
    " from part, unnest([1, 2]) as u(i) where p_partkey % 10 <> 0)"
)
DOC_TABLES_SQL = "doc_tables as (select 'wh.parts.t' || p_partkey as table_id from part where p_partkey % 10 <> 0)"
# Placements of the tables used in expressions and relationships.
PLACED_SQL = (
    "placed as (select distinct 'wh.parts.t' || l_partkey as table_id, 'sys' || ((l_partkey + l_suppkey % 2) % 8) as system"
    " from lineitem)"
)


def doc_tables(spark, d) -> DataFrame:
    return table(spark, d, "part").where(mod("p_partkey", 10) != 0).select(
        F.concat(F.lit("wh.parts.t"), text("p_partkey")).alias("table_id")
    )


def doc_columns(spark, d) -> DataFrame:
    return doc_tables(spark, d).select(
        "table_id", F.explode(F.array(F.lit("c1"), F.lit("c2"))).alias("c")
    ).select(F.concat_ws(".", "table_id", "c").alias("column_id"), "table_id")


def placed(spark, d) -> DataFrame:
    pairs = (
        table(spark, d, "lineitem")
        .select("l_partkey", mod(F.col("l_partkey") + mod("l_suppkey", 2), 8).alias("s")).distinct()
    )
    name = F.concat(F.lit("wh.parts.t"), text("l_partkey"))
    system = F.concat(F.lit("sys"), text("s"))
    return pairs.select(
        name.alias("table_id"), system.alias("system"), F.lit("wh").alias("data_source_id"),
        F.concat(F.lit("db"), text("s")).alias("physical_database_name"),
        F.lit("parts").alias("physical_schema_name"),
        F.concat(F.lit("p_"), text("l_partkey")).alias("physical_table_name"),
    )


def expression_tables(spark, d) -> DataFrame:
    """(expr_key, tables) for expressions whose references all have four parts."""
    rows = expressions(spark, d).where(F.col("expr").isNotNull())
    cut = compute_once(rows.select("expr_key", "expr"), {"_toks": tokens(F.col("expr"))}).drop("expr")
    cut = compute_once(cut, {"_refs": reference_tokens(F.col("_toks"))})
    facts = {"tables": tables_of(F.col("_refs")), "_bad": badly_qualified_of(F.col("_refs"), F.col("_toks"))}
    return compute_once(cut, facts).where(F.size("_bad") == 0).select("expr_key", "tables")


EXPRESSION_TABLES_SQL = (
    REFS_SQL
    + ", expr_tables as (select distinct expr_key, array_to_string(list_slice(string_split(ref, '.'), 1, 3), '.') as table_id"
    " from refs where form not in (" + BADLY_QUALIFIED_FORMS + "))"
)


# --- concepts -----------------------------------------------------------------

CONCEPTS_SQL = (
    IDS_SQL
    + """, concept_rows as (
  select o_orderkey, column_id, table_id, schema_id, data_source_id,
         case when o_orderkey % 17 = 0 then 'ghost.' else '' end
         || case o_orderkey % 4 when 0 then data_source_id when 1 then schema_id when 2 then table_id else column_id end
         || '.concept.k' || o_orderkey as concept_id from ids),
concepts as (
  select *, case o_orderkey % 3 when 0 then [table_id, schema_id] when 1 then [column_id, 'no.such', column_id]
            else [concept_id, data_source_id] end as related_object_ids from concept_rows)"""
)


def concepts(spark, d) -> DataFrame:
    k = "o_orderkey"
    anchor = (
        F.when(mod(k, 4) == 0, F.col("data_source_id")).when(mod(k, 4) == 1, F.col("schema_id"))
        .when(mod(k, 4) == 2, F.col("table_id")).otherwise(F.col("column_id"))
    )
    ghost = F.when(mod(k, 17) == 0, "ghost.").otherwise("")
    rows = ids(spark, d).withColumn("concept_id", F.concat(ghost, anchor, F.lit(".concept.k"), text(k)))
    links = (
        F.when(mod(k, 3) == 0, F.array("table_id", "schema_id"))
        .when(mod(k, 3) == 1, F.array(F.col("column_id"), F.lit("no.such"), F.col("column_id")))
        .otherwise(F.array("concept_id", "data_source_id"))
    )
    return rows.withColumn("related_object_ids", links)


# --- sparse placement entries: one source per supplier ------------------------

ENTRIES_SQL = """
supplied as (select distinct l_suppkey, l_partkey from lineitem),
src_tables as (
  select 's' || l_suppkey || '.b' || (l_partkey % 3) || '.t' || l_partkey as table_id, 's' || l_suppkey as data_source_id,
         'b' || (l_partkey % 3) as schema_name, 't' || l_partkey as table_name, l_suppkey, l_partkey
  from supplied where l_suppkey % 11 <> 0),
src_schemas as (select 's' || s_suppkey as data_source_id, b as schema_name from supplier, unnest(['b0','b1','b2','bempty']) as u(b)),
entry_keys as (select l_suppkey, min(l_partkey) as first_part from lineitem group by l_suppkey),
entries as (
  select 's' || l_suppkey as data_source_id, system, first_part, (l_suppkey + shift) % 7 as form,
         case when (l_suppkey + shift) % 7 = 1 then 'renamed' when (l_suppkey + shift) % 7 = 6 then 'Bad Db' end as database_name
  from entry_keys, (values ('sysa', 0), ('sysb', 3)) as v(system, shift)),
expanded as (
  select t.table_id, e.system, t.data_source_id, coalesce(e.database_name, t.data_source_id) as physical_database_name,
         t.schema_name as physical_schema_name, t.table_name as physical_table_name, e.form
  from entries e join src_tables t on e.data_source_id = t.data_source_id where form in (0, 1)
  union all
  select t.table_id, e.system, t.data_source_id, t.data_source_id, 'ren0', t.table_name, e.form
  from entries e join src_tables t on e.data_source_id = t.data_source_id where form = 2 and schema_name = 'b0'
  union all
  select t.table_id, e.system, t.data_source_id, t.data_source_id, t.schema_name, 'phys_' || e.first_part, e.form
  from entries e join src_tables t on e.data_source_id = t.data_source_id and t.l_partkey = e.first_part where form = 3)
"""


def source_tables(spark, d) -> DataFrame:
    pairs = table(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    source = F.concat(F.lit("s"), text("l_suppkey"))
    schema = F.concat(F.lit("b"), text(mod("l_partkey", 3)))
    name = F.concat(F.lit("t"), text("l_partkey"))
    return pairs.where(mod("l_suppkey", 11) != 0).select(
        F.concat_ws(".", source, schema, name).alias("table_id"),
        source.alias("data_source_id"), schema.alias("schema_name"), name.alias("table_name"),
    )


def source_schemas(spark, d) -> DataFrame:
    names = F.array(*[F.lit(x) for x in ("b0", "b1", "b2", "bempty")])
    return table(spark, d, "supplier").select(
        F.concat(F.lit("s"), text("s_suppkey")).alias("data_source_id"), F.explode(names).alias("schema_name")
    )


def placement_entries(spark, d) -> DataFrame:
    """Two entries per supplier that delivered anything, in one of seven forms."""
    firsts = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.min("l_partkey").alias("first_part"))
    venues = F.array(
        *[F.struct(F.lit(s).alias("system"), F.lit(n).alias("shift")) for s, n in (("sysa", 0), ("sysb", 3))]
    )
    rows = firsts.withColumn("v", F.explode(venues)).withColumn("form", mod(F.col("l_suppkey") + F.col("v.shift"), 7))
    no_tables = F.lit(None).cast("map<string,string>")
    no_name = F.lit(None).cast("string")

    def want(name, tables_map):
        return F.struct(name.alias("name"), tables_map.alias("tables"))

    part = text("first_part")
    listed = F.create_map(
        F.concat(F.lit("t"), part), F.concat(F.lit("phys_"), part),
        F.lit("tghost"), F.lit("x"), F.lit("tbad"), F.lit("Bad Name"),
    )
    form = F.col("form")
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<struct<name:string,tables:map<string,string>>>"))
    wanted = (
        F.when(form == 2, F.create_map(F.lit("b0"), want(F.lit("ren0"), no_tables)))
        .when(form == 3, F.create_map(F.concat(F.lit("b"), text(mod("first_part", 3))), want(no_name, listed)))
        .when(form == 4, F.create_map(F.lit("nope"), want(F.lit("x"), no_tables)))
        .when(form == 5, empty)
        .when(form == 6, F.create_map(F.lit("bempty"), want(no_name, no_tables)))
    )
    return rows.select(
        F.concat(F.lit("s"), text("l_suppkey")).alias("data_source_id"),
        F.col("v.system").alias("system"),
        F.when(form == 1, "renamed").when(form == 6, "Bad Db").alias("database_name"),
        wanted.alias("schemas"),
        "form",
        "first_part",
    )


# --- versions: a few per order, some orders deleted in the end ----------------

VERSIONS_SQL = """
all_versions as (
  select o_orderkey, i, o_orderkey % 4 as n, o_orderdate as insert_ts, o_orderdate + i * interval 1 day as update_ts,
         case when i < o_orderkey % 4 or o_orderkey % 11 = 0 then o_orderdate + (i + 1) * interval 1 day end as end_ts,
         case when i > 0 then 'fix ' || i end as update_reason, o_totalprice + i as price
  from orders, unnest(range(0, o_orderkey % 4 + 1)) as u(i))
"""


def _all_versions(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    n = mod("o_orderkey", 4)
    v = o.select("o_orderkey", "o_orderdate", "o_totalprice", F.explode(F.sequence(F.lit(0).cast("bigint"), n)).alias("i"))
    day = F.make_dt_interval(F.col("i").cast("int"))
    next_day = F.make_dt_interval((F.col("i") + 1).cast("int"))
    closed = (F.col("i") < n) | (mod("o_orderkey", 11) == 0)
    return v.select(
        "o_orderkey",
        "i",
        F.col("o_orderdate").alias("insert_ts"),
        (F.col("o_orderdate") + day).alias("update_ts"),
        F.when(closed, F.col("o_orderdate") + next_day).alias("end_ts"),
        F.when(F.col("i") > 0, F.concat(F.lit("fix "), text("i"))).alias("update_reason"),
        (F.col("o_totalprice") + F.col("i")).alias("price"),
    )


def version_history(spark, d) -> DataFrame:
    return _all_versions(spark, d).where(F.col("end_ts").isNotNull())


def version_current(spark, d) -> DataFrame:
    return _all_versions(spark, d).where(F.col("end_ts").isNull()).drop("end_ts")
