"""Queries on snapshots, changes, history and loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.issues import union_issues, wave_status
from catalith.operators import diff as X
from catalith.operators import history as Y
from catalith.operators import invariants as B
from catalith.plans import views as V
from catalith.plans.hierarchy_queries import BRIEF
from catalith.plans.registry import query

WITH = f"with {V.SNAPSHOTS_SQL}"
RUN_TS = "2024-03-01 12:00:00"


def _changes(spark, d):
    return X.snapshot_diff(V.new_orders(spark, d), V.current_orders(spark, d), V.SNAPSHOT_KEY, V.SNAPSHOT_CONTENT)


def _money(col: str):
    return F.col(col).cast("decimal(18,2)").cast("string")


@query(
    "diff_classify",
    f"""{WITH} select op, o_orderkey, cast(cast(old_price as decimal(18,2)) as varchar) as old_price,
    cast(cast(new_price as decimal(18,2)) as varchar) as new_price, old_priority, new_priority from changes""",
)
def diff_classify(spark, d):
    return _changes(spark, d).select(
        "op", "o_orderkey", _money("old.o_totalprice").alias("old_price"), _money("new.o_totalprice").alias("new_price"),
        F.col("old.o_orderpriority").alias("old_priority"), F.col("new.o_orderpriority").alias("new_priority"),
    )


@query(
    "content_changed",
    f"""{WITH} select o_orderkey, (old_price is distinct from new_price or old_priority is distinct from new_priority
    or old_reason is distinct from new_reason) as changed from joined where old_key is not null and new_key is not null""",
)
def content_changed(spark, d):
    new, cur = V.new_orders(spark, d), V.current_orders(spark, d)
    both = new.select("o_orderkey", F.struct(*new.columns).alias("n")).join(
        cur.select("o_orderkey", F.struct(*cur.columns).alias("c")), "o_orderkey"
    )
    return both.select("o_orderkey", X.content_changed(F.col("c"), F.col("n"), V.SNAPSHOT_CONTENT).alias("changed"))


@query("diff_summary", f"{WITH} select 'orders' as \"table\", op, count(*) as n from changes group by op")
def diff_summary(spark, d):
    return X.diff_summary({"orders": _changes(spark, d)})


@query(
    "reason_discipline",
    f"""{WITH} select 'reason_discipline' as rule, cast(o_orderkey as varchar) as object_key,
    case op when 'insert' then 'reason on insert' else 'update without reason' end as detail from changes
    where (op = 'insert' and new_reason is not null) or (op = 'update' and coalesce(trim(new_reason), '') = '')""",
)
def reason_discipline(spark, d):
    return X.reason_discipline(_changes(spark, d), ["o_orderkey"], "orders").select(*BRIEF)


@query(
    "mass_delete_guard",
    f"""{WITH} select d as deletes, c as current_rows, d >= 20 and d > 0.05 * c as violation
    from (select count(*) as d from changes where op = 'delete'), (select count(*) as c from cur)""",
)
def mass_delete_guard(spark, d):
    return X.mass_delete_guard([_changes(spark, d)], [V.current_orders(spark, d)], fraction=0.05)


@query(
    "history_rows",
    f"""{WITH} select o_orderkey, old_priority as o_orderpriority, '{RUN_TS}' as end_ts from changes where op <> 'insert'""",
)
def history_rows(spark, d):
    rows = Y.history_rows(_changes(spark, d), F.lit(RUN_TS).cast("timestamp_ntz"))
    return rows.select("o_orderkey", "o_orderpriority", F.date_format("end_ts", "yyyy-MM-dd HH:mm:ss").alias("end_ts"))


@query(
    "apply_changes",
    f"""{WITH} select n.o_orderkey, n.o_orderpriority,
    case when h.op = 'update' then n.update_reason end as update_reason,
    case when h.op = 'insert' then '{RUN_TS}' else '2024-01-01 00:00:00' end as insert_ts,
    case when h.op is null then '2024-01-01 00:00:00' else '{RUN_TS}' end as update_ts
    from new n left join changes h on n.o_orderkey = h.o_orderkey""",
)
def apply_changes(spark, d):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    cur = V.current_orders(spark, d).withColumns({"insert_ts": start, "update_ts": start})
    changes = X.snapshot_diff(V.new_orders(spark, d), cur, V.SNAPSHOT_KEY, V.SNAPSHOT_CONTENT)
    after = Y.apply_changes(cur, changes, V.SNAPSHOT_KEY, F.lit(RUN_TS).cast("timestamp_ntz"))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return after.select("o_orderkey", "o_orderpriority", "update_reason", stamp("insert_ts"), stamp("update_ts"))


@query(
    "validated_ts",
    f"""select o_orderkey, case when o_orderkey % 3 <> 0 then case when o_orderkey % 2 = 0 and o_orderkey % 5 <> 0
      then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') else '{RUN_TS}' end end as validated_ts from orders""",
)
def validated_ts(spark, d):
    o = V.table(spark, d, "orders")
    old_ts = F.when((V.mod("o_orderkey", 2) == 0) & (V.mod("o_orderkey", 5) != 0), F.col("o_orderdate"))
    stamp = Y.validated_stamp(
        V.mod("o_orderkey", 2) == 0, old_ts, V.mod("o_orderkey", 3) != 0, F.lit(RUN_TS).cast("timestamp_ntz")
    )
    return o.select("o_orderkey", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("validated_ts"))


@query(
    "append_audit",
    f"""{WITH} select cast(7 as bigint) as load_id, 'abc123' as commit_sha,
    count(*) filter (where op = 'insert') as inserts, count(*) filter (where op = 'update') as updates,
    count(*) filter (where op = 'delete') as deletes, false as reset_history, '{RUN_TS}' as loaded_ts from changes""",
)
def append_audit(spark, d):
    row = Y.audit_row([_changes(spark, d)], 7, "abc123", F.lit(RUN_TS).cast("timestamp_ntz"))
    return row.withColumn("loaded_ts", F.date_format("loaded_ts", "yyyy-MM-dd HH:mm:ss"))


@query(
    "relation_counts",
    "select 'customer' as \"table\", count(*) as n from customer union all select 'orders', count(*) from orders"
    " union all select 'lineitem', count(*) from lineitem",
)
def relation_counts(spark, d):
    return X.relation_counts({n: V.table(spark, d, n) for n in ("customer", "orders", "lineitem")})


@query(
    "wave_gate",
    f"""{WITH}, counts as (select 0 as wave_1, (select count(*) from orders where o_orderkey % 20 = 0) as wave_2,
      (select count(*) from changes where op = 'update' and coalesce(new_reason, '') = '') as wave_3)
    select 1 as wave, cast(wave_1 as bigint) as n_issues, 'passed' as status from counts
    union all select 2, wave_2, 'failed' from counts
    union all select 3, wave_3, 'not reached' from counts""",
)
def wave_gate(spark, d):
    from catalith.issues import as_issues

    late = X.reason_discipline(_changes(spark, d).where(F.col("op") == "update"), ["o_orderkey"], "orders")
    tens = V.table(spark, d, "orders").where(V.mod("o_orderkey", 20) == 0)
    early = as_issues(tens, "round_key", "orders", V.text("o_orderkey"), F.lit(""), wave=2)
    return wave_status(union_issues(early, late))


# --- history ------------------------------------------------------------------


@query(
    "history_walk",
    f"""with {V.VERSIONS_SQL}
    select o_orderkey, i, update_reason,
      case when end_ts is null then 'current' when i = n then 'deleted' else 'replaced' end as outcome,
      lead(update_reason) over (partition by o_orderkey order by i) as end_reason from all_versions""",
)
def history_walk(spark, d):
    walked = Y.history_walk(V.version_current(spark, d), V.version_history(spark, d), ["o_orderkey"])
    return walked.select("o_orderkey", "i", "update_reason", "outcome", "end_reason")


@query(
    "as_of",
    f"""with {V.VERSIONS_SQL} select o_orderkey, i, cast(cast(price as decimal(18,2)) as varchar) as price from all_versions
    where update_ts <= timestamp '1998-06-15 00:00:00' and (end_ts is null or end_ts > timestamp '1998-06-15 00:00:00')""",
)
def as_of(spark, d):
    rows = Y.as_of(V.version_current(spark, d), V.version_history(spark, d), "1998-06-15 00:00:00")
    return rows.select("o_orderkey", "i", _money("price").alias("price"))


MOMENTS_SQL = """moments as (select l_orderkey as o_orderkey, l_linenumber, l_partkey, l_suppkey,
    l_shipdate - (l_linenumber * 2000) * interval 1 hour as moment from lineitem)"""


@query(
    "as_of_moments",
    f"""with {V.VERSIONS_SQL}, {MOMENTS_SQL}
    select m.o_orderkey, l_linenumber, l_partkey, l_suppkey, i, cast(cast(price as decimal(18,2)) as varchar) as price, v.o_orderkey is not null as found
    from moments m left join all_versions v on m.o_orderkey = v.o_orderkey and v.update_ts <= moment and (end_ts is null or end_ts > moment)""",
)
def as_of_moments(spark, d):
    """Every line asks how its order stood some weeks around the time it was shipped."""
    back = F.make_dt_interval(F.lit(0), F.col("l_linenumber") * 2000)
    moments = V.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_shipdate") - back).alias("moment")
    )
    rows = Y.as_of_moments(V.version_current(spark, d), V.version_history(spark, d), ["o_orderkey"], moments, "moment")
    return rows.select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "i", _money("price").alias("price"), "found")


@query(
    "commit_of_row",
    """with runs as (select distinct o_orderdate as loaded_ts from orders),
    written as (select o_orderkey, o_orderdate + (case when o_orderkey % 5 = 0 then 1 else 0 end) * interval 1 hour as update_ts
      from orders)
    select o_orderkey, 'run ' || strftime(loaded_ts, '%Y-%m-%d') as commit_sha
    from written left join runs on update_ts = loaded_ts""",
)
def commit_of_row(spark, d):
    o = V.table(spark, d, "orders")
    audit = o.select(F.col("o_orderdate").alias("loaded_ts")).distinct()
    audit = audit.select(
        "loaded_ts",
        F.unix_seconds(F.col("loaded_ts").cast("timestamp")).alias("load_id"),
        F.concat(F.lit("run "), F.date_format("loaded_ts", "yyyy-MM-dd")).alias("commit_sha"),
    )
    late = F.make_dt_interval(F.lit(0), F.when(V.mod("o_orderkey", 5) == 0, 1).otherwise(0))
    rows = o.select("o_orderkey", (F.col("o_orderdate") + late).alias("update_ts"))
    return Y.commit_of_row(rows, audit).select("o_orderkey", "commit_sha")


@query(
    "latest_load",
    """with last as (select event_id, event_type from events order by ts desc, event_id desc limit 1)
    select event_id as load_id, event_type as commit_sha, event_type <> 'purchase' as is_behind from last""",
)
def latest_load(spark, d):
    e = V.table(spark, d, "events")
    audit = e.select(
        F.col("event_id").alias("load_id"), F.col("event_type").alias("commit_sha"), F.col("ts").alias("loaded_ts")
    )
    return Y.latest_load(audit, "purchase").select("load_id", "commit_sha", "is_behind")


# --- stored-row invariants -----------------------------------------------------


@query(
    "reason_pairing",
    f"""with {V.VERSIONS_SQL}, bent as (select o_orderkey, i, case when o_orderkey % 17 = 0 and i = 0 then 'early'
      when o_orderkey % 19 = 0 then null else update_reason end as update_reason from all_versions where end_ts is null)
    select 'reason_pairing' as rule, cast(o_orderkey as varchar) as object_key, coalesce(update_reason, '(none)') as detail
    from bent where (update_reason is null) <> (i = 0)""",
)
def reason_pairing(spark, d):
    k = "o_orderkey"
    reason = (
        F.when((V.mod(k, 17) == 0) & (F.col("i") == 0), "early").when(V.mod(k, 19) == 0, F.lit(None))
        .otherwise(F.col("update_reason"))
    )
    rows = V.version_current(spark, d).withColumn("update_reason", reason)
    return B.reason_pairing(rows, "orders", V.text(k)).select(*BRIEF)


@query(
    "validated_pairing",
    f"""with {V.RELATIONSHIPS_SQL} select 'validated_pairing' as rule, rel_key as object_key,
    case when validated then 'true' else 'false' end as detail
    from relationships where validated <> (l_orderkey % 6 <> 0)""",
)
def validated_pairing(spark, d):
    stamp = F.when(V.mod("l_orderkey", 6) != 0, F.lit(RUN_TS).cast("timestamp_ntz"))
    rows = V.relationships(spark, d).withColumn("validated_ts", stamp)
    return B.validated_pairing(rows, "table_relationships", F.col("rel_key")).select(*BRIEF)


@query(
    "not_null",
    f"""with {V.RELATIONSHIPS_SQL}
    select 'not_null' as rule, rel_key as object_key, 'use_when' as detail from relationships where use_when is null
    union all select 'not_null', rel_key, 'cardinality' from relationships where cardinality is null""",
)
def not_null(spark, d):
    rows = V.relationships(spark, d)
    return B.not_null(rows, ["use_when", "cardinality", "table_a_id"], "table_relationships", F.col("rel_key")).select(*BRIEF)


@query(
    "unique_run_ts",
    """select 'unique_run_ts' as rule, strftime(day, '%Y-%m-%d') as object_key, cast(n as varchar) as detail
    from (select date_trunc('day', ts) as day, count(*) as n from events group by 1 having count(*) > 1)""",
)
def unique_run_ts(spark, d):
    audit = V.table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("loaded_ts"))
    return B.unique_run_ts(audit).select(*BRIEF)


@query(
    "history_key_unique",
    """select 'history_key_unique' as rule, user_id || '|' || strftime(day, '%Y-%m-%d') as object_key, cast(n as varchar) as detail
    from (select user_id, date_trunc('day', ts) as day, count(*) as n from events group by 1, 2 having count(*) > 1)""",
)
def history_key_unique(spark, d):
    history = V.table(spark, d, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("end_ts"))
    return B.history_key_unique(history, ["user_id"], "events").select(*BRIEF)


@query(
    "enum_check",
    f"""with {V.RELATIONSHIPS_SQL} select 'enum_check' as rule, rel_key as object_key, cardinality as detail from relationships
    where cardinality not in ('one_to_one', 'one_to_many', 'many_to_one', 'many_to_many')""",
)
def enum_check(spark, d):
    from catalith.specs import CARDINALITIES

    rows = V.relationships(spark, d)
    return B.enum_check(rows, "cardinality", CARDINALITIES, "table_relationships", F.col("rel_key")).select(*BRIEF)


@query(
    "drop_needs_reason",
    """select 'drop_needs_reason' as rule, cast(o_orderkey as varchar) as object_key, 'no notes' as detail from orders
    where o_orderkey % 3 = 0 and o_orderkey % 4 < 2""",
)
def drop_needs_reason(spark, d):
    k = "o_orderkey"
    rows = V.table(spark, d, "orders").select(
        k,
        F.when(V.mod(k, 3) != 0, "a.b.c.d").alias("target_expression"),
        F.when(V.mod(k, 4) == 0, F.lit(None)).when(V.mod(k, 4) == 1, " \t\n").otherwise("known gap").alias("notes"),
    )
    return B.drop_needs_reason(rows, "target_expression", "notes", "column_mappings", V.text(k)).select(*BRIEF)
