"""Queries that run the load steps themselves: parsing, publishing, re-running."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder
from catalith.operators import diff as X
from catalith.operators import history as Y
from catalith.plans import views as V
from catalith.plans.registry import query
from catalith.sources import contract_csv as S5
from catalith.sources import documents as S4
from catalith.sources.state import conform
from catalith.sources.store import Store
from catalith.specs import RELATIONS


@query(
    "read_corpus_documents",
    """with docs as (select page_id, 'p' || page_id as rel from pages)
    select rel, cast(0 as integer) as row_no, cast(null as varchar) as table_name, case when page_id % 7 = 0 then 'repeated key table_name'
      else 'expected a list' end as error from docs where page_id % 7 = 0 or page_id % 11 = 0
    union all select rel, 0, 't' || page_id, null from docs where page_id % 7 <> 0 and page_id % 11 <> 0
    union all select rel, 1, null, 'expected a mapping per row' from docs where page_id % 7 <> 0 and page_id % 11 <> 0
    union all select rel, 2, 'u' || page_id, null from docs where page_id % 7 <> 0 and page_id % 11 <> 0""",
)
def read_corpus_documents(spark, d):
    """One YAML document per page: three rows, of which one is bad; some whole documents are bad."""
    k = V.text("page_id")
    good = F.concat(
        F.lit("- table_name: t"), k, F.lit("\n  description: 'a: b'\n- 17\n- {table_name: u"), k, F.lit("}\n")
    )
    twice = F.concat(F.lit("- table_name: a"), k, F.lit("\n  table_name: b\n"))
    no_list = F.concat(F.lit("table_name: a"), k, F.lit("\n"))
    content = (
        F.when(V.mod("page_id", 7) == 0, twice).when(V.mod("page_id", 11) == 0, no_list).otherwise(good)
    )
    files = V.table(spark, d, "pages").select(
        F.concat(F.lit("p"), k).alias("rel"), F.lit("tables").alias("file_type"), F.lit("src").alias("data_source"),
        F.lit("sch").alias("schema"), F.encode(content, "UTF-8").alias("content"),
    )
    rows = S4.read_documents(files)
    return rows.select("rel", "row_no", F.try_element_at("body", F.lit("table_name")).alias("table_name"), "error")


@query(
    "scan_contract_csv",
    """select 'p' || page_id as "table", cast(line as integer) as line_no,
      case line when 0 then '' when 1 then 'code|text' when 2 then page_id || '|two' || chr(10) || 'lines' else cast(page_id as varchar) end as cells,
      case when line = 0 then 'empty file' end as error
    from pages, (values (0), (1), (2), (3)) as v(line) where (page_id % 5 = 0) = (line = 0)""",
)
def scan_contract_csv(spark, d):
    """One CSV file per page with a quoted line break and a ragged row; each fifth file is empty."""
    k = V.text("page_id")
    content = F.when(V.mod("page_id", 5) == 0, "").otherwise(
        F.concat(F.lit("﻿code,text\r\n"), k, F.lit(',"two\nlines"\r\n'), k, F.lit("\r\n"))
    )
    name = F.concat(F.lit("p"), k)
    files = V.table(spark, d, "pages").select(
        F.concat(F.lit("codes/"), name, F.lit(".csv")).alias("path"), F.lit("codes").alias("schema"), name.alias("table"),
        F.encode(content, "UTF-8").alias("content"),
    )
    cells = S5.scan_contract_csv(files)
    return cells.select("table", "line_no", F.coalesce(F.array_join("cells", "|"), F.lit("")).alias("cells"), "error")


@query(
    "key_change",
    """select case when b = 0 then 'delete' else 'insert' end as op, o_orderkey + b * 1000000000000 as o_orderkey
    from orders, (values (0), (1)) as v(b) where o_orderkey % 6 = 0""",
)
def key_change(spark, d):
    """A row whose key changes is one delete and one insert, never an update."""
    cur = V.table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    moved = F.when(V.mod("o_orderkey", 6) == 0, F.col("o_orderkey") + 1_000_000_000_000).otherwise(F.col("o_orderkey"))
    return X.snapshot_diff(cur.withColumn("o_orderkey", moved), cur, ["o_orderkey"], ["o_orderpriority"]).select(
        "op", "o_orderkey"
    )


@query("idempotent_rerun", "select cast(0 as bigint) as n_changes, count(*) as n_rows from orders where o_orderkey % 10 <> 1")
def idempotent_rerun(spark, d):
    """After a snapshot is applied, comparing it again finds nothing."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    new = V.new_orders(spark, d).withColumn("update_reason", F.lit(None).cast("string"))
    cur = V.current_orders(spark, d).withColumns({"insert_ts": start, "update_ts": start})
    changes = X.snapshot_diff(new, cur, V.SNAPSHOT_KEY, V.SNAPSHOT_CONTENT)
    after = Y.apply_changes(cur, changes, V.SNAPSHOT_KEY, start)
    again = X.snapshot_diff(new, after, V.SNAPSHOT_KEY, V.SNAPSHOT_CONTENT)
    # One aggregate over both sides: nothing is crossed or collected.
    tagged = again.select(F.lit(1).alias("c"), F.lit(0).alias("r")).union(after.select(F.lit(0), F.lit(1)))
    return tagged.agg(F.sum("c").alias("n_changes"), F.sum("r").alias("n_rows"))


def _publish(store: Store, name: str, new, load_id: int, stamp: str, reset: bool = False, write: bool = True):
    """One run over one relation: only buckets whose digest changed are compared. The changes."""
    spec = RELATIONS[name]
    ts = F.lit(stamp).cast("timestamp")
    last = store.last_load()
    digests = {r["bucket"]: r["digest"] for r in store.digests(spec, new).collect()}  # one row a bucket
    buckets = store.changed_buckets(spec, digests, last)
    touched = new.where(store.bucket_of(spec).isin(*buckets)) if buckets else new.where(F.lit(False))
    # Buckets, state, history and audit all read the changes: they are computed once.
    changes = stage(X.diff_relation(spec, touched, store.state(spec, last, buckets)), staging_folder(store.spark), "changes")
    if write:
        store.publish(
            load_id,
            {name: changes},
            lambda spec, current, change: Y.apply_changes(current, change, list(spec.key), ts),
            {name: Y.history_rows(changes, ts)},
            Y.audit_row([changes], load_id, f"c{load_id}", ts, reset),
            {name: digests},
        )
    return changes


def _customers(spark, d):
    """Customers as rows of `tables`, as delivered first and later: a fifth gone, a seventh renamed."""
    spec = RELATIONS["tables"]
    rows = V.table(spark, d, "customer").select(
        "c_custkey",
        F.concat(F.lit("t.s.c"), V.text("c_custkey")).alias("table_id"),
        F.lit("t.s").alias("schema_id"),
        F.concat(F.lit("c"), V.text("c_custkey")).alias("table_name"),
        F.col("c_name").alias("description"),
    )
    renamed = F.when(V.mod("c_custkey", 7) == 0, F.concat(F.lit("new "), "description")).otherwise(F.col("description"))
    later = rows.where(V.mod("c_custkey", 5) != 0).withColumn("description", renamed)
    return conform(rows, spec), conform(later, spec)


def _after(spark, d, *runs: str) -> Store:
    """A fresh store after runs of the `first` and `later` delivery; a run marked `!` resets the history."""
    store = Store(spark, staging_folder(spark), buckets=8)
    first, later = _customers(spark, d)
    for i, run in enumerate(runs, 1):
        _publish(store, "tables", first if run.startswith("first") else later, i, f"2024-01-01 {i:02d}:00:00", run.endswith("!"))
    return store


@query(
    "publish_snapshot",
    """select 'state' as place, 't.s.c' || c_custkey as table_id, case when c_custkey % 7 = 0 then 'new ' || c_name else c_name end as description,
      case when c_custkey % 7 = 0 then '02' else '01' end as hour from customer where c_custkey % 5 <> 0
    union all select 'history', 't.s.c' || c_custkey, c_name, '02' from customer where c_custkey % 5 = 0 or c_custkey % 7 = 0""",
)
def publish_snapshot(spark, d):
    """Two runs into a fresh store, then its state and history read back."""
    store, spec = _after(spark, d, "first", "later"), RELATIONS["tables"]
    state = store.state(spec).select(
        F.lit("state").alias("place"), "table_id", "description", F.date_format("update_ts", "HH").alias("hour")
    )
    closed = store.history(spec).select(F.lit("history"), "table_id", "description", F.date_format("end_ts", "HH"))
    return state.union(closed)


@query(
    "unchanged_rerun",
    """select load_id, case load_id when 1 then count(*) else 0 end as inserts,
      case load_id when 2 then count(*) filter (where c_custkey % 7 = 0 and c_custkey % 5 <> 0) else 0 end as updates,
      case load_id when 2 then count(*) filter (where c_custkey % 5 = 0) else 0 end as deletes
    from customer, (values (1), (2), (3)) as v(load_id) group by load_id""",
)
def unchanged_rerun(spark, d):
    """The audit of three runs, of which the last delivers what is there: its digests are equal, nothing is joined."""
    return _after(spark, d, "first", "later", "later").audit().select(
        F.col("load_id").cast("int").alias("load_id"), "inserts", "updates", "deletes"
    )


@query(
    "store_history",
    """select 't.s.c' || c_custkey as table_id, case when run = 3 and c_custkey % 7 = 0 then 'new ' || c_name else c_name end as description,
      '0' || run as hour from customer, (values (2), (3)) as v(run)
    where case run when 2 then c_custkey % 5 = 0 or c_custkey % 7 = 0 else c_custkey % 7 = 0 and c_custkey % 5 <> 0 end""",
)
def store_history(spark, d):
    """Versions that the second and the third of three runs closed."""
    closed = _after(spark, d, "first", "later", "first").history(RELATIONS["tables"])
    return closed.select("table_id", "description", F.date_format("end_ts", "HH").alias("hour"))


@query(
    "reset_history",
    """select 't.s.c' || c_custkey as table_id, 'new ' || c_name as description from customer where c_custkey % 7 = 0 and c_custkey % 5 <> 0""",
)
def reset_history(spark, d):
    """The third run drops what the second closed, and keeps what it closes itself."""
    return _after(spark, d, "first", "later", "first!").history(RELATIONS["tables"]).select("table_id", "description")


@query(
    "dry_run",
    """select 'change' as place, case when c_custkey % 5 = 0 then 'delete' else 'update' end as what, 't.s.c' || c_custkey as table_id from customer
      where c_custkey % 5 = 0 or c_custkey % 7 = 0
    union all select 'state', c_name, 't.s.c' || c_custkey from customer
    union all select 'run', cast(1 as varchar), null""",
)
def dry_run(spark, d):
    """What a later delivery would change, and that the store is as before."""
    store, spec = _after(spark, d, "first"), RELATIONS["tables"]
    changes = _publish(store, "tables", _customers(spark, d)[1], 2, "2024-01-01 02:00:00", write=False)
    rows = changes.select(F.lit("change").alias("place"), F.col("op").alias("what"), "table_id")
    state = store.state(spec).select(F.lit("state"), "description", "table_id")
    runs = store.audit().agg(F.max("load_id").cast("string").alias("n")).select(F.lit("run"), "n", F.lit(None).cast("string"))
    return rows.union(state).union(runs)


@query(
    "read_state",
    f"""with {V.CONCEPTS_SQL} select concept_id, coalesce(array_to_string(case when o_orderkey % 3 = 0 then related_object_ids end, ','), '')
    as links, cast(null as varchar) as label from concepts""",
)
def read_state(spark, d):
    """Concepts published, and read back as declared: a column that was not delivered, and lists that were absent."""
    spec = RELATIONS["concepts"]
    links = F.when(V.mod("o_orderkey", 3) == 0, F.col("related_object_ids"))
    given = conform(V.concepts(spark, d).select("concept_id", links.alias("related_object_ids")), spec)
    store = Store(spark, staging_folder(spark), buckets=8)
    _publish(store, "concepts", given, 1, "2024-01-01 01:00:00")
    return store.state(spec).select("concept_id", F.array_join("related_object_ids", ",").alias("links"), "label")
