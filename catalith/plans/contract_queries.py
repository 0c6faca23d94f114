"""Queries on files, contracts, freshness and manifests."""

from __future__ import annotations

from functools import reduce

from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.checkpoints import staging_folder
from catalith.operators import code_sets as K
from catalith.operators import contract as C
from catalith.plans import views as V
from catalith.plans.code_set_load import load_delivery
from catalith.plans.hierarchy_queries import BRIEF
from catalith.plans.registry import query
from catalith.sources import documented as S8
from catalith.sources import files as S
from catalith.sources.code_sets import CodeSets, TableShape

# Relative paths by form, and what each is: (path, type, problem).
PATH_FORMS = {
    0: ("systems.yaml", "systems", None),
    1: ("sources/src{i}/data_source.yaml", "data_source", None),
    2: ("sources/src{i}/deployments.yaml", "deployments", None),
    3: ("sources/src{i}/concepts.yaml", "concepts", None),
    4: ("sources/src{i}/concepts/part{i}.yaml", "concepts", None),
    5: ("sources/src{i}/sch/tables.yaml", "tables", None),
    6: ("sources/src{i}/sch/columns/c{i}.yaml", "columns", None),
    7: ("sources/src{i}/sch/mappings/m{i}.yaml", "column_mappings", None),
    8: ("sources/src{i}/mappings/m{i}.yaml", None, "mappings folder at source level"),
    9: ("sources/src{i}/columns/c{i}.yaml", None, "shard folder at source level"),
    10: ("other/src{i}/data_source.yaml", None, "outside the sources folder"),
    11: ("sources/Src{i}/data_source.yaml", None, "illegal source label"),
    12: ("sources/src{i}/concept/tables.yaml", None, "reserved schema name"),
    13: ("sources/src{i}/sch/mappings/concepts.yaml", None, "concepts file at an unsupported depth"),
    14: ("sources/src{i}/sch/odd.yaml", None, "unrecognised location"),
    15: ("sources/src{i}/sch/columns/C{i}.yaml", None, "illegal file label"),
    16: ("sources/src{i}/sch/tables.yml", None, "unrecognised location"),
    17: ("sources/src{i}/sch/columns/x{i}.YAML", "columns", None),
    18: ("sources/src{i}/sch/tables/t{i}.yaml", "tables", None),
    19: ("sources/src{i}/README.md", None, "unrecognised location"),
}
SHARDS = (4, 6, 17, 18)


def _forms_sql(values: dict[int, str | None]) -> str:
    cases = " ".join(f"when {k} then replace('{v}', '{{i}}', cast(page_id // 40 as varchar))" for k, v in values.items() if v)
    return f"case page_id % 20 {cases} end"


FILES_SQL = f"""files as (select page_id, page_id % 20 as form, {_forms_sql({k: v[0] for k, v in PATH_FORMS.items()})} as rel,
  {_forms_sql({k: v[1] for k, v in PATH_FORMS.items()})} as file_type,
  {_forms_sql({k: v[2] for k, v in PATH_FORMS.items()})} as problem, html from pages)"""


def _files(spark, d):
    forms = F.create_map(*[F.lit(x) for k, v in PATH_FORMS.items() for x in (k, v[0])])
    pages = V.table(spark, d, "pages")
    index = F.floor(F.col("page_id") / 40).cast("bigint").cast("string")
    rel = F.replace(F.element_at(forms, V.mod("page_id", 20).cast("int")), F.lit("{i}"), index)
    return pages.select("page_id", rel.alias("rel"), "html")


TREE_SQL = """tree as (select *, string_split(url, '/')[3] as host, page_id % 3 as level,
    'w/' || host || case page_id % 3 when 0 then '' when 1 then '/d' || (page_id % 7) else '/d' || (page_id % 7) || '/e' end
      || '/p' || page_id || case when page_id % 5 = 0 then '.HTML' else '.html' end as rel,
    case when page_id % 11 = 0 then '' else html end as body from pages)"""


def _write_tree(pages, root: str) -> None:
    """One file per row (rel, body), written inside tasks; a task that runs again writes the same files."""

    def run(batches):
        fs, top = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for rel, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs.create_dir(f"{top}/{rel}".rpartition("/")[0], recursive=True)
                with fs.open_output_stream(f"{top}/{rel}") as f:
                    f.write(body.encode())
            yield batch.select([0])

    pages.select("rel", "body").mapInArrow(run, "rel string").write.format("noop").mode("overwrite").save()


@query(
    "scan_files",
    f"""with {TREE_SQL} select rel, cast(len(string_split(rel, '/')) as bigint) as n_parts, string_split(rel, '/')[-1] as file_name,
    regexp_extract(rel, '(\\.[^.]*)$', 1) as ext, cast(strlen(body) as bigint) as length, sha256(body) as sha256 from tree""",
)
def scan_files(spark, d):
    """A tree of files written from the pages, some of them empty, and scanned again."""
    k = "page_id"
    host = F.get(F.split("url", "/"), F.lit(2))
    deep = F.concat(F.lit("/d"), V.text(V.mod(k, 7)))
    place = F.when(V.mod(k, 3) == 0, "").when(V.mod(k, 3) == 1, deep).otherwise(F.concat(deep, F.lit("/e")))
    ext = F.when(V.mod(k, 5) == 0, ".HTML").otherwise(".html")
    rel = F.concat(F.lit("w/"), host, place, F.lit("/p"), V.text(k), ext)
    body = F.when(V.mod(k, 11) == 0, "").otherwise(F.col("html"))
    root = f"{staging_folder(spark)}/tree"
    _write_tree(V.table(spark, d, "pages").select(rel.alias("rel"), body.alias("body")), root)
    rows = S.content_hash(S.scan_files(spark, root))
    return rows.select("rel", F.size("rel_parts").cast("bigint").alias("n_parts"), "file_name", "ext", "length", "sha256")


@query(
    "classify_paths",
    f"""with {FILES_SQL} select page_id, rel, file_type, problem,
    form in ({", ".join(map(str, SHARDS))}, 15) as is_shard,
    case when problem is null and form <> 0 then string_split(rel, '/')[2] end as data_source,
    case when problem is null and form in (5, 6, 7, 17, 18) then 'sch' end as schema from files""",
)
def classify_paths(spark, d):
    return S.classify_paths(_files(spark, d)).select(
        "page_id", "rel", "file_type", "problem", "is_shard", "data_source", "schema"
    )


@query(
    "wrong_extension",
    f"""with {FILES_SQL} select 'wrong_extension' as rule, rel as object_key,
    case form when 16 then 'tables.yaml' else 'x' || (page_id // 40) || '.yaml' end as detail from files where form in (16, 17)""",
)
def wrong_extension(spark, d):
    return S.wrong_extension(_files(spark, d)).select(*BRIEF)


@query(
    "shard_form_conflict",
    f"""with {FILES_SQL} select distinct 'shard_form_conflict' as rule,
    'src' || (a.page_id // 40) || case a.form when 3 then '/concepts' else '/sch/tables' end as object_key,
    case a.form when 3 then 'concepts' else 'tables' end as detail
    from files a join files b on a.page_id // 40 = b.page_id // 40
    where (a.form = 3 and b.form = 4) or (a.form = 5 and b.form = 18)""",
)
def shard_form_conflict(spark, d):
    return S.shard_form_conflict(S.classify_paths(_files(spark, d))).select(*BRIEF)


@query(
    "content_hash",
    """select doc_id, sha256(text) as sha256, sha256(regexp_replace(text, '\\r\\n?', chr(10), 'g')) as text_sha256
    from documents""",
)
def content_hash(spark, d):
    docs = V.table(spark, d, "documents")
    plain = S.content_hash(docs.withColumn("content", F.encode("text", "UTF-8")))
    return plain.select("doc_id", "sha256", S.sha256_text(F.col("text")).alias("text_sha256"))


# --- contracts: one small table per part ------------------------------------------

HEADERS = {
    0: ["code", "description", "notes"],
    1: ["description", "code", "notes"],
    2: ["code", "code", "notes"],
    3: ["code", "extra"],
    4: ["code", "description", "notes"],
}
SHAPES_SQL = f"""
shapes as (select p_partkey, 't' || p_partkey as "table", p_partkey % 5 as form, 's' || (p_size % 3) as schema,
  case p_partkey % 5 {" ".join(f"when {k} then {v}" for k, v in HEADERS.items())} end as header from part),
live as (select "table", p_partkey, o as ordinal, c as name, o = 0 and p_partkey % 23 <> 0 as is_pk from shapes,
  (values (0, 'code'), (1, 'description'), (2, 'notes')) as v(o, c)),
docs as (select "table", p_partkey, c as name, schema, case when c = 'notes' and p_partkey % 29 = 0 then 'varchar' else 'text' end as type
  from shapes, (values ('code'), ('description'), ('notes')) as v(c) where p_partkey % 7 <> 0),
files as (select "table", schema as home, case when p_partkey % 17 = 0 then 'elsewhere' else schema end as schema,
    case when p_partkey % 17 = 0 then 'elsewhere' else schema end || '/' || "table" || '.csv' as path from shapes
    where p_partkey % 13 <> 0
  union all select "table", schema, 'zz', 'zz/' || "table" || '.csv' from shapes where p_partkey % 19 = 0 and p_partkey % 13 <> 0)
"""
WITH = f"with {SHAPES_SQL}"


def _shapes(spark, d):
    p = V.table(spark, d, "part")
    m = V.mod("p_partkey", 5)
    header = None
    for k, cols in HEADERS.items():
        value = F.array(*[F.lit(c) for c in cols])
        header = F.when(m == k, value) if header is None else header.when(m == k, value)
    return p.select(
        "p_partkey",
        F.concat(F.lit("t"), V.text("p_partkey")).alias("table"),
        F.concat(F.lit("s"), V.text(V.mod("p_size", 3))).alias("schema"),
        header.alias("header"),
    )


def _live(spark, d):
    cols = F.array(*[F.lit(c) for c in ("code", "description", "notes")])
    return _shapes(spark, d).select(
        "table", "p_partkey", F.posexplode(cols).alias("ordinal", "name")
    ).withColumn("is_pk", (F.col("ordinal") == 0) & (V.mod("p_partkey", 23) != 0))


def _docs(spark, d):
    cols = F.array(*[F.lit(c) for c in ("code", "description", "notes")])
    rows = _shapes(spark, d).where(V.mod("p_partkey", 7) != 0)
    rows = rows.select("table", "p_partkey", "schema", F.explode(cols).alias("name"))
    odd = (F.col("name") == "notes") & (V.mod("p_partkey", 29) == 0)
    return rows.withColumn("type", F.when(odd, "varchar").otherwise("text"))


def _delivered(spark, d):
    s = _shapes(spark, d).where(V.mod("p_partkey", 13) != 0)
    home = F.when(V.mod("p_partkey", 17) == 0, "elsewhere").otherwise(F.col("schema"))
    first = s.select("table", home.alias("schema"))
    again = s.where(V.mod("p_partkey", 19) == 0).select("table", F.lit("zz").alias("schema"))
    return first.union(again).withColumn("path", F.concat(F.concat_ws("/", "schema", "table"), F.lit(".csv")))


@query(
    "header_equals",
    f"""{WITH} select 'header_equals' as rule, "table" as object_key,
    case form when 1 then '2 differ from position 0' when 2 then '1 differ from position 1' else '2 differ from position 1' end as detail
    from shapes where form in (1, 2, 3)""",
)
def header_equals(spark, d):
    return C.header_equals(_shapes(spark, d), _live(spark, d)).select(*BRIEF)


@query(
    "docs_gate",
    f"""{WITH} select 'docs_gate' as rule, "table" as object_key, 'undocumented table:' as detail from shapes where p_partkey % 7 = 0
    union all select 'docs_gate', "table", 'repeated:code' from shapes where p_partkey % 7 <> 0 and form = 2
    union all select 'docs_gate', "table", 'undocumented:extra' from shapes where p_partkey % 7 <> 0 and form = 3
    union all select 'docs_gate', "table", 'documented but absent:description' from shapes where p_partkey % 7 <> 0 and form in (2, 3)
    union all select 'docs_gate', "table", 'documented but absent:notes' from shapes where p_partkey % 7 <> 0 and form = 3""",
)
def docs_gate(spark, d):
    return C.docs_gate(_shapes(spark, d), _docs(spark, d)).select(*BRIEF)


@query(
    "row_guardrail",
    """select 'row_guardrail' as rule, cast(l_suppkey as varchar) as object_key, cast(count(*) as varchar) as detail from lineitem
    group by l_suppkey having count(*) > 600""",
)
def row_guardrail(spark, d):
    rows = V.table(spark, d, "lineitem").select(V.text("l_suppkey").alias("table"))
    return C.row_guardrail(rows, 600).select(*BRIEF)


@query(
    "key_required",
    f"{WITH} select 'key_required' as rule, \"table\" as object_key, 'no key column' as detail from shapes where p_partkey % 23 = 0",
)
def key_required(spark, d):
    return C.key_required(_live(spark, d)).select(*BRIEF)


# Raw cells: three delivered tables made of the orders.
TABLES = [f"orders_{i}" for i in range(3)]
COLUMNS = [
    ("key", "integer", False, True), ("line", "smallint", False, False), ("amount", "real", True, False),
    ("day", "date", False, False), ("flag", "boolean", True, False),
]
AMOUNTS = {0: "5d", 1: "", 2: "12.50", 3: "-1e3", 4: "nan"}
DAYS = {0: "2024-1-5", 1: "20240101", 2: "2024-02-30", 3: "2024-01-05", 4: "2024-12-31", 5: ""}
FLAGS = {0: "yes", 1: "T", 2: "", 3: "false"}


def _case(n: int, values: dict[int, str]) -> str:
    return f"case o_orderkey % {n} " + " ".join(f"when {k} then '{v}'" for k, v in values.items()) + " end"


CELLS_SQL = f"""cells as (select o_orderkey, 'orders_' || (o_orderkey % 3) as "table", o_orderkey + 2 as line_no,
  case when o_orderkey % 6 = 0 then '0' || o_custkey else cast(o_custkey as varchar) end as key,
  case when o_orderkey % 31 = 0 then '99999' when o_orderkey % 37 = 0 then 'x' else cast(o_orderkey % 1000 as varchar) end as line,
  {_case(5, AMOUNTS)} as amount, {_case(6, DAYS)} as day, {_case(4, FLAGS)} as flag, o_orderkey % 29 = 0 as ragged from orders)"""
LINE = "\"table\" || '|' || line_no"


def _cells(spark, d):
    k = "o_orderkey"

    def pick(n, values):
        out = None
        for i, v in values.items():
            out = F.when(V.mod(k, n) == i, F.lit(v)) if out is None else out.when(V.mod(k, n) == i, F.lit(v))
        return out

    key = F.when(V.mod(k, 6) == 0, F.concat(F.lit("0"), V.text("o_custkey"))).otherwise(V.text("o_custkey"))
    line = F.when(V.mod(k, 31) == 0, "99999").when(V.mod(k, 37) == 0, "x").otherwise(V.text(V.mod(k, 1000)))
    four = F.array(key, line, pick(5, AMOUNTS), pick(6, DAYS))
    cells = F.when(V.mod(k, 29) == 0, four).otherwise(F.concat(four, F.array(pick(4, FLAGS))))
    return V.table(spark, d, "orders").select(
        k,
        F.concat(F.lit("orders_"), V.text(V.mod(k, 3))).alias("table"),
        (F.col(k) + 2).alias("line_no"),
        cells.alias("cells"),
        F.array(*[F.lit(c[0]) for c in COLUMNS]).alias("header"),
    )


def _shape(spark):
    """The three tables' columns: live, and documented under one schema."""
    rows = [(t, i, "s", *c) for t in TABLES for i, c in enumerate(COLUMNS)]
    return spark.createDataFrame(rows, "table string, ordinal int, schema string, name string, type string, nullable boolean, is_pk boolean")


def _delivery(spark, d):
    """(files, headers, rows) of the three tables."""
    rows = _cells(spark, d)
    # Distinct headers first: the smallest of all rows' arrays would be sought by sorting the rows.
    headers = rows.select("table", "header").distinct().groupBy("table").agg(F.min("header").alias("header"))
    files = spark.createDataFrame([(f"s/{t}.csv", "s", t) for t in TABLES], "path string, schema string, table string")
    return files, headers, rows


def _no_exemptions(spark):
    return spark.createDataFrame([], "kind string, table string")


def _routed(spark, d):
    files, headers, rows = _delivery(spark, d)
    routes = K.table_hits(K.routing(files, headers, _shape(spark), _shape(spark), _no_exemptions(spark)))
    return K.routed_rows(rows, routes)


def _judged(spark, d):
    return K.with_hits(_routed(spark, d))


@query(
    "ragged_rows",
    f"with {CELLS_SQL} select 'ragged_rows' as rule, {LINE} as object_key, '4 of 5' as detail from cells where ragged",
)
def ragged_rows(spark, d):
    return C.ragged_rows(_cells(spark, d)).select(*BRIEF)


@query(
    "duplicate_keys",
    f"""with {CELLS_SQL}, firsts as (select *, min(line_no) over (partition by "table", key) as first from cells where not ragged)
    select 'duplicate_keys' as rule, {LINE} as object_key, key || ' first at line ' || first as detail from firsts
    where line_no <> first""",
)
def duplicate_keys(spark, d):
    return K.duplicate_key_issues(_routed(spark, d)).select(*BRIEF)


@query(
    "null_in_required",
    f"with {CELLS_SQL} select 'null_in_required' as rule, {LINE} as object_key, 'day' as detail from cells where not ragged and day = ''",
)
def null_in_required(spark, d):
    return K.row_issues(_judged(spark, d), "null_in_required").select(*BRIEF)


PARSE_SQL = f"""
    select 'cell_parses' as rule, {LINE} as object_key, 'range smallint line' as detail from cells where not ragged and line = '99999'
    union all select 'cell_parses', {LINE}, 'parse smallint line' from cells where not ragged and line = 'x'
    union all select 'cell_parses', {LINE}, 'parse real amount' from cells where not ragged and amount = '5d'
    union all select 'cell_parses', {LINE}, 'parse date day' from cells where not ragged and day in ('2024-1-5', '2024-02-30')
    union all select 'cell_parses', {LINE}, 'parse boolean flag' from cells where not ragged and flag = 'yes'"""


@query("cell_parses", f"with {CELLS_SQL} {PARSE_SQL}")
def cell_parses(spark, d):
    return K.row_issues(_judged(spark, d), "cell_parses").select(*BRIEF)


@query(
    "overwrite_reload",
    f"""with {CELLS_SQL} select "table", line_no, try_cast(key as integer) as key, try_cast(line as smallint)::int as line,
    strftime(case when day = '20240101' then date '2024-01-01' when day in ('2024-01-05', '2024-12-31') then cast(day as date) end,
      '%Y-%m-%d') as day,
    case flag when 'T' then true when 'false' then false end as flag from cells where not ragged""",
)
def overwrite_reload(spark, d):
    """The three tables published, and read back; an empty or unusable cell is NULL. The line goes along as a column."""
    _, headers, rows = _delivery(spark, d)
    whole = rows.where(~C.is_ragged())
    whole = whole.withColumn("cells", F.concat("cells", F.array(V.text("line_no"))))
    headers = headers.select("table", F.concat("header", F.array(F.lit("line_no"))).alias("header"), F.sha2("table", 256).alias("sha256"))
    store = CodeSets(spark, f"{staging_folder(spark)}/code_sets")
    kinds = tuple((name, kind) for name, kind, *_ in COLUMNS) + (("line_no", "bigint"),)
    store.reload(whole, headers, [TableShape(t, kinds) for t in TABLES], "2024-01-01 00:00:00")
    return reduce(DataFrame.unionByName, [store.read(t).withColumn("table", F.lit(t)) for t in TABLES]).select(
        "table", "line_no", "key", F.col("line").cast("int").alias("line"), F.date_format("day", "yyyy-MM-dd").alias("day"), "flag"
    )


# A delivery without a fault, and a later one of one table with half its rows.
CLEAN_SQL = """clean as (select o_orderkey, 'orders_' || (o_orderkey % 3) as "table", o_orderkey + 2 as line_no, cast(o_orderkey as varchar) as key,
    cast(o_orderkey % 1000 as varchar) as line, case o_orderkey % 2 when 0 then '' else '12.50' end as amount,
    case o_orderkey % 5 when 0 then '20240101' else '2024-12-31' end as day, case o_orderkey % 4 when 0 then 'T' when 1 then '' else 'false' end as flag
    from orders),
  left_over as (select * from clean where "table" <> 'orders_1' or o_orderkey % 2 = 0)"""


def _clean(spark, d):
    k = "o_orderkey"
    amount = F.when(V.mod(k, 2) == 0, "").otherwise("12.50")
    day = F.when(V.mod(k, 5) == 0, "20240101").otherwise("2024-12-31")
    flag = F.when(V.mod(k, 4) == 0, "T").when(V.mod(k, 4) == 1, "").otherwise("false")
    return V.table(spark, d, "orders").select(
        k, F.concat(F.lit("orders_"), V.text(V.mod(k, 3))).alias("table"), (F.col(k) + 2).alias("line_no"),
        F.array(V.text(k), V.text(V.mod(k, 1000)), amount, day, flag).alias("cells"),
    )


def _loaded(spark, d) -> CodeSets:
    """Two loads; the limit on rows is that of the sample, not of curated sets."""
    store = CodeSets(spark, f"{staging_folder(spark)}/code_sets")
    rows = _clean(spark, d)
    for load, tables in enumerate((TABLES, ["orders_1"])):
        files = spark.createDataFrame([(f"s/{t}.csv", "s", t) for t in tables], "path string, schema string, table string")
        names = F.array(*[F.lit(c[0]) for c in COLUMNS])
        headers = files.select("table", names.alias("header"), F.sha2(F.concat("table", F.lit(f" {load}")), 256).alias("sha256"))
        shape = _shape(spark).where(F.col("table").isin(*tables))
        mine = rows.where(F.col("table").isin(*tables)) if not load else rows.where((F.col("table") == "orders_1") & (V.mod("o_orderkey", 2) == 0))
        done = load_delivery(store, files, headers, mine, shape, shape, f"2024-01-0{load + 1} 00:00:00", max_rows=1 << 60)
        if done.load_id != load + 1:
            raise RuntimeError("the delivery was refused")
    return store


@query(
    "load_code_sets",
    f"""with {CLEAN_SQL} select "table", cast(key as integer) as key, cast(line as integer) as line, nullif(amount, '') as amount,
    case day when '20240101' then '2024-01-01' else day end as day, case flag when 'T' then true when 'false' then false end as flag from left_over""",
)
def load_code_sets(spark, d):
    """What readers see after two loads, each judged by all rules before it was written."""
    store = _loaded(spark, d)
    amount = F.when(F.col("amount").isNotNull(), F.format_string("%.2f", F.col("amount").cast("double")))
    return reduce(DataFrame.unionByName, [store.read(t).withColumn("table", F.lit(t)) for t in TABLES]).select(
        "table", "key", F.col("line").cast("int").alias("line"), amount.alias("amount"), F.date_format("day", "yyyy-MM-dd").alias("day"), "flag"
    )


@query(
    "append_contract_audit",
    f"""with {CLEAN_SQL} select "table" as table_name, sha256("table" || ' 0') as csv_sha256, count(*) as row_count, '2024-01-01' as day from clean group by 1
    union all select 'orders_1', sha256('orders_1 1'), count(*), '2024-01-02' from left_over where "table" = 'orders_1'""",
)
def append_contract_audit(spark, d):
    """The ledger after two loads: one row per table and load."""
    return _loaded(spark, d).ledger().select("table_name", "csv_sha256", "row_count", F.date_format("loaded_ts", "yyyy-MM-dd").alias("day"))


@query(
    "type_vocabulary",
    f"""{WITH} select 'type_vocabulary' as rule, "table" || '|' || name as object_key, type as detail from docs where type = 'varchar'""",
)
def type_vocabulary(spark, d):
    return C.type_vocabulary(_docs(spark, d)).select(*BRIEF)


@query(
    "missing_backing",
    f"""{WITH} select 'missing_backing' as rule, "table" as object_key, 'live table without file' as detail from shapes
      where "table" not in (select "table" from files)
    union all select distinct 'missing_backing', "table", 'documented table without file' from docs
      where "table" not in (select "table" from files)""",
)
def missing_backing(spark, d):
    return C.missing_backing(_live(spark, d), _docs(spark, d), _delivered(spark, d)).select(*BRIEF)


@query(
    "folder_alignment",
    f"""{WITH} select 'folder_alignment' as rule, path as object_key, home as detail from files
    where schema <> home and "table" in (select "table" from docs)""",
)
def folder_alignment(spark, d):
    return C.folder_alignment(_delivered(spark, d), _docs(spark, d)).select(*BRIEF)


@query(
    "duplicate_stem",
    f"""{WITH}, firsts as (select path, min(path) over (partition by "table") as first from files)
    select 'duplicate_stem' as rule, path as object_key, first as detail from firsts where path <> first""",
)
def duplicate_stem(spark, d):
    return C.duplicate_stem(_delivered(spark, d)).select(*BRIEF)


@query(
    "unknown_table",
    f"""{WITH} select 'unknown_table' as rule, path as object_key, "table" as detail from files
    where "table" not in (select "table" from shapes where p_partkey % 11 <> 0)""",
)
def unknown_table(spark, d):
    live = _live(spark, d).where(V.mod("p_partkey", 11) != 0)
    return C.unknown_table(_delivered(spark, d), live).select(*BRIEF)


@query(
    "validate_contract",
    f"""with {CELLS_SQL}, firsts as (select *, min(line_no) over (partition by "table", key) as first from cells where not ragged),
    counts as (select "table", count(*) as n from cells group by 1)
    select 'row_guardrail' as rule, "table" as object_key, cast(n as varchar) as detail from counts where n > 1000
    union all select 'ragged_rows', {LINE}, '4 of 5' from cells where ragged
    union all select 'duplicate_keys', {LINE}, key || ' first at line ' || first from firsts where line_no <> first
    union all select 'null_in_required', {LINE}, 'day' from cells where not ragged and day = ''
    union all {PARSE_SQL}""",
)
def validate_contract(spark, d):
    found = K.validate(*_delivery(spark, d), _shape(spark), _shape(spark))
    return found.select(*BRIEF)


@query(
    "validate_docs_shape",
    f"""with {CELLS_SQL}, firsts as (select *, min(line_no) over (partition by "table", key) as first from cells where not ragged),
    counts as (select "table", count(*) as n from cells group by 1)
    select 'docs_gate' as rule, 'orders_2' as object_key, 'undocumented:flag' as detail
    union all select 'row_guardrail', "table", cast(n as varchar) from counts where n > 1000
    union all select 'ragged_rows', {LINE}, '4 of 5' from cells where ragged
    union all select 'duplicate_keys', {LINE}, key || ' first at line ' || first from firsts where line_no <> first and "table" <> 'orders_2'
    union all select 'null_in_required', {LINE}, 'day' from cells where not ragged and day = '' and "table" <> 'orders_2'
    union all select * from ({PARSE_SQL}) where not starts_with(object_key, 'orders_2')""",
)
def validate_docs_shape(spark, d):
    """Tables that are not live yet, on a dry run; one column of one is not documented."""
    docs = _shape(spark).where("not (table = 'orders_2' and name = 'flag')")
    exempt = spark.createDataFrame([("missing_table", t) for t in TABLES], "kind string, table string")
    found = K.validate(*_delivery(spark, d), _shape(spark).where(F.lit(False)), docs, exempt, dry_run=True)
    return found.where("severity = 'error'").select(*BRIEF)


# Each fifth part's table is out of date, some are not live yet, some are about to go.
EXEMPT_SQL = """exempt as (select "table", p_partkey, p_partkey % 13 <> 0 as delivered, p_partkey % 11 <> 0 as live, p_partkey % 10 = 0 as reshaped,
    p_partkey % 22 = 0 as missing, p_partkey % 26 = 0 as dropped, form, schema from shapes),
  routed as (select *, case when not delivered then 'undelivered' when live and not reshaped then 'live' when live or missing then 'docs' else 'unknown' end as route
    from exempt)"""


def _exempt(spark, d):
    """(files, headers, live, docs, exemptions) of one table per part."""
    number = F.substring("table", 2, 20).cast("bigint")
    full = lambda df: df.withColumns({"nullable": F.lit(True)})
    live = full(_live(spark, d).where(V.mod("p_partkey", 11) != 0)).withColumn("type", F.lit("text"))
    docs = full(_docs(spark, d)).withColumn("is_pk", F.col("name") == "code")
    files = _delivered(spark, d)
    headers = _shapes(spark, d).where(V.mod("p_partkey", 13) != 0).select("table", "header")
    kinds = F.array_compact(
        F.array(
            F.when(V.mod(number, 10) == 0, F.lit("reshaped_table")), F.when(V.mod(number, 22) == 0, F.lit("missing_table")),
            F.when(V.mod(number, 26) == 0, F.lit("dropped_table")),
        )
    )
    exemptions = _shapes(spark, d).select("table", F.explode(kinds).alias("kind"))
    return files, headers, live, docs, exemptions


@query(
    "exemption_routing",
    f"""{WITH}, {EXEMPT_SQL} select "table", route,
    case when route = 'docs' and not live then 'missing_table' when route = 'docs' then 'reshaped_table'
      when route = 'undelivered' and live and dropped then 'dropped_table' else '' end as used from routed
    where delivered or live or p_partkey % 7 <> 0 or reshaped or missing or dropped""",
)
def exemption_routing(spark, d):
    return K.routing(*_exempt(spark, d)).select("table", "route", F.array_join("used", ",").alias("used"))


@query(
    "exempted_issues",
    f"""{WITH}, {EXEMPT_SQL},
    judged as (select *, route = 'live' and form in (1, 2, 3) as wrong_header, p_partkey % 7 <> 0 as documented from routed),
    gated as (select * from judged where route in ('live', 'docs') and not wrong_header),
    gate as (
      select "table", 'undocumented table:' as detail from gated where not documented
      union all select "table", 'repeated:code' from gated where documented and form = 2
      union all select "table", 'undocumented:extra' from gated where documented and form = 3
      union all select "table", 'documented but absent:description' from gated where documented and form in (2, 3)
      union all select "table", 'documented but absent:notes' from gated where documented and form = 3),
    stems as (select path, "table", min(path) over (partition by "table") as first from files)
    select 'header_equals' as rule, "table" as object_key, case form when 1 then '2 differ from position 0' when 2 then '1 differ from position 1'
      else '2 differ from position 1' end as detail, 'error' as severity from judged where wrong_header
    union all select 'docs_gate', "table", detail, 'error' from gate
    union all select 'key_required', "table", 'no key column', 'error' from gated where route = 'live' and p_partkey % 23 = 0
    union all select 'type_vocabulary', "table", 'varchar notes', 'error' from gated
      where route = 'docs' and p_partkey % 29 = 0 and "table" not in (select "table" from gate)
    union all select 'missing_backing', "table", 'live table without file', case when dropped then 'warning' else 'error' end from judged
      where route = 'undelivered' and live
    union all select 'missing_backing', "table", 'documented table without file', 'error' from judged where route = 'undelivered' and documented
    union all select 'unknown_table', path, f."table", 'error' from files f join judged j on f."table" = j."table" where route = 'unknown'
    union all select 'folder_alignment', path, home, 'error' from files where schema <> home and "table" in (select "table" from docs)
    union all select 'duplicate_stem', path, first, 'error' from stems where path <> first
    union all select case when live then 'reshaped_table' else 'missing_table' end, "table", 'judged by the documentation', 'warning' from judged
      where route = 'docs'""",
)
def exempted_issues(spark, d):
    """All that is wrong with the tables as such, with three kinds of exemption, on a dry run."""
    files, headers, live, docs, exemptions = _exempt(spark, d)
    rows = spark.createDataFrame([], "table string, line_no bigint, cells array<string>")
    found = K.validate(files, headers, rows, live, docs, exemptions, dry_run=True)
    return found.select(*BRIEF, "severity")


@query(
    "exemptions",
    f"""{WITH} select 'unknown_table' as rule, path as object_key,
    case when p_partkey % 22 = 0 then 'warning' else 'error' end as severity
    from files f join (select "table" as t, p_partkey from shapes) s on f."table" = s.t where p_partkey % 11 = 0""",
)
def exemptions(spark, d):
    live = _live(spark, d).where(V.mod("p_partkey", 11) != 0)
    delivered = _delivered(spark, d)
    issues = C.unknown_table(delivered, live)
    number = F.substring("table", 2, 20).cast("bigint")
    allowed = delivered.where(V.mod(number, 22) == 0).select(F.lit("unknown_table").alias("rule"), F.col("path").alias("object_key"))
    return C.apply_exemptions(issues, allowed).select("rule", "object_key", "severity")


@query(
    "unused_exemptions",
    f"""{WITH} select "table" from shapes where p_partkey % 4 = 0 and "table" not in (select "table" from files)""",
)
def unused_exemptions(spark, d):
    asked = _shapes(spark, d).where(V.mod("p_partkey", 4) == 0).select("table")
    return C.unused_exemptions(asked, _delivered(spark, d), ["table"])


@query(
    "freshness",
    """with last as (select user_id, arg_max(props, (date_trunc('day', ts), event_id)) as props from events where user_id % 5 <> 0
      group by 1),
    hashed as (select 'u' || user_id as "table", user_id, max(props) as newest from events group by user_id)
    select h."table", case when h.user_id % 7 = 0 then 'missing table' when l.user_id is null then 'never loaded'
      when l.props <> h.newest then 'stale' else 'current' end as status
    from hashed h left join last l on h.user_id = l.user_id""",
)
def freshness(spark, d):
    e = V.table(spark, d, "events").withColumn("table", F.concat(F.lit("u"), V.text("user_id")))
    ledger = e.where(V.mod("user_id", 5) != 0).select(
        "table", F.sha2("props", 256).alias("csv_sha256"), F.date_trunc("day", "ts").alias("loaded_ts"),
        F.col("event_id").alias("audit_id"),
    )
    files = e.groupBy("table").agg(F.sha2(F.max("props"), 256).alias("sha256"))
    live = e.where(V.mod("user_id", 7) != 0).select("table").distinct()
    return C.freshness(files, ledger, live)


@query(
    "manifest_reconcile",
    """select page_id as version_no, case when page_id % 37 = 0 then 'duplicate version'
      when page_id % 10 = 0 then case when page_id % 20 = 0 then 'pending, allowed' else 'pending' end
      when page_id % 7 = 0 then 'checksum changed' else 'in sync' end as status from pages
    union all select page_id + 1000000000, 'applied but absent' from pages where page_id % 31 = 0""",
)
def manifest_reconcile(spark, d):
    p = V.table(spark, d, "pages")
    k = "page_id"
    manifest = p.select(V.text(k).alias("version"), F.sha2("url", 256).alias("checksum"))
    again = p.where(V.mod(k, 37) == 0).select(F.concat(F.lit("000"), V.text(k)).alias("version"), F.sha2("url", 256).alias("checksum"))
    applied = p.where(V.mod(k, 10) != 0).select(
        F.concat(F.lit("0"), V.text(k)).alias("version"),
        F.when(V.mod(k, 7) == 0, "other").otherwise(F.sha2("url", 256)).alias("checksum"),
    )
    gone = p.where(V.mod(k, 31) == 0).select(V.text(F.col(k) + 1_000_000_000).alias("version"), F.lit("c").alias("checksum"))
    allowed = p.where(V.mod(k, 20) == 0).select(V.text(k).alias("version"))
    return C.manifest_reconcile(manifest.union(again), applied.union(gone), allowed)


# Authored rows of two columns per line of the catalogue: every ninth twice, some malformed, some outside a schema folder.
DOCUMENTED_SQL = """rows as (
    select p_partkey as k, 's' || (p_size % 2) as schema, 't' || (p_partkey // 2) as "table", 'c' || (p_partkey % 2) as name, 0 as row_no from part
    union all select p_partkey, 's' || (p_size % 2), 't' || (p_partkey // 2), 'c' || (p_partkey % 2), 1 from part where p_partkey % 9 = 0),
  judged as (select *, 'path' || k as path, case when k % 31 = 0 then 'unreadable: ParserError' when k % 17 = 0 then 'malformed: data_type'
      when k % 19 = 0 then 'malformed: is_nullable, is_primary_key' when k % 23 = 0 then 'outside a schema folder' end as problem from rows),
  doc as (select * from judged where problem is null),
  homes as (select "table", min(schema) as low, max(schema) as high from doc group by 1)"""


@query(
    "documented_columns",
    f"""with {DOCUMENTED_SQL}
    select 'table_in_two_schemas' as rule, "table" as object_key, low || ',' || high as detail from homes where low <> high
    union all select 'duplicate_column', "table" || '|' || name, cast(count(*) as varchar) from doc group by "table", name having count(*) > 1
    union all select 'documented_rows', path || '#' || row_no, problem from judged where problem is not null""",
)
def documented_columns(spark, d):
    """Documentation from authored rows, with what is malformed in them. The same row reached by two readers counts once."""
    p, k = V.table(spark, d, "part"), "p_partkey"
    nothing = F.lit(None).cast("string")
    yes = F.lit("true")
    body = F.create_map(
        F.lit("table_name"), F.concat(F.lit("t"), V.text(F.floor(F.col(k) / 2))), F.lit("column_name"), F.concat(F.lit("c"), V.text(V.mod(k, 2))),
        F.lit("data_type"), F.lit("text"), F.lit("is_nullable"), yes, F.lit("is_primary_key"), yes,
    )
    odd = V.mod(k, 19) == 0
    kinds = F.create_map(
        F.lit("table_name"), F.lit("text"), F.lit("column_name"), F.lit("text"), F.lit("data_type"), F.when(V.mod(k, 17) == 0, "null").otherwise("text"),
        F.lit("is_nullable"), F.when(odd & (V.mod(k, 17) != 0), "int").otherwise("bool"), F.lit("is_primary_key"), F.when(odd & (V.mod(k, 17) != 0), "text").otherwise("bool"),
    )
    rows = p.select(
        F.concat(F.lit("path"), V.text(k)).alias("rel"),
        F.when(V.mod(k, 23) != 0, F.concat(F.lit("s"), V.text(V.mod("p_size", 2)))).alias("schema"),
        F.explode(F.when(V.mod(k, 9) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("row_no"),
        body.alias("body"), kinds.alias("kinds"), F.when(V.mod(k, 31) == 0, "unreadable: ParserError").otherwise(nothing).alias("error"),
    )
    good, malformed = S8.documented_rows(rows)
    found = S8.documentation_issues(S8.documented_columns([good, good]))
    return found.unionByName(malformed).select(*BRIEF)
