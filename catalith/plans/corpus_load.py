"""The catalogue load: assemble, check in waves, compare, guard, apply.

Every wave reports all its issues together; a later wave runs only when the
earlier ones are clean.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder
from catalith.functions import paths
from catalith.functions.text import blank
from catalith.issues import (
    ISSUE_SCHEMA,
    Check,
    as_issues,
    check_rows,
    hits,
    issues_of_hits,
    key_text,
    no_issues,
    union_issues,
)
from catalith.operators import diff as X
from catalith.operators import expand as D
from catalith.operators import graph as G
from catalith.operators import history as Y
from catalith.operators import invariants as B
from catalith.operators import keys as K
from catalith.operators import lineage as L
from catalith.operators import references as R
from catalith.operators import shape as P
from catalith.operators import venues as W
from catalith.sources import documents as S4
from catalith.sources import files as S
from catalith.sources.state import conform
from catalith.sources.store import Store
from catalith.specs import CARDINALITIES, DEPLOYMENT_SCHEMA_KEYS, RECOGNISED_KEYS, RELATIONS

Corpus = dict[str, DataFrame]
# Relation of each file type, and the kinds of value its fields may have.
FILE_RELATION = {"data_source": "data_sources", "schema": "schemas"}
_FLAGS = ("is_nullable", "is_primary_key", "validated")
_LISTS = ("related_object_ids",)
_MAPS = ("schemas",)


@dataclass
class LoadResult:
    issues: DataFrame
    changes: dict[str, DataFrame] = field(default_factory=dict)
    load_id: int | None = None

    @property
    def ok(self) -> bool:
        return self.issues.isEmpty()


# --- issues ------------------------------------------------------------------------


class IssueLog:
    """Issues of one wave, written in a few plans instead of one with a branch per rule."""

    def __init__(self, spark: SparkSession, folder: str, name: str, per_plan: int = 8):
        self.spark, self.folder, self.name, self.per_plan = spark, folder, name, per_plan
        self.waiting: list[DataFrame] = []

    def add(self, *frames: DataFrame) -> None:
        self.waiting += frames
        while len(self.waiting) >= self.per_plan:
            self._write(self.per_plan)

    def _write(self, n: int) -> None:
        part, self.waiting = self.waiting[:n], self.waiting[n:]
        stage(union_issues(*part), self.folder, self.name, append=True)

    def finish(self) -> DataFrame:
        if self.waiting:
            self._write(len(self.waiting))
        return self.spark.read.schema(ISSUE_SCHEMA).parquet(f"{self.folder}/{self.name}")


# --- wave 1: files to rows -------------------------------------------------------


def _row_key() -> Column:
    return F.concat_ws("#", "rel", F.col("row_no").cast("string"))


def _kind_checks(file_type: str) -> list[Check]:
    """Values of the wrong kind: flags that are not boolean, text the parser took for a date."""
    checks = []
    for k in RECOGNISED_KEYS[file_type]:
        kind = F.col("kinds")[k]
        want = "bool" if k in _FLAGS else "texts" if k in _LISTS else "map" if k in _MAPS else "text"
        bad = F.coalesce(~kind.isin(want, "null"), F.lit(False))
        checks.append(("field_kind", bad, F.concat(F.lit(k + " is "), kind)))
    return checks


def _with_ids(rows: DataFrame, file_type: str) -> DataFrame:
    """Authored rows of one file type: a column per recognised key, and the composed ids."""
    mine = rows.where((F.col("file_type") == file_type) & F.col("error").isNull())
    df = mine.select(
        "rel", "row_no", "data_source", "schema", "body", "kinds",
        *[F.col("body")[k].alias(k) for k in RECOGNISED_KEYS[file_type]],
    )
    folder = paths.compose_id("data_source", "schema")
    if file_type == "data_source":
        return df.withColumn("data_source_id", F.col("data_source"))
    if file_type == "schema":
        return df.withColumns(
            {"schema_id": folder, "data_source_id": F.col("data_source"), "schema_name": F.col("schema")}
        )
    if file_type == "tables":
        return df.withColumns({"schema_id": folder, "table_id": paths.compose_id("data_source", "schema", "table_name")})
    if file_type == "columns":
        return df.withColumns(
            {
                "table_id": paths.compose_id("data_source", "schema", "table_name"),
                "column_id": paths.compose_id("data_source", "schema", "table_name", "column_name"),
                "ref_table_id": F.col("ref_table"),
            }
        )
    if file_type == "concepts":
        prefix = F.concat_ws(".", "data_source", "schema")
        return df.withColumns({"prefix": prefix, "concept_id": F.concat_ws(".", prefix, "name")})
    if file_type in ("table_relationships", "column_mappings"):
        return df.withColumn("folder_id", folder)
    return df


def _unless_blank(col: str, checks: list[Check]) -> list[Check]:
    return [(rule, ~blank(F.col(col)) & bad, detail) for rule, bad, detail in checks]


def _row_checks(df: DataFrame, file_type: str) -> list[Check]:
    """All row-local rules of a file type, for one pass over its rows."""
    checks = P.unknown_key_checks("body", RECOGNISED_KEYS[file_type]) + _kind_checks(file_type)
    if file_type == "deployments":
        return checks + P.required_checks(dict(df.dtypes), ["system"]) + P.label_checks(["system"])
    spec = RELATIONS[FILE_RELATION.get(file_type, file_type)]
    checks += P.required_checks(dict(df.dtypes), list(spec.required)) + P.optional_text_checks(list(spec.optional_text))
    if file_type == "systems":
        checks += P.label_checks(["system"])
    elif file_type == "tables":
        checks += P.label_checks(["table_name"]) + P.reserved_checks("table_name", (paths.RESERVED_CONCEPT,))
    elif file_type == "columns":
        checks += P.label_checks(["table_name", "column_name"])
        checks += P.reserved_checks("column_name", (paths.RESERVED_CONCEPT,)) + P.ref_shape_checks("ref_table")
    elif file_type == "table_relationships":
        checks += _unless_blank("table_a_id", P.prefix_checks("table_a_id", "folder_id"))
    elif file_type == "column_mappings":
        checks += _unless_blank("source_column_id", P.prefix_checks("source_column_id", "folder_id"))
    elif file_type == "concepts":
        checks += _unless_blank("name", P.concept_name_checks("name", "prefix", "schema"))
        checks += P.array_entry_check_list("links", "concept_id")
    return checks


def _relation(df: DataFrame, file_type: str) -> DataFrame:
    """Accepted rows in the declared columns of their relation."""
    spec = RELATIONS[FILE_RELATION.get(file_type, file_type)]
    if file_type == "concepts":
        df = df.withColumn("related_object_ids", F.col("links"))
    if file_type == "column_mappings":
        df = L.tables_referenced(df, "target_expression")
    return conform(P.default_flag(df, list(spec.flags)), spec)


def _entries(df: DataFrame) -> DataFrame:
    """Placement entries; a plain text value in `schemas` is a new schema name."""
    raw = F.from_json("schemas", "map<string,string>")
    shape = "struct<name:string,tables:map<string,string>>"
    value = F.transform_values(
        raw,
        lambda _, v: F.when(v.startswith("{"), F.from_json(v, shape)).otherwise(
            F.struct(v.alias("name"), F.lit(None).cast("map<string,string>").alias("tables"))
        ),
    )
    return df.select(
        "rel", "row_no", F.col("data_source").alias("data_source_id"), "system", "database_name",
        value.alias("schemas"), raw.alias("raw_schemas"),
    )


def _entry_shape_issues(entries: DataFrame) -> DataFrame:
    """Schema values that are neither a name nor a `{name, tables}` mapping."""
    items = entries.where(F.col("raw_schemas").isNotNull()).select(
        "rel", "row_no", F.explode("raw_schemas").alias("schema_name", "value")
    )
    is_map = F.col("value").startswith("{")
    keys = F.map_keys(F.from_json("value", "map<string,string>"))
    odd = F.array_sort(F.array_except(keys, F.array(*[F.lit(k) for k in DEPLOYMENT_SCHEMA_KEYS])))
    problem = (
        F.when(blank(F.col("value")), "no physical name")
        .when(F.col("value").rlike(r"\A(\[|[0-9]|true\z|false\z)"), "neither a name nor a mapping")
        .when(is_map & (F.size(odd) > 0), F.concat(F.lit("unknown keys "), F.array_join(odd, ",")))
    )
    return check_rows(
        items, "deployments", _row_key(),
        [("schema_entry", problem.isNotNull(), F.concat_ws(" ", "schema_name", problem))],
    )


def assemble(spark: SparkSession, root: str) -> tuple[Corpus, DataFrame]:
    """Relations and wave-1 issues of a corpus folder. Rejected rows are absent from the relations.

    The parsed rows, the checked rows and the relations are staged, because
    dozens of rules read them.
    """
    folder = staging_folder(spark)
    log = IssueLog(spark, folder, "wave_1")
    files = S.classify_paths(S.scan_files(spark, root))
    picked = S.corpus_files(files)
    rows = stage(S4.read_documents(picked), folder, "documents")
    listing = files.select("path", "rel", "length", "rel_parts", "file_name", "ext", "stem")
    log.add(S.path_issues(files), S.wrong_extension(listing), S.shard_form_conflict(picked), S4.document_issues(rows))

    corpus: Corpus = {}
    checked: dict[str, DataFrame] = {}
    for file_type in RECOGNISED_KEYS:
        df = _with_ids(rows, file_type)
        if file_type == "concepts":
            df = df.withColumn("links", F.from_json("related_object_ids", "array<string>"))
        df = stage(df.withColumn("_hits", hits(_row_checks(df, file_type))).drop("body", "kinds"), folder, file_type)
        checked[file_type] = df
        good = df.where(F.size("_hits") == 0)
        log.add(issues_of_hits(df, "_hits", file_type, _row_key(), 1))
        if file_type == "deployments":
            log.add(K.once_per_parent(good, ["rel"], "system", ["row_no"], file_type))
            continue
        name = FILE_RELATION.get(file_type, file_type)
        kept, repeats = K.first_wins_dedup(good, list(RELATIONS[name].key), ["rel", "row_no"], name)
        log.add(repeats)
        corpus[name] = stage(_relation(kept, file_type), folder, f"corpus_{name}")

    tables = corpus["tables"].select(
        "table_id", paths.leading("table_id", 1).alias("data_source_id"), paths.leaf("schema_id").alias("schema_name"),
        "table_name",
    )
    schemas = corpus["schemas"].select("data_source_id", "schema_name")
    placements = checked["deployments"].where(F.size("_hits") == 0)
    firsts = placements.groupBy("rel", "system").agg(F.min("row_no").alias("row_no"))
    entries = stage(_entries(placements.join(firsts, ["rel", "system", "row_no"], "left_semi")), folder, "entries")
    corpus["deployment_tables"] = stage(
        conform(D.expand_deployments(entries, tables), RELATIONS["deployment_tables"]), folder, "corpus_deployment_tables"
    )
    scoped = (
        D.zero_expansion(entries, tables, schemas)
        .union(D.documented_exists(entries, tables, schemas))
        .union(D.physical_names(entries))
    )
    scoped = stage(scoped, folder, "scoped")

    def lost(file_type: str, *cols: str) -> DataFrame:
        bad = checked[file_type].where(F.size("_hits") > 0)
        return bad.select(F.col("data_source").alias("data_source_id"), F.col("schema").alias("schema_name"), *cols)

    unread = rows.where(F.col("error").isNotNull()).select(
        "file_type", "row_no", F.col("data_source").alias("data_source_id"), F.col("schema").alias("schema_name")
    )
    lost_schemas = lost("schema").union(unread.where("file_type = 'schema'").drop("file_type", "row_no"))
    broken = unread.where("file_type = 'tables'").drop("file_type", "row_no")
    kept, quiet = D.suppress_cascade(scoped, lost_schemas, lost("tables", "table_name"), broken)
    nowhere = D.deploys_nowhere(corpus["data_sources"], corpus["deployment_tables"], entries, tables).join(
        quiet, "data_source_id", "left_anti"
    )
    log.add(
        _entry_shape_issues(entries),
        D.scoped_issues(kept),
        as_issues(nowhere, "deploys_nowhere", "data_sources", F.col("data_source_id"), F.col("cause"), wave=1),
        K.namespaces_disjoint(corpus["systems"], "system", corpus["data_sources"], "data_source_id", "systems"),
    )
    return {name: corpus[name] for name in RELATIONS}, log.finish()


# --- wave 2: rules over the whole corpus -------------------------------------------


def _data_spaces(c: Corpus) -> list[tuple[DataFrame, str]]:
    names = ("data_sources", "schemas", "tables", "columns", "concepts")
    return [(c[n], RELATIONS[n].key[0]) for n in names]


# Which column of which relation refers to which relation.
REFERENCES = (
    ("schemas", "data_source_id", "data_sources"),
    ("tables", "schema_id", "schemas"),
    ("columns", "table_id", "tables"),
    ("deployment_tables", "table_id", "tables"),
    ("deployment_tables", "system", "systems"),
    ("deployment_tables", "data_source_id", "data_sources"),
    ("table_relationships", "table_a_id", "tables"),
    ("table_relationships", "table_b_id", "tables"),
    ("column_mappings", "source_column_id", "columns"),
)


def validate(c: Corpus) -> DataFrame:
    """All wave-2 issues of a corpus."""
    spark = c["tables"].sparkSession
    folder = staging_folder(spark)
    log = IssueLog(spark, folder, "wave_2")
    edges = [
        (c[child], fk, key_text(*RELATIONS[child].key), child, c[parent], RELATIONS[parent].key[0])
        for child, fk, parent in REFERENCES
    ]
    log.add(
        R.orphan_edges(edges),
        R.prefix_redundancy(c["schemas"], "schema_id", "data_source_id", 1, "schemas"),
        R.prefix_redundancy(c["tables"], "table_id", "schema_id", 2, "tables"),
        R.prefix_redundancy(c["columns"], "column_id", "table_id", 3, "columns"),
        R.optional_reference(c["columns"], "ref_table_id", c["tables"], "table_id", "columns", F.col("column_id")),
        R.array_reference(c["concepts"], "related_object_ids", F.col("concept_id"), _data_spaces(c), "concepts"),
        R.anchor_reference(c["concepts"], "concept_id", _data_spaces(c)[:4]),
        K.unique_address(
            c["deployment_tables"],
            ["system", "physical_database_name", "physical_schema_name", "physical_table_name"],
            ["table_id", "system"],
            "deployment_tables",
        ),
    )

    # Expressions are cut into tokens once; the rules below read the staged facts.
    rel_rows = c["table_relationships"].withColumns(
        {
            "rel_key": key_text(*RELATIONS["table_relationships"].key),
            "_low": F.least("table_a_id", "table_b_id"),
            "_high": F.greatest("table_a_id", "table_b_id"),
        }
    )
    rel_facts = L.with_facts(rel_rows, "join_condition", must_be_predicate=True)
    rels = stage(rel_facts.withColumn("_hits", hits(L.expression_checks("join_condition", True))), folder, "rels")
    rel_key = F.col("rel_key")
    # A badly qualified reference is one issue; the row then takes no part in the rules built on references.
    sound = rels.where(F.size("_bad") == 0)
    log.add(
        issues_of_hits(rels, "_hits", "table_relationships", rel_key, 2),
        as_issues(rels.where(F.size("_bad") > 0), "column_refs", "table_relationships", rel_key, F.array_join("_bad", ",")),
        K.unordered_pair_unique(rels, "table_a_id", "table_b_id", "relationship_name", ["rel_key"], "table_relationships"),
        K.disambiguation_required(rels, ["_low", "_high"], "use_when", ["rel_key"], "table_relationships"),
        B.enum_check(rels, "cardinality", CARDINALITIES, "table_relationships", rel_key),
        W.pair_codeployed(rels, "table_a_id", "table_b_id", "rel_key", c["deployment_tables"], c["tables"]),
        L.no_refs(sound, "join_condition", rel_key, "table_relationships"),
        L.refs_resolve(sound, "join_condition", "rel_key", c["columns"], "column_id", "table_relationships"),
        L.endpoint_membership(sound, "join_condition", "table_a_id", "table_b_id", rel_key),
        L.endpoint_coverage(sound, "join_condition", "table_a_id", "table_b_id", rel_key),
    )

    map_rows = c["column_mappings"].withColumn("map_key", key_text(*RELATIONS["column_mappings"].key))
    map_facts = L.with_facts(map_rows, "target_expression", must_be_predicate=False)
    maps = stage(map_facts.withColumn("_hits", hits(L.expression_checks("target_expression", False))), folder, "maps")
    map_key = F.col("map_key")
    sound = maps.where(F.col("target_expression").isNotNull() & (F.size("_bad") == 0))
    placed = sound.select("map_key", F.col("target_tables_referenced").alias("tables"))
    components = G.connected_components(c["table_relationships"], "table_a_id", "table_b_id")
    log.add(
        issues_of_hits(maps, "_hits", "column_mappings", map_key, 2),
        as_issues(maps.where(F.size("_bad") > 0), "column_refs", "column_mappings", map_key, F.array_join("_bad", ",")),
        K.disambiguation_required(maps, ["source_column_id"], "use_when", ["map_key"], "column_mappings"),
        B.drop_needs_reason(maps, "target_expression", "notes", "column_mappings", map_key),
        L.no_refs(sound, "target_expression", map_key, "column_mappings"),
        L.refs_resolve(sound, "target_expression", "map_key", c["columns"], "column_id", "column_mappings"),
        L.self_reference(sound, "target_expression", "source_column_id", "map_key", c["columns"], "column_id"),
        W.nway_codeployed(placed, "tables", "map_key", c["deployment_tables"], c["tables"]),
        G.linkable_tables(placed, "tables", "map_key", components, c["tables"]),
    )
    return log.finish()


# --- wave 3 and apply -----------------------------------------------------------------


def diff_all(new: Corpus, state: Corpus) -> dict[str, DataFrame]:
    return {name: X.diff_relation(spec, new[name], state[name]) for name, spec in RELATIONS.items()}


def all_digests(store: Store, new: Corpus) -> dict[str, dict[int, str]]:
    """Digests of the new snapshot by relation and bucket; one job, one row a bucket."""
    rows = [store.digests(spec, new[name]).withColumn("relation", F.lit(name)) for name, spec in RELATIONS.items()]
    found: dict[str, dict[int, str]] = {name: {} for name in RELATIONS}
    for r in reduce(DataFrame.unionByName, rows).collect():
        found[r["relation"]][r["bucket"]] = r["digest"]
    return found


def diff_changed(store: Store, new: Corpus, digests: dict[str, dict[int, str]], load_id: int) -> dict[str, DataFrame]:
    """The differences to a published run. Only buckets whose digest is another one are read and joined."""
    changes = {}
    for name, spec in RELATIONS.items():
        buckets = store.changed_buckets(spec, digests[name], load_id)
        rows = new[name].where(store.bucket_of(spec).isin(*buckets)) if buckets else new[name].where(F.lit(False))
        changes[name] = X.diff_relation(spec, rows, store.state(spec, load_id, buckets))
    return changes


def guard(
    changes: dict[str, DataFrame], state: Corpus, fraction: float, min_count: int, allow_mass_delete: bool
) -> DataFrame:
    """Wave-3 issues: unexplained updates first; the mass-delete verdict only when there are none."""
    found = [
        X.reason_discipline(changes[name], list(spec.key), name) for name, spec in RELATIONS.items() if spec.reason
    ]
    issues = union_issues(*found)
    if allow_mass_delete or not issues.isEmpty():
        return issues
    verdict = X.mass_delete_guard(list(changes.values()), list(state.values()), fraction, min_count)
    over = verdict.where("violation")
    detail = F.concat_ws(" of ", F.col("deletes").cast("string"), F.col("current_rows").cast("string"))
    return as_issues(over, "mass_delete_guard", "corpus", F.lit("all"), detail, wave=3)


def run_load(
    store: Store,
    root: str,
    commit_sha: str,
    run_ts: str,
    fraction: float = X.MASS_DELETE_FRACTION,
    min_count: int = X.MASS_DELETE_MIN_COUNT,
    dry_run: bool = False,
    allow_mass_delete: bool = False,
    reset_history: bool = False,
    confirmed: bool = False,
) -> LoadResult:
    """One load. `run_ts` stamps every row of the run, the history and the audit alike.

    Passing the mass-delete guard by or dropping the history must be
    `confirmed` as well. A dry run stops before the first write and fails in
    the same cases. Versions closed by a resetting run itself are kept.
    """
    X.check_guard_knobs(fraction, min_count)
    if (reset_history or allow_mass_delete) and not confirmed:
        raise ValueError("resetting the history or allowing a mass delete must be confirmed")
    spark = store.spark
    corpus, issues = assemble(spark, root)
    for wave in (lambda: issues, lambda: validate(corpus)):
        found = wave()
        if not found.isEmpty():
            return LoadResult(found)
    last = store.last_load()
    state = {name: store.state(spec, last) for name, spec in RELATIONS.items()}
    folder = staging_folder(spark)
    digests = all_digests(store, corpus)
    changes = {name: stage(df, folder, f"changes_{name}") for name, df in diff_changed(store, corpus, digests, last).items()}
    found = guard(changes, state, fraction, min_count, allow_mass_delete)
    if not found.isEmpty():
        return LoadResult(found, changes)
    if dry_run:
        return LoadResult(no_issues(spark), changes)

    stamp = F.lit(run_ts).cast("timestamp")
    load_id = last + 1

    def new_rows(spec, current, change):
        return Y.apply_changes(
            current, change, list(spec.key), stamp, validated="validated" in spec.content, reason=spec.reason
        )

    history = {n: Y.history_rows(c, stamp) for n, c in changes.items()}
    audit = Y.audit_row(list(changes.values()), load_id, commit_sha, stamp, reset_history)
    store.publish(load_id, changes, new_rows, history, audit, digests)
    return LoadResult(no_issues(spark), changes, load_id)

