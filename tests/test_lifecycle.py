"""A store through its life: first load, no change, updates, deletes, reset, refused loads."""

import pytest
from pyspark.sql import functions as F

from catalith.operators import history as Y
from catalith.plans import corpus_load as load
from catalith.sources.store import Store
from catalith.specs import RELATIONS

from .conftest import write


@pytest.fixture(autouse=True)
def small_plans(spark):
    """Tiny data, large plans: compiling code for them is the slow part."""
    fast = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k) for k in fast}
    for k, v in fast.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def edit(path, old, new):
    text = path.read_text()
    assert old in text
    path.write_text(text.replace(old, new))


def rules(result):
    return sorted({r.rule for r in result.issues.collect()})


def counts(store):
    return {n: store.state(s).count() for n, s in RELATIONS.items()}


def audit(store):
    return [
        (r.load_id, r.commit_sha, r.inserts, r.updates, r.deletes, r.reset_history)
        for r in store.audit().orderBy("load_id").collect()
    ]


def test_life_of_a_store(spark, corpus_root, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"), buckets=4)
    shop = corpus_root / "sources/shop"

    def run(commit, hour, **kw):
        result = load.run_load(store, str(corpus_root), commit, f"2024-01-01 {hour:02d}:00:00", **kw)
        assert [r.asDict() for r in result.issues.collect()] == []
        return result

    read, plain = [], Store.state

    def state(self, spec, load_id=None, only=None):
        read.append((spec.name, only))
        return plain(self, spec, load_id, only)

    monkeypatch.setattr(Store, "state", state)
    # A dry run writes nothing.
    assert run("dry", 0, dry_run=True).load_id is None
    assert store.last_load() == 0

    run("first", 1)
    assert sum(counts(store).values()) == 19
    assert audit(store) == [(1, "first", 19, 0, 0, False)]
    assert store.state(RELATIONS["column_mappings"]).first().target_tables_referenced == ["hub.views.person"]
    assert store.state(RELATIONS["columns"]).where(F.col("column_id").startswith("shop.main.")).count() == 3

    # Folders of a run that never wrote its audit row stay invisible, and the next run overwrites them.
    spec = RELATIONS["tables"]
    junk = store.state(spec).withColumns({"table_id": F.lit("x.y.z"), "bucket": F.lit(0)})
    junk.write.partitionBy("bucket").parquet(store.path("state", "tables", "load_id=2"))
    junk.drop("bucket").withColumn("end_ts", F.col("update_ts")).write.parquet(store.path("history", "tables", "load_id=2"))
    assert store.last_load() == 1 and store.state(spec).count() == 3 and store.history(spec).count() == 0

    # The same corpus again changes nothing and still leaves an audit row. Nothing is compared: all digests are equal.
    read.clear()
    run("same", 2)
    assert {name: only for name, only in read if only is not None} == dict.fromkeys(RELATIONS, [])
    assert audit(store)[-1] == (2, "same", 0, 0, 0, False)
    assert store.state(spec).count() == 3 and store.history(spec).count() == 0

    # An explained update, a placement change (no reason needed), a relationship found valid.
    tables, places, rels = shop / "main/tables.yaml", shop / "deployments.yaml", shop / "main/table_relationships.yaml"
    edit(tables, "  description: buyers\n", "  description: all buyers\n  update_reason: clearer words\n")
    places.write_text("- system: lake\n  schemas:\n    main: main_v2\n")
    edit(rels, "validated: false", "validated: true\n  update_reason: checked")
    read.clear()
    run("words", 3)
    # A changed row opens its own bucket only.
    opened = {name: only for name, only in read if only}
    assert {name: len(b) for name, b in opened.items()}.keys() == {"tables", "deployment_tables", "table_relationships"}
    assert len(opened["tables"]) == len(opened["table_relationships"]) == 1
    assert audit(store)[-1][2:5] == (0, 4, 0)
    row = store.state(spec).where("table_id = 'shop.main.buyer'").first()
    assert (row.description, row.insert_ts.hour, row.update_ts.hour) == ("all buyers", 1, 3)
    old = [(r.table_id, r.description, r.update_reason, r.end_ts.hour) for r in store.history(spec).collect()]
    assert old == [("shop.main.buyer", "buyers", None, 3)]
    lake = store.state(RELATIONS["deployment_tables"]).where("system = 'lake'")
    assert {r.physical_schema_name for r in lake.collect()} == {"main_v2"}
    assert store.state(RELATIONS["table_relationships"]).first().validated_ts.hour == 3
    # A row's last run is found through its time.
    who = Y.commit_of_row(store.state(spec), store.audit()).select("table_id", "commit_sha").collect()
    assert dict(map(tuple, who)) == {"shop.main.buyer": "words", "shop.main.sale": "first", "hub.views.person": "first"}

    # Deletes above the limit are refused, nothing is written; confirmed, they pass.
    rels.unlink()
    (shop / "concepts.yaml").unlink()
    kw = {"fraction": 0.05, "min_count": 2}
    refused = load.run_load(store, str(corpus_root), "gone", "2024-01-01 04:00:00", **kw)
    assert rules(refused) == ["mass_delete_guard"] and store.last_load() == 3
    with pytest.raises(ValueError):
        load.run_load(store, str(corpus_root), "gone", "2024-01-01 04:00:00", allow_mass_delete=True)
    run("gone", 4, allow_mass_delete=True, confirmed=True, **kw)
    assert audit(store)[-1][2:5] == (0, 0, 2)
    rel = RELATIONS["table_relationships"]
    walk = Y.history_walk(store.state(rel), store.history(rel), list(rel.key)).orderBy("update_ts").collect()
    assert [(r.update_ts.hour, r.outcome, r.end_reason) for r in walk] == [(1, "replaced", "checked"), (3, "deleted", None)]
    then = Y.as_of(store.state(rel), store.history(rel), "2024-01-01 03:30:00").collect()
    assert [r.validated for r in then] == [True]

    # A reset drops the old versions and keeps the state.
    run("reset", 5, reset_history=True, confirmed=True)
    assert store.history(spec).count() == 0 and store.history(rel).count() == 0
    assert audit(store)[-1] == (5, "reset", 0, 0, 0, True)
    assert counts(store)["tables"] == 3

    # An unexplained update is refused.
    edit(tables, "  update_reason: clearer words\n", "")
    edit(tables, "all buyers", "some buyers")
    refused = load.run_load(store, str(corpus_root), "silent", "2024-01-01 06:00:00")
    assert rules(refused) == ["reason_discipline"] and store.last_load() == 5


def test_digests_of_buckets(spark):
    spec, store = RELATIONS["concepts"], Store(spark, "/nowhere", buckets=3)
    rows = [(f"s.concept.k{i}", None if i % 3 else "L", "d", None, [f"a{i}", "b"], None) for i in range(50)]

    def digests(rows, **kw):
        df = spark.createDataFrame(rows, spec.authored_schema()).repartition(kw.get("parts", 2))
        return {r.bucket: r.digest for r in store.digests(spec, df).collect()}

    base = digests(rows)
    assert base == digests(rows[::-1], parts=7) and len(base) == 3
    assert digests([]) == {}

    def moved(change):
        other = digests(change)
        return {b for b in base if base[b] != other.get(b)}

    # One row more, one twice, another label, a list in another order, an empty text for NULL: one bucket each.
    for change in (rows[1:], [*rows, rows[0]], [(*rows[0][:1], "x", *rows[0][2:]), *rows[1:]], [(*rows[0][:4], ["b", "a0"], None), *rows[1:]], [(*rows[0][:3], "", *rows[0][4:]), *rows[1:]]):
        assert len(moved(change)) == 1


def test_scratch_folders_go_when_all_went_well(spark):
    from catalith.checkpoints import scratch, stage, staging_folder

    def there(folder):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    outer = staging_folder(spark)
    with scratch(spark):
        inner = staging_folder(spark)
        kept = stage(stage(spark.range(3), inner, "a"), outer, "b")
    assert not there(inner) and there(outer) and kept.count() == 3
    with pytest.raises(KeyError), scratch(spark):
        inner = staging_folder(spark)
        stage(spark.range(3), inner, "a")
        raise KeyError
    assert there(inner)


def test_wave_one_reports_everything_at_once(spark, corpus_root):
    shop = corpus_root / "sources" / "shop"
    edit(shop / "data_source.yaml", "owner: sales team", "ownr: sales team")
    edit(shop / "main/tables.yaml", "- table_name: sale", "- table_name: Sale")
    write(shop / "main/columns/extra.yaml", "- table_name: buyer\n")
    write(shop / "mappings/hub.yaml", "[]\n")
    write(shop / "main/notes.yml", "")
    write(shop / "main/schema.yml", "description: x\n")
    write(shop / "concepts/twice.yaml", "- name: concept.x\n  name: concept.y\n")
    edit(corpus_root / "systems.yaml", "- system: mart\n  description: serving", "- system: mart\n  description: 2024-01-01")
    _, issues = load.assemble(spark, str(corpus_root))
    found = {(r.rule, r.object_key) for r in issues.collect()}
    assert {
        "unknown_keys", "required_fields", "check_label", "classify_paths", "wrong_extension", "shard_form_conflict",
        "read_documents", "field_kind",
    } <= {r for r, _ in found}
    assert ("wrong_extension", "sources/shop/main/schema.yml") in found
    # `notes.yml` would not be a corpus file under any spelling, so it is no issue.
    assert ("wrong_extension", "sources/shop/main/notes.yml") not in found


def test_one_defect_one_issue(spark, corpus_root):
    """A rejected table row must not echo as an empty or unknown placement."""
    hub = corpus_root / "sources" / "hub"
    edit(hub / "views/tables.yaml", "description: people", "description: ''")
    write(hub / "deployments.yaml", "- system: mart\n  schemas:\n    views:\n      tables:\n        person: p\n")
    _, issues = load.assemble(spark, str(corpus_root))
    # A blank required field is also a blank: the required rule alone owns `description`.
    assert [(r.rule, r.object_type) for r in issues.collect()] == [("required_fields", "tables")]


def test_wave_two_rules(spark, corpus_root):
    shop = corpus_root / "sources" / "shop"
    edit(shop / "main/table_relationships.yaml", "shop.main.sale.buyer_id", "shop.main.sale.Buyer_id")
    edit(shop / "main/mappings/hub.yaml", "hub.views.person.person_key", "hub.views.person.person_key + shop.main.sale.sale_id")
    edit(shop / "concepts.yaml", "  - shop.main.sale.sale_id", "  - shop.main.nothing")
    corpus, issues = load.assemble(spark, str(corpus_root))
    assert issues.isEmpty()
    found = {(r.rule, r.detail, r.hint) for r in load.validate(corpus).collect()}
    assert found == {
        ("refs_resolve", "shop.main.sale.Buyer_id", "shop.main.sale.buyer_id"),
        ("array_reference", "shop.main.nothing", None),
        ("nway_codeployed", "2 table(s) share no system", None),
        ("linkable_tables", "hub.views.person and shop.main.buyer", None),
    }
