"""Toxicity scores, importance resampling and fill-in-the-middle transformation."""

import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from catalith.llm import fill_in_middle, importance, queries, toxicity

from . import brute
from .conftest import ODD, SCHEMA, SF_DIR


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# --- fill in the middle


def transformed(df, **options):
    made = fill_in_middle.transform(df, **options)
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    return [tuple(r) for r in made.select(*columns, fill_in_middle.restored(F.col("output"), F.col("form")).alias("back")).collect()]


def test_fill_in_middle(spark, documents, odd, empty):
    random.seed(7)
    parts = ["<", "<P>", "<S", ">", "P>", "<<", "M>", "é", "😀", "\n", "a", "日", "e\u0301", "\x00", "<M"]
    rows = [(i, "".join(random.choice(parts) for _ in range(random.randint(0, 12)))) for i in range(600)]
    for df in (documents, odd, empty, spark.createDataFrame(rows, SCHEMA).repartition(4)):
        want = [(d, *brute.filled(d, t), t or "") for d, t in pairs(df)]
        assert sorted(transformed(df), key=str) == sorted(want, key=str)
    forms = {r[2] for r in transformed(documents)}
    assert forms == {"plain", "psm", "spm"}


def test_fill_in_middle_of_texts_longer_than_one_match(spark, documents):
    assert transformed(documents, one_match=7) == transformed(documents)
    long = spark.createDataFrame([(k, "aé😀" * 400_000) for k in range(3)], SCHEMA)
    assert transformed(long) == [(d, *brute.filled(d, t), t) for d, t in pairs(long)]


def test_fill_in_middle_by_other_units(spark):
    rows = [(i, "one two  three\nfour") for i in range(50)] + [(99, " leading")]
    got = transformed(spark.createDataFrame(rows, SCHEMA), unit=r"\S+\s*", transformed=100)
    borders = {0, 4, 9, 15, 19}
    assert {r[1] for r in got[:-1]} == {4} and all(r[3] in borders and r[3] + r[4] in borders for r in got[:-1])
    assert all(r[6] == "one two  three\nfour" for r in got[:-1])
    assert got[-1][1:] == (0, "plain", None, None, " leading", " leading")  # no sequence of such units


def test_fill_in_middle_equals_its_sql(spark):
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    rows = queries.op13_fill_in_middle(spark, SF_DIR)
    want = db.sql(f"select {', '.join(rows.columns)} from ({queries.ORACLES['op13_fill_in_middle']})").fetchall()
    assert sorted(tuple(r) for r in rows.collect()) == sorted(want)


# --- importance resampling


def resampled(df, target, **options):
    return {tuple(r) for r in importance.resample(df, target, **options).collect()}


def test_importance_resampling(spark, documents, empty):
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    texts = [r.text for r in bench.collect()]
    assert resampled(documents, bench) == brute.resampled(pairs(documents), texts)
    # Ties: equal texts, and rows with an id each; many partitions; a draw of none.
    random.seed(8)
    words = ["a", "b", "É", "1x", "日本"]
    rows = [(i, random.choice([None, "", "?!", " ".join(random.choices(words, k=random.randint(1, 40))), "a " * 30])) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    target = spark.createDataFrame([(None,), ("a B a b",), ("x" * 3000,)], "text string")
    assert resampled(df, target) == brute.resampled(rows, ["a B a b", "x" * 3000])
    assert resampled(df, target.limit(0)) == brute.resampled(rows, [])
    assert resampled(empty, target) == set()


def test_importance_of_odd_rows(spark, odd, documents):
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    got = importance.resample(odd, bench, min_words=1, share=(1, 1)).collect()
    assert sorted(r.n_features for r in got) == sorted(len(brute.features(t)[0]) for _, t in ODD)
    drawn = [r for r in got if r["rank"] is not None]
    assert sorted(r["rank"] for r in drawn) == list(range(1, 9)) and all(r.weight == 0 for r in got if not r.n_features)
    assert [r.score for r in sorted(drawn, key=lambda r: r["rank"])] == sorted((r.score for r in drawn), reverse=True)
    ranked = importance.resample(documents, bench)
    chosen = importance.drawn(documents, ranked)
    assert chosen.count() == ranked.where("rank is not null").count() > 0 and chosen.columns == documents.columns


def test_words_are_told_from_the_number_of_runs():
    for most in (1, 2, 3, 5):
        scan = importance.Scan(most, 1000)
        for n in (*range(9), 50):
            assert importance._words(len(scan.features(b" x, " * n)), most) == n


# --- toxicity


@pytest.fixture(scope="module")
def toxic_rows(spark):
    folder = SF_DIR.replace("0.001", "0.1")
    return queries.op11_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()


def test_toxicity_of_held_out_rows(toxic_rows):
    held = [r for r in toxic_rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in toxic_rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    caught = [r for r in held if r.toxic == 1 and r.predicted == 1]
    wrong = [r for r in held if r.toxic == 0 and r.predicted == 1]
    assert len(caught) > 0.8 * sum(r.toxic == 1 for r in held) and len(wrong) < 0.01 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in toxic_rows)


def test_toxicity_learns_from_labels_and_reads_nothing_else(spark):
    random.seed(9)
    calm, rude = [f"w{i}" for i in range(300)], ["grobnik", "grobnak", "fleeb"]
    rows = []
    for i in range(800):
        bad = i % 5 == 0
        words = random.choices(calm, k=40) + (random.choices(rude, k=2) if bad else [])
        rows.append((i, " ".join(words), "en", i, int(bad)))
    schema = SCHEMA + ", votes string, y bigint, toxic int"
    docs = spark.createDataFrame(rows, schema).repartition(5)
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("toxic")).alias("toxic"))
    labels = labels.unionByName(labels.where("doc_id < 50"))  # repeated labels
    found = toxicity.score(docs.drop("toxic"), labels).join(docs.select("doc_id", "toxic"), "doc_id").collect()
    assert len(found) == 800 and all(r.predicted == r.toxic for r in found)
    assert sum(r.held_out for r in found) == sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in range(800))
    # Held-out labels are not looked at: turned round, they change nothing.
    turned = labels.withColumn("toxic", F.when(toxicity.is_held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.score(docs.drop("toxic"), turned).collect()
    assert {(r.doc_id, round(r.score, 6)) for r in again} == {(r.doc_id, round(r.score, 6)) for r in found}


def test_toxicity_without_anything_to_learn(spark, odd, empty, documents):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    clean = spark.createDataFrame([(i, 0) for i in range(20)], "doc_id bigint, toxic int")
    for known in (none, clean):
        assert {(r.score, r.predicted) for r in toxicity.score(odd, known).collect()} == {(0.0, 0)}
    assert toxicity.score(empty, labels).isEmpty()
    got = toxicity.score(documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text")), labels).collect()
    assert len(got) == documents.count() + len(ODD) and all(r.score is not None and r.held_out is not None for r in got)


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(3)
    n, voters = 40_000, 6
    y = rng.random(n) < 0.2
    votes = np.zeros((n, voters), np.int64)
    rates = [(0.6, 0.02), (0.5, 0.1), (0.4, 0.05), (0.3, 0.3), (0.7, 0.2), (0.0, 0.0)]
    for k, (toxic, clean) in enumerate(rates):
        votes[:, k] = rng.random(n) < np.where(y, toxic, clean)
    votes[:, 5] = np.where(rng.random(n) < 0.9, votes[:, 1], votes[:, 0])  # mostly a copy of voter 1
    known = rng.random(n) < 0.05
    label = np.where(known, y.astype(int), -1)
    with_all = np.column_stack([votes, np.ones(n)])

    def sums(share):
        return np.array([(with_all * s[:, None]).T @ with_all for s in (1 - share, share)])

    first = np.array([(with_all * (label == k)[:, None]).T @ with_all for k in (0, 1)])
    model = toxicity.label_model(first, 0.2)
    for _ in range(8):
        model = toxicity.label_model(sums(model.posterior(votes, label)), 0.2)
    alone = toxicity.label_model(sums(model.posterior(votes, label)), 0.2, np.full(voters, -1)).fires[:, 0]
    for k, (toxic, clean) in enumerate(rates[:5]):
        assert abs(alone[1, k] - toxic) < 0.05 and abs(alone[0, k] - clean) < 0.02
    assert {int(model.parent[1]), int(model.parent[5])} & {1, 5} and model.parent[3] == -1
    guessed = model.posterior(votes) > 0.5
    assert (guessed == y).mean() > 0.9


def test_terms_and_votes_on_few_texts(spark):
    rows = [(1, "vile vile vilest"), (1, "vile"), (0, "calm"), (0, None), (1, "vile calm"), (1, "a vile")] + [(0, "calm sea")] * 30
    terms = toxicity.mined_terms(spark.createDataFrame(rows, "_y int, text string"))
    assert ("vil", 1) in terms and not any(t.startswith("calm") for t, _ in terms)
    voters = toxicity.Voters([("vil", 1), ("vile$", 2)])
    docs = spark.createDataFrame([(1, "VILE, vile!!!"), (2, "x" * 9), (None, None)], SCHEMA)
    got = {r._doc: (r.votes, r.terms, r.counts) for r in toxicity.scanned(docs, voters, "doc_id", "text").collect()}
    names = list(toxicity.PATTERNS)
    bit = lambda p: 1 << (2 + names.index(p))
    assert got == {1: (3 | bit("disgust") | bit("shout"), [0, 1], [2, 2]), 2: (bit("lengthened"), [], []), None: (0, [], [])}
    assert all(re.compile(p) for p in toxicity.PATTERNS.values())
