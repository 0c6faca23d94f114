"""Operators on whole texts and files: archives, tokens, languages, shards, and the pipeline."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from catalith.checkpoints import staging_folder
from catalith.llm import byte_bpe, components, language_id, queries, sharding, token_counts, warc

from . import brute
from .conftest import ODD, SCHEMA, SF_DIR

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def archived(spark, pages):
    captured = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id"))
    rows = warc.archive(pages, f"{staging_folder(spark)}/archives", captured).collect()
    keys = [(r.urlkey, r.captured, r.page_id or -1) for r in rows]
    assert keys == sorted(keys)
    return {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows}, rows


def test_archives(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    assert archived(spark, pages)[0] == brute.warc([(r.page_id, r.html) for r in pages.collect()])


def test_odd_archives(spark):
    rows = [
        (1, None, None), (2, "http://a b\r\nX: y/", "x\r\n\r\nWARC/1.1\r\n\r\n"), (3, "http://www.A.com/P#f", ""), (4, "é", "日本\r\n"),
        (5, "http://q.com/?a", None), (6, "u", "日本\r\n"), (7, "http://q.com/", "y" * 300_000),
    ]
    schema = "page_id bigint, url string, html string"
    pages = spark.createDataFrame([(*r, 0) for r in rows], schema + ", n bigint").repartition(3)
    got, entries = archived(spark, pages)
    assert got == brute.warc([(p, h) for p, _, h in rows])
    assert next(r.urlkey for r in entries if r.page_id == 3) == "com,a)/p"
    same = archived(spark, spark.createDataFrame([rows[3], rows[3]], schema))[1]
    assert [r.record_type for r in same] == ["response", "response"]
    assert archived(spark, spark.createDataFrame([], schema))[0] == {}


def test_archives_of_few_bytes_each(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").coalesce(1)
    folder = f"{staging_folder(spark)}/archives"
    warc.write_archives(pages, folder, F.timestamp_seconds("page_id"), file_bytes=20_000)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    assert files.count() > 5
    got = {int(r.page_id): r.payload_bytes for r in warc.read_index(spark, folder).collect()}
    assert got == {r.page_id: len((r.html or "").encode()) for r in pages.collect()}


@pytest.mark.parametrize("k", [0, 1, 2, 5, 8])
def test_loser_tree_merges(k):
    random.seed(k)
    runs = [sorted(random.choices(range(20), k=random.randint(0, 12))) for _ in range(k)]
    assert list(warc.LoserTree([iter(r) for r in runs], lambda x: x)) == sorted(itertools.chain(*runs))


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_byte_bpe(spark, documents, odd, empty, library):
    for df in (documents, odd, empty):
        got = byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
        texts = [r.text or "" for r in df.collect()]
        assert [r.ids for r in got] == library.encode_ordinary_batch(texts)
        for r, t in zip(got, texts, strict=True):
            assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() and r.n_tokens == len(r.ids)
            assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()


def test_byte_bpe_on_single_characters_and_long_words(library):
    encoder = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    random.seed(2)
    texts = [f"a{chr(c)}1{chr(c)} {chr(c)}  {chr(c)}" for c in range(0, 0x30000, 7) if not 0xD800 <= c <= 0xDFFF]
    texts += ["".join(random.choice("abcde") for _ in range(n)) for n in (63, 64, 65, 5000)]
    texts += ["a" * 4000, " " * 3000 + "x", "<|endoftext|>"]
    assert [x.tolist() for x in encoder.encode(texts)] == library.encode_ordinary_batch(texts)


def test_token_counts(spark, documents, odd, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for df in (documents, odd, empty):
        texts = [r.text or "" for r in df.collect()]
        got = token_counts.count_tokens(df, token_counts.read_model(path)).collect()
        assert [r.n_tokens for r in got] == [len(x) for x in library.encode(texts)]
        assert [r.n_bytes for r in got] == [len(t.encode()) for t in texts]


def test_token_counts_on_random_strings():
    model = token_counts.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    counts = token_counts.Counts(model, token_counts.whole_tokens(model))
    random.seed(1)
    parts = ["a", "b", " ", "  ", "▁", "\n", "\t", "é", "ｆ", "<s>", "the", "ing", " of", "　", "\x00", "日本", "😀", "2000", "..."]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 12))) for _ in range(5000)]
    assert counts.of(texts) == [len(x) for x in counts.library.encode(texts)]


def test_languages(spark):
    folder = SF_DIR.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = queries.op7_language_id(spark, folder).join(docs, "doc_id")
    held = got.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()
    assert got.where("score < 0 or score > 1 or score is null").isEmpty()


def test_languages_of_odd_texts(spark, documents, odd, empty):
    model = language_id.train(documents)
    got = {(r.doc_id, r.lang_pred, r.score) for r in language_id.predict(odd, model).collect() if r.doc_id in (1, 2, 3, 9, 10)}
    assert got == {(d, "und", 0.0) for d in (1, 2, 3, 9, 10)}
    assert language_id.predict(odd, model).where("doc_id in (6, 7, 8, 11) and lang_pred = 'und'").isEmpty()
    assert language_id.train(empty) is None and language_id.predict(empty, model).isEmpty()
    assert {r.lang_pred for r in language_id.predict(odd, None).collect()} == {"und"}


def test_only_the_most_frequent_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language_id, "LANGUAGES", 2)
    rows = [(i, f"{'aa bb' if i % 2 else 'cc dd'} {i}", ("x" if i % 2 else "y") if i < 90 else f"junk{i}") for i in range(100)]
    docs = spark.createDataFrame([*rows, *rows[:9]], "doc_id bigint, text string, lang string").repartition(3)
    model = language_id.train(docs)
    assert model.languages == ["x", "y"]
    found = language_id.predict(docs, model).collect()
    assert len(found) == 109 and all(r.lang_pred == ("x" if r.doc_id % 2 else "y") for r in found)


def test_presence_of_grams_stops_at_text_ends():
    rows = np.concatenate([m for _, _, m in language_id.presence(pa.array(["ab", "cd", None, "ab"]))])
    assert (rows[0] == rows[3]).all() and rows.sum(axis=1).tolist() == [3, 3, 0, 3]


def checked_shards(df, dims, n=24):
    rows = sharding.assign(df, n, dims).collect()
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values(), default=0) - min((sizes.get(s, 0) for s in range(n)), default=0) <= 1
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in rows)
    assert {r.law for r in rows} <= {"rows"} and all(r.grown_shard is None for r in rows)
    return rows


def test_shards(spark, documents, odd, empty):
    import zlib

    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in checked_shards(documents, ["lang", "source", "n_chars"]):
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    assert len(checked_shards(odd, ["lang", "n_words"])) == len(ODD)
    assert checked_shards(empty, ["lang"]) == []


def test_shards_as_files(spark, documents):
    folder = f"{staging_folder(spark)}/shards"
    shards = sharding.assign(documents, 6, ["lang", "n_chars"])
    sharding.write(documents, shards, folder)
    back = spark.read.parquet(folder)
    assert {(r.doc_id, r.text) for r in back.collect()} == {(r.doc_id, r.text) for r in documents.collect()}
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(r.doc_id, r.shard) for r in shards.collect()}


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2)])
def test_hilbert_curve_visits_neighbours(spark, dims, bits):
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    names = [f"d{i}" for i in range(dims)]
    df = spark.createDataFrame(cells, ", ".join(f"{x} int" for x in names))
    rows = sharding.with_hilbert_index(df, names, bits, "h").orderBy("h").collect()
    assert [r.h for r in rows] == list(range(len(cells)))
    steps = [sum(abs(a[x] - b[x]) for x in names) for a, b in zip(rows, rows[1:], strict=False)]
    assert set(steps) == {1}


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(500, 500), (8, 9), (9, 8), (None, 3), (3, None)]
    df = spark.createDataFrame(links, "x bigint, y bigint").repartition(5)
    got = {r.node: r.component for r in components.components(df, "x", "y").collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(7, 60)} == {7}
    assert got.keys() == {*range(100, 161), *range(7, 60)} and components.components(df.limit(0), "x", "y").isEmpty()


def test_pipeline(spark):
    """Every stage against brute force on what the stage before left."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    columns, seen = docs.columns, [docs]
    for _, function in corpus_pipeline.STAGES:
        df = function(spark, seen[-1], SF_DIR)
        seen.append(spark.createDataFrame(df.collect(), df.schema))
    texts = [{r[0]: r[1] for r in df.collect()} for df in seen]
    assert all(df.columns == columns for df in seen[:-1])
    assert all(not brute.quality(t)[5] for t in texts[1].values())
    near = brute.near(list(texts[1].items()))
    assert texts[2] == {d: t for d, t in texts[1].items() if near[d][1] == d}
    for d, t in texts[2].items():
        hit = brute.hits(t, items)[1]
        assert (texts[3].get(d) == t) == (not hit) and (d not in texts[3] or not brute.hits(texts[3][d], items)[1])
    for d, t in texts[3].items():
        spans = brute.secrets(t)[0]
        assert (texts[4][d] == t) == (not spans) and not brute.secrets(texts[4][d])[0]
    final = {r.doc_id: r.decoded_sha256 for r in seen[5].collect()}
    assert final == {d: brute.sha(t) for d, t in texts[4].items()}
    assert all(r.n_chars == len(r.text) for r in seen[4].collect())
    assert {(r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF_DIR).collect()} == {(r.doc_id, r.ids_sha256) for r in seen[5].collect()}


def test_near_duplicates_stage_decides_by_row(spark):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(30)) for k in "abcd")
    rows = [(3, a), (5, a), (5, b), (5, b), (None, a), (None, c), (None, c), (8, d), (8, d), (9, "x"), (10, None)]
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in rows], SCHEMA + ", lang string, source string, n_chars bigint")
    left = corpus_pipeline.near_duplicates(spark, docs.repartition(3), SF_DIR).collect()
    want = [(3, a), (5, b), (None, c), (8, d), (9, "x"), (10, None)]
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted(want, key=str)


def test_pipeline_stages_on_odd_rows(spark):
    rows = [(d, t, None, None, None) for d, t in ODD]
    schema = SCHEMA + ", lang string, source string, n_chars bigint"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, function in corpus_pipeline.STAGES:
            assert function(spark, docs, SF_DIR).count() <= len(ODD)
