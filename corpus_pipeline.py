"""The corpus pipeline: five stages, each a written table that the next one reads.

Every stage but the last returns the columns of `documents`, with the rows and texts that
its decisions leave; further columns are left out, whatever their names.

Null, empty and wordless texts fail the base rule of quality and go there; texts of any
length are judged whole. Equal rows of one id and text stay once; rows of one id and
several texts, and rows with a null id, are judged by their text. Ties between copies go
to the smallest id. Empty tables give empty tables; without labels only the base rule
rejects, without a benchmark nothing is cut.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.checkpoints import drop_folder, scratch, stage, staging_folder
from catalith.llm import byte_bpe, decontaminate, near_dedup, quality_rules, secret_scans

# Texts are long: what goes to a Python worker at once is bounded by fewer rows and bytes than Spark's own defaults.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Word windows, signatures and learned rules have no SQL form; the tests hold the result against brute force.
ORACLE_SQL = None


def _small_batches(spark: SparkSession) -> None:
    for k, v in BATCHES.items():
        spark.conf.set(k, v)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a learned rule rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = quality_rules.learned_rules(docs, labels)
    judged = quality_rules.judge(docs, rules, COLUMNS)
    return judged.where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id; equal rows of one id and text stay once."""
    _small_batches(spark)
    # Texts are not shuffled again: who goes is a bit table first, and an exact list where it says so.
    return near_dedup.without(docs, near_dedup.judged(docs)).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document with nothing else goes."""
    _small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.cut_hits(docs.select(*COLUMNS), benchmark, length="n_chars")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secret_scans.redact(docs.select(*COLUMNS), length="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with digests of the ids and of what they decode to."""
    _small_batches(spark)
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    # Executors that ran four stages have less memory to spare.
    return byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, with_ids=True, remembered=24 << 20, at_once=1 << 18)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    folder, before = staging_folder(spark), None
    for name, function in STAGES[:-1]:
        # Once a stage is written, what it was made from and its own tables go.
        with scratch(spark):
            docs = stage(function(spark, docs, sf_dir), folder, name.replace(" ", "_"))
        if before:
            drop_folder(spark, before)
        before = f"{folder}/{name.replace(' ', '_')}"
    return STAGES[-1][1](spark, docs, sf_dir)
