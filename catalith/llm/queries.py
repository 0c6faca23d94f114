"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.checkpoints import staging_folder
from catalith.llm import (
    byte_bpe,
    decontaminate,
    fill_in_middle,
    importance,
    language_id,
    near_dedup,
    quality_rules,
    secret_scans,
    sharding,
    substring_dedup,
    token_counts,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]
N_SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rules = quality_rules.learned_rules(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules, ["doc_id"])


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.scan(_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    # The table has no capture time; a page's number stands for the seconds since the crawl began.
    captured = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("page_id"))
    return warc.archive(pages, f"{staging_folder(spark)}/archives", captured)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.find_hits(docs, benchmark))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = token_counts.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    counts = token_counts.count_tokens(_table(spark, sf_dir, "documents"), model)
    return counts.withColumn("over_limit", F.col("n_tokens") > token_counts.MAX_TOKENS)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.train(docs))
    return found.select("doc_id", language_id.is_held_out().alias("held_out"), "lang_pred", "score")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"), N_SHARDS, ["lang", "source", "n_chars"])


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(fill_in_middle.transform(_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_secret_scans": op2_secret_scans,
    "op3_warc": op3_warc,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_decontamination": op5_decontamination,
    "op6_token_counts": op6_token_counts,
    "op7_language_id": op7_language_id,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_near_dedup": op9_near_dedup,
    "op10_sharding": op10_sharding,
    "op11_toxicity": op11_toxicity,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_fill_in_middle": op13_fill_in_middle,
}
# Word windows, hashes, models and tokens have no SQL form.
ORACLES: dict[str, str] = {
    "op13_fill_in_middle": """
with drawn as (
    select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n, sha256('1:' || coalesce(doc_id::varchar, '')) as h
    from documents
),
numbers as (
    select *, ('0x' || h[1:8])::bigint % (n + 1) as c1, ('0x' || h[9:16])::bigint % (n + 1) as c2,
           ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4
    from drawn
),
formed as (
    select *, least(c1, c2) as a, greatest(c1, c2) as b,
           case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
                when h4 % 100 < 20 then 'spm' else 'psm' end as form
    from numbers
),
parts as (
    select *, substring(text, 1, a) as prefix, substring(text, a + 1, b - a) as middle, substring(text, b + 1, n - b) as suffix
    from formed
)
select doc_id, n::bigint as n, form,
       case when form <> 'plain' then a::bigint end as prefix_chars,
       case when form <> 'plain' then (b - a)::bigint end as middle_chars,
       sha256(case form when 'plain' then text
                        when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(prefix || middle || suffix) as restored_sha256
from parts
"""
}
