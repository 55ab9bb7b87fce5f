"""Registered queries of the training-data operators, and their SQL restatements."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pitlake.llm import (
    bpe, chat, collocations, exact, html, interactions, mixing, quality, repeats, rules, secrets, simhash, warc,
)
from pitlake.llm.common import reach_workers, table

BPE_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BPE_PATTERN = public_tokenizers.PATTERN


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.report(table(spark, sf_dir, "pages"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), BPE_FILE, BPE_PATTERN)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(table(spark, sf_dir, "conversations"), BPE_FILE, BPE_PATTERN)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.report(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.report(table(spark, sf_dir, "documents"))


Query = Callable[[SparkSession, str], DataFrame]


def _registered(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reach_workers(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    q.__name__: _registered(q) for q in (
        op1_simhash, op2_quality_rules, op3_warc, op4_main_text, op5_repeats,
        op6_mixing, op7_byte_bpe, op8_chat, op9_exact_dedup, op10_quality,
        op11_filter_interactions, op12_secrets, op13_collocations,
    )
}

ORACLES: dict[str, str] = {
    "op2_quality_rules": rules.ORACLE,
    "op3_warc": warc.ORACLE,
    "op11_filter_interactions": interactions.ORACLE,
    "op12_secrets": secrets.ORACLE,
    "op13_collocations": collocations.ORACLE,
    "op9_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') t FROM documents),
        g AS (SELECT t, min(doc_id) keep_id, count(*) group_size FROM n GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM n JOIN g USING (t)""",
}
