"""Training corpus pipeline: quality, exact copies, near copies, mixture, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept; its result is written
as Parquet in the shared folder and read again. Other columns of the documents pass through, whatever
their names; an empty table passes through empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm import bpe, exact, mixing, quality, simhash
from pitlake.llm.common import reach_workers, table
from pitlake.llm.queries import BPE_FILE, BPE_PATTERN
from pitlake.plans.scratch import staged


def _aside(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """`docs` with its columns in one struct beside `doc_id`, `lang` and `text`, and how to get them back."""
    whole = F.struct(*(F.col(f"`{c}`").alias(c) for c in docs.columns)).alias("whole")
    return docs.select("doc_id", "lang", "text", whole), [F.col("whole")[c].alias(c) for c in docs.columns]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts."""
    rows, back = _aside(docs)
    labels = table(spark, sf_dir, "labels").filter(~quality.is_held_out(F.col("doc_id")))
    ensemble = quality.fit_on(rows.select("doc_id", "text"), labels)
    scored = quality.with_statistics(rows, keep=("whole",)).withColumn("score", ensemble.score())
    return scored.filter(F.col("score") >= quality.THRESHOLD).select(*back)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of every group of equal texts."""
    return exact.deduplicate(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of every group of near copies, over shingles of five words."""
    reach_workers(spark)
    return simhash.deduplicate(docs, words=5)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of languages asks for; each at least once."""
    rows, back = _aside(docs)
    known = mixing.known_domains(docs, table(spark, sf_dir, "labels"))
    mixture = mixing.mix(docs, known, power=0.7, every_document=True)
    rated = mixture.rated(mixing.with_words(rows))
    return rated.select("whole", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select(*back)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document, and whether they decode to its text."""
    reach_workers(spark)
    rows = docs.select("doc_id", "lang", "source", "text")
    coded = bpe.decode(bpe.encode(rows, BPE_FILE, BPE_PATTERN), BPE_FILE, out="raw")
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"),
        F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"),
        (F.col("raw") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mixing_to_targets", mixing_to_targets),
    ("byte_bpe", byte_bpe),
]

#: SQL cannot express the fitted stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
