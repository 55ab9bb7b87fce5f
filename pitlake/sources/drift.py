"""Payloads that no longer fit: rejected whole, with a reason, beside the rows that parsed.

A payload with one bad row yields no rows at all, so a half-read file can never vote.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA_DRIFT = "schema_drift"


class SchemaDrift(ValueError):
    """Raised in strict mode when any payload was rejected."""


class Parsed(NamedTuple):
    """Rows of the payloads that fit, and (landing_key, error_class, detail) of the others."""

    good: DataFrame
    rejects: DataFrame


def first_problem(*checks: tuple[Column, str | Column]) -> Column:
    """The text of the first failing check, null when all pass."""
    return F.coalesce(
        *[F.when(bad, F.lit(text) if isinstance(text, str) else text) for bad, text in checks],
        F.lit(None).cast("string"),
    )


def split_parsed(rows: DataFrame, problem: str = "problem") -> Parsed:
    """Separate payload rows by their problem column."""
    rejects = rows.filter(F.col(problem).isNotNull()).select(
        "landing_key", F.lit(SCHEMA_DRIFT).alias("error_class"), F.col(problem).alias("detail")
    )
    return Parsed(rows.filter(F.col(problem).isNull()).drop(problem), rejects)


def once(value: Column) -> Column:
    """`value` through a generator of one row: the optimizer never repeats it, however often it is named."""
    return F.explode(F.array(value))


def split_payloads(payloads: DataFrame, problem: Column, rows: Column, columns: list[str]) -> Parsed:
    """Payloads with their rows as an array: the verdict is in the row, so no aggregate and no join is needed.

    `problem` is a text, null when the payload fits; `rows` are those that count, of which `columns` (beside
    landing_key and ticker, which are the payload's) are given out.
    """
    judged = payloads.withColumn("problem", problem)
    own = [c for c in columns if c in ("landing_key", "ticker")]
    good = judged.filter("problem IS NULL").select(*own, F.explode(rows).alias("row"))
    return Parsed(
        good.select(*[F.col(c) if c in own else F.col(f"row.{c}").alias(c) for c in columns]),
        judged.filter("problem IS NOT NULL").select(
            "landing_key", F.lit(SCHEMA_DRIFT).alias("error_class"), F.col("problem").alias("detail")
        ),
    )


def judge(rows: DataFrame, problem: Column) -> Parsed:
    """Reject payloads by an aggregate over their rows.

    `problem` is a text aggregate per landing_key, null when the payload fits. Rows are typed where
    they lie and never gathered: the verdicts, one small row per payload, meet them in an anti join.
    """
    rejects = (
        rows.groupBy("landing_key")
        .agg(problem.alias("detail"))
        .filter("detail IS NOT NULL")
        .select("landing_key", F.lit(SCHEMA_DRIFT).alias("error_class"), "detail")
    )
    return Parsed(rows.join(rejects.select("landing_key"), "landing_key", "left_anti"), rejects)


def strict(parsed: Parsed) -> DataFrame:
    """The good rows, or SchemaDrift naming the first few rejected payloads."""
    shown = parsed.rejects.limit(5).collect()
    if shown:
        raise SchemaDrift("; ".join(f"{r.landing_key}: {r.detail}" for r in shown))
    return parsed.good


def drift_letters(rejects: DataFrame, job_name: str, first_seen: Column) -> DataFrame:
    """Rejects as dead letters."""
    return rejects.select(
        F.lit(job_name).alias("job_name"),
        F.split_part("landing_key", F.lit(":"), F.lit(2)).alias("source"),
        F.regexp_extract("landing_key", "^[^:]*:[^:]*:(.*)$", 1).alias("request_key"),
        F.lit(None).cast("string").alias("payload_path"),
        "error_class",
        "detail",
        first_seen.alias("first_seen"),
        F.lit(0).alias("retry_count"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
    )
