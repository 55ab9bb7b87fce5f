"""SCD-2 history as pure functions over a table partitioned by `is_current`.

A merge never rewrites closed versions: they pass through, contributing only the highest sequence of
each key, and the rows a merge writes are separate from the ones it leaves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitlake.functions.clocks import end_of_day_knowledge
from pitlake.functions.hashing import with_bar_hash

BAR_KEY = ["ticker", "bar_date"]
BAR_VALUES = [
    "open", "high", "low", "close", "volume", "source_set", "grade", "single_source",
]
ACTION_KEY = ["ticker", "action_type", "ex_date"]
ACTION_VALUES = ["ratio", "cash_amount", "declared_date", "confidence", "source_set"]

VERSION_COLUMNS = [
    "payload_hash", "knowledge_time", "valid_from", "valid_to", "is_current", "revision_seq",
]


def last_per_key(incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One incoming row per key, the last under `order` (Spark rows have no input order)."""
    w = W.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return incoming.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def require_columns(incoming: DataFrame, keys: Sequence[str], values: Sequence[str]) -> None:
    missing = sorted({*keys, *values, "payload_hash", "knowledge_time"} - set(incoming.columns))
    if missing:
        raise ValueError(f"incoming frame is missing {missing}")


def merge_pass(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    revision_knowledge: Column | None = None,
    order: Sequence[str] = ("knowledge_time", "payload_hash"),
) -> DataFrame:
    """Current and incoming rows of one merge with what becomes of each (`status`).

    Of several incoming rows with one key only the last under `order` counts.

    Current versions: absent (no incoming row), unchanged (same hash) or closed (other hash). Incoming
    rows: same as the current version, revised (opens after it at the detection time), reopened
    (history without a current version: opens after the highest closed sequence at the detection
    time) or new (no history: opens at 1 with its own knowledge).

    Incoming rows, current versions and one sequence per closed key meet in a single exchange on the
    key; beside repeated incoming rows, a key has at most three there.
    """
    require_columns(incoming, keys, values)
    keys = list(keys)
    shape = [*keys, *values, *VERSION_COLUMNS]
    current = existing.filter("is_current").select(*shape, F.lit("kept").alias("status"))
    past = (
        existing.filter("NOT is_current")
        .groupBy(*keys)
        .agg(F.max("revision_seq").alias("revision_seq"))
        .withColumn("status", F.lit("past"))
    )
    arrived = incoming.select(
        *keys, *values, "payload_hash", "knowledge_time", F.struct(*order).alias("_order")
    ).withColumn("status", F.lit("incoming"))
    # one exchange on the key serves both windows
    rows = current.unionByName(arrived, allowMissingColumns=True).unionByName(
        past, allowMissingColumns=True
    ).repartition(*keys)
    last = W.partitionBy(*keys, "status").orderBy(F.desc_nulls_last("_order"))
    rows = rows.withColumn("_rank", F.row_number().over(last)).filter("status <> 'incoming' OR _rank = 1")
    w = W.partitionBy(*keys)
    seen = rows.withColumns(
        {
            "_now": F.max(F.expr("IF(status = 'kept', payload_hash, NULL)")).over(w),
            "_next": F.max(F.expr("IF(status = 'incoming', payload_hash, NULL)")).over(w),
            "_at": F.max(F.expr("IF(status = 'incoming', knowledge_time, NULL)")).over(w),
            "_seq": F.max("revision_seq").over(w),
        }
    ).filter("status <> 'past'")
    status = F.expr(
        """CASE WHEN status = 'kept' AND _next IS NULL THEN 'absent'
                WHEN status = 'kept' AND _now = _next THEN 'unchanged'
                WHEN status = 'kept' THEN 'closed'
                WHEN _now = payload_hash THEN 'same'
                WHEN _now IS NOT NULL THEN 'revised'
                WHEN _seq IS NOT NULL THEN 'reopened'
                ELSE 'new' END"""
    )
    detected = F.col("_at") if revision_knowledge is None else revision_knowledge
    opens = F.expr("status IN ('new', 'revised', 'reopened')")
    opens_at = F.when(F.col("status") == "new", F.col("knowledge_time")).when(opens, detected)
    return (
        seen.withColumn("status", status)
        .withColumns(
            {
                "knowledge_time": F.coalesce(opens_at, F.col("knowledge_time")),
                "valid_from": F.coalesce(opens_at, F.col("valid_from")),
                "valid_to": F.when(F.col("status") == "closed", detected).otherwise(F.col("valid_to")),
                "is_current": F.col("status") != "closed",
                "revision_seq": F.when(opens, F.coalesce("_seq", F.lit(0)) + 1)
                .otherwise(F.col("revision_seq")).cast("int"),
            }
        )
        .select(*shape, "status")
    )


def touched_versions(passed: DataFrame) -> DataFrame:
    """What a merge writes: every current version, and the ones it closed, with their status.

    Together with the versions closed before this is the new state.
    """
    return passed.filter("status <> 'same'")


def changed_versions(passed: DataFrame) -> DataFrame:
    """The versions that a merge closed or opened, with their status."""
    return passed.filter("status IN ('closed', 'new', 'revised', 'reopened')")


def change_counts() -> list[Column]:
    """Aggregates over a merge pass or what it wrote; inserted counts every version opened."""
    status = F.col("status")
    return [
        F.count_if(status == "closed").alias("revised"),
        F.count_if(status.isin("new", "revised", "reopened")).alias("inserted"),
        F.count_if(status == "unchanged").alias("unchanged"),
    ]


def merge_history(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    revision_knowledge: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(new state, counts). Keys absent from `incoming` stay as they are."""
    passed = merge_pass(existing, incoming, keys, values, revision_knowledge)
    closed = existing.filter("NOT is_current").select(*keys, *values, *VERSION_COLUMNS)
    touched = touched_versions(passed)
    return closed.unionByName(touched.drop("status")), touched.agg(*change_counts())


def with_bar_knowledge(bars: DataFrame) -> DataFrame:
    """A daily bar is knowable at the end of its own exchange day."""
    return bars.withColumn("knowledge_time", end_of_day_knowledge("bar_date"))


def stamp_bars(bars: DataFrame) -> DataFrame:
    """Hash and knowledge stamp: what a merge needs beside keys and values."""
    return with_bar_knowledge(with_bar_hash(bars))


def upsert_bars(
    existing: DataFrame,
    raw_bars: DataFrame,
    source_set: str = "stooq",
    grade: str = "degraded",
    single_source: bool = True,
    revision_knowledge: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Merge ungraded raw bars, tagging every row alike."""
    tagged = raw_bars.select("ticker", "bar_date", "open", "high", "low", "close", "volume").withColumns(
        {
            "source_set": F.lit(source_set),
            "grade": F.lit(grade),
            "single_source": F.lit(single_source),
        }
    )
    return merge_history(existing, stamp_bars(tagged), BAR_KEY, BAR_VALUES, revision_knowledge)


def upsert_actions(
    existing: DataFrame,
    action_events: DataFrame,
    confidence: str = "single_source",
    revision_knowledge: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Merge action events, one per (ticker, action_type, ex_date).

    Without `revision_knowledge` a revised action opens at its own stamp, the ex-date.
    """
    incoming = action_events.select(
        *ACTION_KEY, "ratio", "cash_amount", "declared_date", "payload_hash", "knowledge_time",
        F.lit(confidence).alias("confidence"), F.lit("polygon").alias("source_set"),
    )
    return merge_history(existing, incoming, ACTION_KEY, ACTION_VALUES, revision_knowledge)


def latest_actions(action_events: DataFrame) -> DataFrame:
    """Newest observation per action: the replay input."""
    return last_per_key(
        action_events, ACTION_KEY, ["knowledge_time", "written_at", "payload_hash"]
    )


def history_asof(history: DataFrame, as_of: Column) -> DataFrame:
    """The versions believed at one knowledge time."""
    open_then = F.col("valid_to").isNull() | (F.col("valid_to") > as_of)
    return history.filter((F.col("valid_from") <= as_of) & open_then)


def bars_asof(history: DataFrame, requests: DataFrame) -> DataFrame:
    """Batch time travel: requests (ticker, bar_date, as_of) to (close, revision_seq)."""
    then = history.select("ticker", "bar_date", "close", "revision_seq", "valid_from", "valid_to")
    joined = requests.select("ticker", "bar_date", "as_of").join(then, BAR_KEY)
    return history_asof(joined, F.col("as_of")).select(
        "ticker", "bar_date", "as_of", "close", "revision_seq"
    )
