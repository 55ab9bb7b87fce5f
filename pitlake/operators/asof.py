"""As-of lookups in two forms.

Where the calendar bounds the rows of a key on both sides, `last_before` puts both under one sorted window:
a single exchange. Facts without such a bound are not sorted: the
sparse side is folded into disjoint intervals, and
facts meet it through an equi-join on the key with an interval condition:

* each fact matches at most one interval, so nothing multiplies;
* a small interval table is broadcast by Spark's own size threshold and the facts never move;
* above the threshold it is a sort-merge join on the key, where AQE may split a hot key freely.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def running_steps(events: DataFrame, key: str, at: str, measures: Sequence[str]) -> DataFrame:
    """Prefix sums as intervals: `[step_from, step_to)` holds the sum of events at or before it.

    Events of one (key, at) are summed first, so a key has at most one row per calendar day when the
    window below runs.
    """
    daily = events.groupBy(key, at).agg(*[F.sum(m).alias(m) for m in measures])
    w = W.partitionBy(key).orderBy(at)
    up_to = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    return daily.select(
        key,
        F.col(at).alias("step_from"),
        F.lead(at).over(w).alias("step_to"),
        *[F.sum(m).over(up_to).alias(m) for m in measures],
    )


def remaining_steps(events: DataFrame, key: str, at: str, measures: Sequence[str]) -> DataFrame:
    """Suffix sums as intervals: `[step_from, step_to)` holds the sum of events strictly after it."""
    daily = events.groupBy(key, at).agg(*[F.sum(m).alias(m) for m in measures])
    w = W.partitionBy(key).orderBy(at)
    from_here = w.rowsBetween(W.currentRow, W.unboundedFollowing)
    return daily.select(
        key,
        F.lag(at).over(w).alias("step_from"),
        F.col(at).alias("step_to"),
        *[F.sum(m).over(from_here).alias(m) for m in measures],
    )


def _inside(at: Column) -> Column:
    after = F.col("step_from").isNull() | (at >= F.col("step_from"))
    before = F.col("step_to").isNull() | (at < F.col("step_to"))
    return after & before


def lookup_step(
    facts: DataFrame, steps: DataFrame, key: str, at: str, how: str = "left"
) -> DataFrame:
    """Join every fact to the one interval that holds its `at`; interval bounds are dropped.

    The interval side gets a shuffle stage of its own. It is small, and its measured size is what lets
    adaptive execution broadcast it, or split the facts of a hot key when it cannot.
    """
    side = steps.withColumnRenamed(key, "_step_key").repartition("_step_key", "step_from")
    joined = facts.join(side, (F.col(key) == F.col("_step_key")) & _inside(F.col(at)), how)
    return joined.drop("_step_key", "step_from", "step_to")


def last_before(
    requests: DataFrame, facts: DataFrame, key: str, request_at: str, fact_at: str, value: str,
) -> DataFrame:
    """For each distinct (key, request_at): `value` of the latest fact strictly before it.

    Both sides meet in one exchange on the key, where a sorted window carries the latest value on: for facts
    whose rows per key the calendar bounds. A request with none before it has no row.
    """
    wanted = requests.select(key, F.col(request_at).alias("_at"), F.lit(0).alias("_kind"))
    known = facts.select(key, F.col(fact_at).alias("_at"), F.lit(1).alias("_kind"), F.struct(F.col(value).alias("v")).alias("_held"))
    # requests stand before the fact of their day
    before = W.partitionBy(key).orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, -1)
    rows = wanted.unionByName(known.filter(F.col("_at").isNotNull()), allowMissingColumns=True)
    return (
        rows.withColumn("_last", F.last("_held", ignorenulls=True).over(before))
        .filter((F.col("_kind") == 0) & F.col("_at").isNotNull() & F.col("_last").isNotNull())
        .select(key, F.col("_at").alias(request_at), F.col("_last.v").alias(value))
        .distinct()
    )
