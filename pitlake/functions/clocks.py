"""The two clocks as column expressions.

`knowledge_time` says when the world could know a fact and alone drives as-of logic; `written_at`
says when the system recorded it and only breaks ties. No function here reads a wall clock: every
"now" is an argument.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXCHANGE_TZ = "America/New_York"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def end_of_day_knowledge(day: Column | str) -> Column:
    """23:59:59 exchange time on `day`, as a UTC instant."""
    wall = col(day).cast("timestamp") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
    return F.to_utc_timestamp(wall, EXCHANGE_TZ)


def exchange_date(instant: Column | str) -> Column:
    """The exchange-local calendar date of a UTC instant."""
    return F.to_date(F.from_utc_timestamp(col(instant), EXCHANGE_TZ))


def exchange_wall_to_utc(wall: Column | str) -> Column:
    """Naive exchange wall time to a UTC instant."""
    return F.to_utc_timestamp(col(wall), EXCHANGE_TZ)
