"""Canonical tables and the published snapshot as versioned Parquet.

A version becomes visible only when its commit row is written, after the data; readers take the newest
committed version. No path is overwritten while it can be read, and a failed run leaves the old version
in place. Only what Spark's own reader and writer offer is used, so any file system will do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake import schemas
from pitlake.operators import history
from pitlake.operators.contracts import assert_contract

# keys, values, and the day whose month a row is stored under
HISTORY_TABLES = {
    "bars_daily": (history.BAR_KEY, history.BAR_VALUES, "bar_date"),
    "corporate_actions": (history.ACTION_KEY, history.ACTION_VALUES, "ex_date"),
}
# stored by one column and rewritten by its values: a version holds the parts it replaced
PART_TABLES = {
    "latest_observations": "bucket", "beliefs": "bucket", "vote_results": "bucket",
    "live_quote_bars": "session_date", "serving_intraday": "session_date",
}
# every version holds only what it added
APPEND_TABLES = {
    "universe_snapshots", "bars_minute", "quote_bars_1m", "intraday_processed", "sectors", "folded_lots", "projected_versions",
}
SCHEMA_VERSION = 1
SORT_ORDER = {
    "daily_ohlcv": ["ticker", "effective_date"],
    "delisted": ["ticker", "termination_date"],
    "coverage": ["audit_window"],
    "intraday": ["ticker", "minute"],
    "sectors": ["ticker"],
    "gap_ledger": ["gap_key"],
}


class Lake:
    """Tables under `root`; the event store sits beside them so several roots can replay it."""

    def __init__(self, spark: SparkSession, root: str, events_root: str | None = None):
        self.spark = spark
        self.root = root
        self.events_root = events_root or root

    def _optional(self, path: str, ddl: str) -> DataFrame:
        try:
            return self.spark.read.schema(schemas.struct(ddl)).parquet(path)
        except AnalysisException as exc:
            if exc.getCondition() == "PATH_NOT_FOUND":
                return schemas.empty(self.spark, ddl)
            raise

    def version(self, name: str) -> int:
        """The newest committed version of a table, 0 when there is none."""
        commits = self._optional(f"{self.root}/commits/{name}", "version int")
        return commits.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def _commit(self, name: str, version: int, periods: DataFrame | None = None) -> None:
        """One row per commit; of history and part tables one per month or part that it rewrote."""
        rows = self.spark.range(1).select(F.lit(None).cast("string").alias("period")) if periods is None else periods
        if "emptied" not in rows.columns:
            rows = rows.withColumn("emptied", F.lit(False))
        rows.select(F.lit(version).cast("int").alias("version"), "period", "emptied").coalesce(1).write.mode(
            "append"
        ).parquet(f"{self.root}/commits/{name}")

    def parts(self, name: str) -> dict[str, int]:
        """The parts of a table that hold rows, and the version each was last written by.

        This comes to the driver: a table has as many parts as there are buckets, or sessions in the calendar.
        """
        log = self._optional(f"{self.root}/commits/{name}", "version int, period string, emptied boolean")
        newest = log.filter("period IS NOT NULL").groupBy("period").agg(
            F.max(F.struct("version", "emptied")).alias("last")
        )
        return {r.period: r.last.version for r in newest.collect() if not r.last.emptied}

    def read_parts(self, name: str, only: Sequence[str] | None = None, ddl: str | None = None) -> DataFrame:
        """The rows of the parts named (of all, if none are): only their folders are listed and opened."""
        ddl = ddl or schemas.CANONICAL_TABLES[name]
        held = self.parts(name)
        wanted = sorted(held if only is None else held.keys() & set(only))
        if not wanted:
            return schemas.empty(self.spark, ddl)
        base = f"{self.root}/tables/{name}"
        rows = self.spark.read.schema(schemas.struct(ddl + ", version int, part string")).option("basePath", base).parquet(
            *[f"{base}/version={held[p]}/part={p}" for p in wanted]
        )
        return rows.filter(F.col("part").isin(wanted)).select(*schemas.names(ddl))

    def write_parts(self, name: str, df: DataFrame, part: Column, replaced: Sequence[str], ddl: str | None = None) -> None:
        """Replace the parts named in `replaced` by the rows of `df`, which must belong to them; commit at the end.

        The files of other parts, and those that readers of the old parts hold, stay where they are.
        """
        shape = schemas.struct(ddl or schemas.CANONICAL_TABLES[name])
        version = self.version(name) + 1
        path = f"{self.root}/tables/{name}/version={version}"
        columns = [F.col(f.name).cast(f.dataType) for f in shape.fields]
        # a part in few files, a large one split
        df.select(*columns, part.cast("string").alias("part")).hint("rebalance", "part").write.mode(
            "overwrite"
        ).partitionBy("part").parquet(path)
        written = self._optional(path, "part string").distinct()
        told = self.spark.createDataFrame([(p,) for p in replaced], "period string")
        self._commit(name, version, told.join(written, F.col("period") == F.col("part"), "left").select(
            "period", F.col("part").isNull().alias("emptied")
        ))

    def _read_history(self, name: str, ddl: str, version: int, months: Sequence[str] | None = None) -> DataFrame:
        """Closed versions, written once, and current ones from the newest rewrite of each month.

        `months` limits both to those months, as literals that prune folders.
        """
        log = self._optional(f"{self.root}/commits/{name}", "version int, period string")
        newest = log.filter(F.col("version") <= version).groupBy("period").agg(F.max("version").alias("version"))
        parts = self.spark.read.schema(schemas.struct(ddl + ", version int, period string")).parquet(
            f"{self.root}/tables/{name}"
        )
        if months is not None:
            parts = parts.filter(F.col("period").isin(list(months)))
        closed = parts.filter((F.col("version") <= version) & ~F.col("is_current"))
        current = parts.filter("is_current").join(newest, ["version", "period"], "left_semi")
        return current.unionByName(closed)

    def read(self, name: str, ddl: str | None = None) -> DataFrame:
        """A table at its newest version; a typed empty frame before the first."""
        ddl = ddl or schemas.CANONICAL_TABLES[name]
        version = self.version(name)
        if version == 0:
            return schemas.empty(self.spark, ddl)
        if name in HISTORY_TABLES:
            return self._read_history(name, ddl, version).select(*schemas.names(ddl))
        if name in PART_TABLES:
            return self.read_parts(name, None, ddl)
        if name in APPEND_TABLES:
            parts = self.spark.read.schema(schemas.struct(ddl + ", version int")).parquet(
                f"{self.root}/tables/{name}"
            )
            return parts.filter(F.col("version") <= version).select(*schemas.names(ddl))
        return self.spark.read.schema(schemas.struct(ddl)).parquet(
            f"{self.root}/tables/{name}/version={version}"
        )

    def added(self, name: str, since: int) -> DataFrame:
        """What versions after `since` added to an append table."""
        ddl, version = schemas.CANONICAL_TABLES[name], self.version(name)
        if version <= since:
            return schemas.empty(self.spark, ddl)
        base = f"{self.root}/tables/{name}"
        return self.spark.read.schema(schemas.struct(ddl)).option("basePath", base).parquet(
            *[f"{base}/version={v}" for v in range(since + 1, version + 1)]
        ).select(*schemas.names(ddl))

    def write(self, name: str, df: DataFrame, ddl: str | None = None) -> DataFrame:
        """Write and commit the next version, then read the table back (which cuts lineage).

        For append tables `df` is what is added, for the others the whole new content.
        """
        shape = schemas.struct(ddl or schemas.CANONICAL_TABLES[name])
        version = self.version(name) + 1
        df.select(*[F.col(f.name).cast(f.dataType) for f in shape.fields]).write.mode(
            "overwrite"
        ).parquet(f"{self.root}/tables/{name}/version={version}")
        self._commit(name, version)
        return self.read(name, ddl)

    def merge(self, name: str, incoming: DataFrame, revision_knowledge: Column | None) -> dict[str, int]:
        """SCD-2 merge into a history table; returns the change counts.

        Only months that the incoming rows fall in are read, and only months in which a version closed or
        opened are written again. A merge that changes nothing writes no version.
        """
        keys, values, day = HISTORY_TABLES[name]
        ddl, version = schemas.CANONICAL_TABLES[name], self.version(name)
        month = F.coalesce(F.date_format(day, "yyyy-MM"), F.lit("none"))
        if version == 0:
            known = schemas.empty(self.spark, ddl + ", period string")
        else:
            months = [r.period for r in incoming.select(month.alias("period")).distinct().collect()]  # at most the calendar's
            known = self._read_history(name, ddl, version, months)
        passed = history.merge_pass(known, incoming, keys, values, revision_knowledge)
        pending = f"{self.root}/pending/{name}/version={version + 1}"
        history.changed_versions(passed).withColumn("period", month).write.mode("overwrite").parquet(pending)
        changes = self.spark.read.schema(schemas.struct(ddl + ", status string, period string")).parquet(pending)
        counts = changes.agg(*history.change_counts()).first().asDict()
        counts["unchanged"] = incoming.select(*keys).distinct().count() - counts["inserted"]
        if counts["inserted"]:
            touched = changes.select("period").distinct()
            kept = (
                known.filter("is_current").join(touched, "period", "left_semi")
                .join(changes.filter("status = 'closed'").select(*keys), keys, "left_anti")
            )
            columns = [*schemas.names(ddl), "period"]
            # a month in few files, a large one split
            rewritten = kept.select(*columns).unionByName(changes.select(*columns)).hint("rebalance", "period")
            rewritten.write.mode("overwrite").partitionBy("period", "is_current").parquet(f"{self.root}/tables/{name}/version={version + 1}")
            self._commit(name, version + 1, touched)
        return counts

    def vacuum(self, name: str) -> list[str]:
        """Folders of a history or part table that no newest version reads: superseded rewrites of months or parts.

        Told, not deleted: what may go depends on readers that still hold an older version.
        """
        version = self.version(name)
        log = self._optional(f"{self.root}/commits/{name}", "version int, period string").filter(
            F.col("version") <= version
        )
        newest = log.groupBy("period").agg(F.max("version").alias("newest"))
        old = log.join(newest, "period").filter("version < newest").orderBy("period", "version").collect()
        folder = "part={}" if name in PART_TABLES else "period={}/is_current=true"
        return [f"{self.root}/tables/{name}/version={r.version}/{folder.format(r.period)}" for r in old]


def publish(
    lake: Lake, tables: dict[str, DataFrame], trade_date: str, published_at: Column
) -> dict[str, int]:
    """Write every serving table sorted, run the contract gates on what was written, then commit.

    A violation raises before the commit, so readers keep the previous snapshot. Range partitioning on
    the full sort key lets a hot ticker span several files.
    """
    spark = lake.spark
    version = lake.version("snapshot") + 1
    base = f"{lake.root}/snapshots/version={version}"
    meta = spark.range(1).select(
        F.lit(trade_date).cast("date").alias("sealed_trade_date"),
        published_at.alias("published_at"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )
    for name, df in {**tables, "serving_meta": meta}.items():
        keys = SORT_ORDER.get(name)
        (df.orderBy(*keys) if keys else df).write.mode("overwrite").parquet(f"{base}/{name}")
    rows = {
        name: assert_contract(name, spark.read.parquet(f"{base}/{name}"))
        for name in tables if name in schemas.SERVING
    }
    lake._commit("snapshot", version)
    return rows


def read_snapshot(lake: Lake, name: str) -> DataFrame:
    """A serving table of the newest published snapshot."""
    version = lake.version("snapshot")
    if version == 0:
        raise LookupError("nothing has been published yet")
    return lake.spark.read.parquet(f"{lake.root}/snapshots/version={version}/{name}")


def register_views(lake: Lake, names: list[str], prefix: str = "vw_") -> list[str]:
    """Temp views over the newest snapshot, for SQL consumers."""
    views = []
    for name in names:
        read_snapshot(lake, name).createOrReplaceTempView(f"{prefix}{name}")
        views.append(f"{prefix}{name}")
    return views
