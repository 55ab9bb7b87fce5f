"""Exact deduplication with streaming state.

Texts are equal when identical after every run of white space became one space. Each row arrives in a
stream as (digest, stable identifier, content locator). Keyed state on disk (RocksDB, no watermark, so
nothing ever expires) holds per digest the first of its identifiers with that row's locator, and how
many rows came. A later row with a known digest is a hit: its full text is compared with the text that
the locator names, and digests that turn out to hold different texts are grouped again by the text
itself. Updates of a micro-batch are written under its number, so a batch that is run again after a
failure replaces its own output.

Only DataFrame operations: the state is a streaming aggregation.

Null texts count as empty. Rows are ordered by identifier, nulls last, then by locator, so of repeated
rows exactly one stays. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm.common import GAPS
from pitlake.plans.scratch import scratch, staged

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # many partitions with a little state each: no space is set aside ahead
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
}
LOCATOR = ("file", "row")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), GAPS, " ")


def sha(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(docs: DataFrame) -> DataFrame:
    """`docs` with the file and the row in it that hold each row's content.

    Rows that do not come straight from files are stored in the shared folder first.
    """
    try:
        at = docs.metadataColumn("_metadata")
        return docs.withColumns({"file": at["file_path"], "row": at["row_index"]})
    except AnalysisException:
        docs = staged(docs, "content")
        at = docs.metadataColumn("_metadata")
        return docs.withColumns({"file": at["file_path"], "row": at["row_index"]})


def order_of(key: Column) -> Column:
    return F.struct(key.isNull().alias("unnamed"), key.alias("id"), F.col("file"), F.col("row"))


def keep_state(arrivals: DataFrame, files_per_batch: int) -> DataFrame:
    """Per digest the first arrival and the number of arrivals, from a stream over a stored table."""
    spark: SparkSession = arrivals.sparkSession
    source, home = scratch(spark, "arrivals"), scratch(spark, "dedup-state")
    arrivals.write.parquet(source)
    held = {key: spark.conf.get(key, None) for key in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        grouped = (
            spark.readStream.schema(arrivals.schema)
            .option("maxFilesPerTrigger", files_per_batch)
            .parquet(source)
            .groupBy("digest")
            .agg(F.min("arrival").alias("first"), F.count("*").alias("members"))
        )
        stream = (
            grouped.writeStream.outputMode("update")
            .option("checkpointLocation", f"{home}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{home}/updates/batch={n}"))
            .start()
        )
        stream.awaitTermination()
    finally:
        for key, value in held.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    updates = spark.read.schema(grouped.schema).parquet(f"{home}/updates")
    # stored, so that a join with it is free to split a digest that many rows have
    return staged(
        updates.groupBy("digest").agg(F.min("first").alias("first"), F.max("members").alias("members")), "state"
    )


def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha,
    files_per_batch: int = 32,
) -> DataFrame:
    """One row per document: `id`, its locator, `first` (the arrival that stays), `members`, `digest`.

    `digest` maps a normalised text to what the state is keyed by.
    """
    rows = located(docs.select(F.col(key).alias("id"), F.col(text).alias("text")))
    seen = staged(
        rows.select(
            digest(normalised(F.col("text"))).alias("digest"), order_of(F.col("id")).alias("arrival"),
        ),
        "digests",
    )
    state = keep_state(seen, files_per_batch)
    grouped = staged(
        seen.join(state, "digest").select(
            F.col("arrival.id").alias("id"), F.col("arrival.file").alias("file"), F.col("arrival.row").alias("row"),
            "digest", "first", "members",
        ),
        "groups",
    )
    hits = grouped.filter("members > 1").select(*LOCATOR, "digest", "first")
    content = staged(
        rows.select(*LOCATOR, "text").join(hits, list(LOCATOR)), "hits"
    )
    of_first = [F.col("first.file") == F.col("kept_file"), F.col("first.row") == F.col("kept_row")]
    stays = (F.col("first.file") == F.col("file")) & (F.col("first.row") == F.col("row"))
    kept = content.filter(stays).select(
        F.col("file").alias("kept_file"), F.col("row").alias("kept_row"), F.col("text").alias("kept_text")
    )
    unequal = (
        content.filter(~stays)
        .join(kept, of_first)
        .filter(normalised(F.col("text")) != normalised(F.col("kept_text")))
        .select("digest")
    )
    mixed = staged(unequal.distinct(), "collisions")
    if mixed.isEmpty():
        return grouped
    # digests shared by different texts: those rows are grouped by the text itself
    again = content.join(mixed, "digest", "left_semi").select(
        *LOCATOR, "digest", normalised(F.col("text")).alias("whole")
    ).join(grouped.select(*LOCATOR, "id"), list(LOCATOR))
    own = again.groupBy("digest", "whole").agg(
        F.min(order_of(F.col("id"))).alias("own_first"), F.count("*").alias("own_members")
    )
    fixed = again.join(own, ["digest", "whole"]).select(*LOCATOR, "own_first", "own_members")
    return grouped.join(fixed, list(LOCATOR), "left").select(
        "id", *LOCATOR, "digest",
        F.coalesce("own_first", "first").alias("first"), F.coalesce("own_members", "members").alias("members"),
    )


def is_kept() -> Column:
    return (F.col("first.file") == F.col("file")) & (F.col("first.row") == F.col("row"))


def report(docs: DataFrame) -> DataFrame:
    """Per document: the row that stays, the size of its group, whether it stays, the text's digest."""
    return exact_groups(docs).select(
        F.col("id").alias("doc_id"),
        F.col("first.id").alias("keep_id"),
        F.col("members").cast("long").alias("group_size"),
        is_kept().alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the first row of every group of equal texts; columns as they were."""
    columns = docs.columns
    docs = docs.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)))
    rows = located(docs)
    groups = exact_groups(rows.drop(*LOCATOR), f"c{columns.index(key)}", f"c{columns.index(text)}")
    dropped = groups.filter(~is_kept()).select(*LOCATOR)
    kept = rows.join(dropped, list(LOCATOR), "left_anti")
    return kept.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(columns)))
