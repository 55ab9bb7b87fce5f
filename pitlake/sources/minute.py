"""Minute bar payloads (Parquet) and quote tick payloads (gzip JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.operators.quotes import two_sided
from pitlake.sources.drift import SCHEMA_DRIFT, Parsed
from pitlake.sources.frames import parse_frames

MINUTE_FRAME = {
    "time": ("Datetime", "Date", "index"),
    "required": ("Open", "High", "Low", "Close"),
    "optional": ("Volume",),
}


def parse_frame_minutes(payloads: DataFrame) -> Parsed:
    """Parquet minute payloads -> (landing_key, ticker, minute_ts, OHLCV), minutes in UTC."""
    rows, rejects = parse_frames(payloads, "minute", empty_is_drift=False, **MINUTE_FRAME)
    return Parsed(
        rows.select(
            "landing_key", "ticker", F.col("at").alias("minute_ts"),
            *[F.col(c).alias(c.lower()) for c in ("Open", "High", "Low", "Close", "Volume")],
        ),
        rejects,
    )


# A payload cut at `{`: nothing, the opening of the envelope, then one fragment per record. Each fragment
# carries its own closing braces, so a payload that breaks off anywhere shows it. A brace inside a string or
# a nested object fits none of these shapes and makes the payload unreadable.
OPENS = r'^[^{}]*"quotes"\s*:\s*\[\s*$'
EMPTY = r'^[^{}]*"quotes"\s*:\s*\[\s*\][^{}]*\}\s*$'
NO_LIST = r'^[^{}]*"quotes"\s*:\s*null[^{}]*\}\s*$'
INNER = r"^[^{}]*\}\s*,\s*$"
LAST = r"^[^{}]*\}\s*\][^{}]*\}\s*$"


def fragments_of(payloads: DataFrame) -> DataFrame:
    """Payload texts cut into record fragments, for payloads already in memory."""
    return payloads.select(
        "landing_key", "ticker", F.posexplode(F.split("text", r"\{")).alias("pos", "fragment")
    )


def _cut(fragments: DataFrame) -> DataFrame:
    """Each fragment's kind, and for records the typed values and whether they are malformed.

    A missing price counts as zero. The JSON is read by a generator, which the optimizer never repeats.
    """
    f = F.col("fragment")
    keep = [c for c in fragments.columns if c != "fragment"]
    kind = (
        F.when(f.rlike(INNER), "inner").when(f.rlike(OPENS), "opens").when(f.rlike(EMPTY), "empty")
        .when(f.rlike(NO_LIST), "no_list").when(f.rlike(LAST), "last").when(F.trim(f) == "", "blank").otherwise("other")
    )
    read = fragments.select(*keep, f.contains('"quotes"').alias("named"), kind.alias("kind"), f.alias("fragment")).select(
        *keep, "named", "kind", F.col("kind").isin("inner", "last").alias("is_record"),
        F.when(
            F.col("kind").isin("inner", "last"), F.concat(F.lit("{"), F.substring_index(f, "}", 1), F.lit("}"))
        ).alias("text"),
    ).select(*keep, "named", "kind", "is_record", F.json_tuple("text", "t", "bp", "ap").alias("t", "bp", "ap"))

    def price(name: str):
        return F.coalesce(F.col(name).try_cast("double"), F.when(F.col(name).isNull(), 0.0))

    typed = read.withColumns(
        {"ts": F.col("t").try_cast("timestamp"), "bid": price("bp"), "ask": price("ap")}
    )
    unreadable = F.col("ts").isNull() | F.col("bid").isNull() | F.col("ask").isNull()
    return typed.withColumn("bad", F.col("is_record") & unreadable)


def quote_rejects(fragments: DataFrame) -> DataFrame:
    """Payloads without a `quotes` list, with a record lacking a readable time or price, or not whole.

    Whole means: the envelope opens first, every fragment after it is one record, and only the last
    fragment closes list and envelope. All of it is counted per payload beside the records.
    """
    def at(kind: str, pick=F.min):
        return pick(F.when(F.col("kind") == kind, F.col("pos")))

    counts = _cut(fragments).groupBy("landing_key").agg(
        F.bool_or("named").alias("named"), F.bool_or("bad").alias("bad"),
        F.count_if(F.col("kind") == "no_list").alias("n_no_list"),
        F.count_if(F.col("kind") == "blank").alias("n_blank"), F.count_if(F.col("kind") == "other").alias("n_other"),
        F.count_if(F.col("kind").isin("opens", "empty")).alias("n_heads"),
        F.count_if("is_record").alias("n_records"), F.count_if(F.col("kind") == "last").alias("n_last"),
        F.count_if(F.col("kind") == "empty").alias("n_empty"),
        F.min("pos").alias("first"), F.max("pos").alias("end"), at("blank").alias("blank_at"),
        F.coalesce(at("opens"), at("empty")).alias("head_at"), at("last", F.max).alias("last_at"),
        F.min(F.when(F.col("is_record"), F.col("pos"))).alias("record_at"),
    )
    begins = (F.col("n_blank") == 1) & (F.col("blank_at") == F.col("first")) & (F.col("n_heads") == 1)
    closes = F.when(F.col("n_empty") == 1, F.col("n_records") == 0).otherwise(
        (F.col("n_last") == 1) & (F.col("last_at") == F.col("end")) & (F.col("head_at") < F.col("record_at"))
    )
    whole = F.coalesce(begins & closes & (F.col("n_other") == 0), F.lit(False))
    listed = F.col("named") & (F.col("n_no_list") == 0)
    detail = (
        F.when(~listed, "quote payload missing 'quotes'").when(F.col("bad"), "malformed quote")
        .when(~whole, "quote payload unreadable: not one whole list of records")
    )
    return counts.select(
        "landing_key", F.lit(SCHEMA_DRIFT).alias("error_class"), detail.alias("detail")
    ).filter("detail IS NOT NULL")


def quote_rows(fragments: DataFrame, rejects: DataFrame) -> DataFrame:
    """(landing_key, ticker, ts, pos, bid, ask) of accepted payloads; one-sided quotes are dropped."""
    return (
        two_sided(_cut(fragments))
        .filter("is_record")
        .select("landing_key", "ticker", "ts", "pos", "bid", "ask")
        .join(rejects.select("landing_key"), "landing_key", "left_anti")
    )


def parse_quote_fragments(fragments: DataFrame) -> Parsed:
    """`{"quotes":[{t,bp,ap}, ...]}` cut at `{` into quotes and rejected payloads.

    Payload verdicts are one small aggregate beside the records, which are never gathered per payload.
    """
    rejects = quote_rejects(fragments)
    return Parsed(quote_rows(fragments, rejects), rejects)
