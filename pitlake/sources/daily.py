"""Daily bar payloads: CSV, JSON and column-named Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.functions.clocks import exchange_date
from pitlake.functions.numeric import any_of
from pitlake.sources.drift import Parsed, first_problem, once, split_payloads
from pitlake.sources.frames import parse_frames

PRICE_COLUMNS = ("Open", "High", "Low", "Close")
CSV_REQUIRED = ("Date", *PRICE_COLUMNS)
BAR = ["landing_key", "ticker", "bar_date", "open", "high", "low", "close", "volume"]


def first_line(text: Column) -> Column:
    return F.regexp_extract(text, r"^\s*([^\r\n]*)", 1)


def cell(parts: Column, index: Column) -> Column:
    """The 1-based cell of a split line, trimmed; null when blank, absent (index 0) or past the end."""
    value = F.get(parts, F.when(index > 0, (index - 1).cast("int")))
    return F.nullif(F.trim(value), F.lit(""))


def cells_of(line: Column) -> Column:
    """The cells of a CSV line; quoted cells may hold commas and doubled quotes."""
    outside = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
    quoted = F.transform(
        F.split(line, outside),
        lambda c: F.when(
            F.trim(c).rlike('^".*"$'), F.regexp_replace(F.regexp_extract(F.trim(c), '^"(.*)"$', 1), '""', '"')
        ).otherwise(c),
    )
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, ","))


def parse_csv_bars(payloads: DataFrame) -> Parsed:
    """`Date,Open,High,Low,Close[,Volume]` by header name -> bars.

    payloads: (landing_key, ticker, text). Rows without date or close are dropped; missing columns,
    unreadable values or no rows are drift.
    """
    names = (*CSV_REQUIRED, "Volume")
    head = F.transform(cells_of(first_line(F.col("text"))), F.trim)
    missing = F.array_join(F.array_except(F.array(*[F.lit(c) for c in CSV_REQUIRED]), head), ",")
    # what is known per payload is settled in a projection of its own
    headed = payloads.select(
        "landing_key", F.upper("ticker").alias("ticker"), missing.alias("missing"),
        *[F.array_position(head, c).alias(f"at_{c}") for c in names],
        F.split(F.ltrim("text"), r"\r?\n").alias("lines"),
    )

    def typed(cells: Column) -> Column:
        raw = {c: cell(cells, F.col(f"at_{c}")) for c in names}
        value = {c: raw[c].try_cast("date" if c == "Date" else "double") for c in names}
        return F.struct(
            any_of(*[raw[c].isNotNull() & value[c].isNull() for c in names]).alias("bad"),
            value["Date"].alias("bar_date"), *[value[c].alias(c.lower()) for c in (*PRICE_COLUMNS, "Volume")],
        )

    data = F.filter(F.slice("lines", F.lit(2), F.size("lines")), lambda line: F.trim(line) != "")
    rows = headed.select(
        "landing_key", "ticker", "missing",
        once(F.transform(data, lambda line: F.transform(F.array(cells_of(line)), typed)[0])).alias("rows"),
    )

    def kept(row: Column) -> Column:
        return row["bar_date"].isNotNull() & row["close"].isNotNull()

    problem = first_problem(
        (F.col("missing") != "", F.concat(F.lit("missing columns "), F.col("missing"))),
        (F.exists("rows", lambda r: r["bad"]), "CSV unparseable: bad value"),
        (~F.exists("rows", kept), "parsed to zero rows"),
    )
    return split_payloads(rows, problem, F.filter("rows", kept), BAR)


def parse_json_bars(payloads: DataFrame) -> Parsed:
    """`{"bars":[{t,o,h,l,c,v}]}` -> bars; the date is exchange-local.

    payloads: (landing_key, ticker, text). A missing `bars` key or a row with a missing or unreadable
    field is drift; null or empty `bars` is an empty payload.
    """
    fields = {"o": "open", "h": "high", "l": "low", "c": "close", "v": "volume"}
    body = F.from_json("text", "bars array<struct<t string, o string, h string, l string, c string, v string>>")
    keys = F.json_object_keys("text")
    opened = payloads.select(
        "landing_key", F.upper("ticker").alias("ticker"),
        keys.isNull().alias("not_json"),
        (~F.array_contains(keys, "bars")).alias("no_bars"),
        body["bars"].alias("bars"),
    )

    def typed(b: Column) -> Column:
        at = b["t"].try_cast("timestamp")
        values = {name: b[key].try_cast("double") for key, name in fields.items()}
        return F.struct(
            any_of(at.isNull(), *[v.isNull() for v in values.values()]).alias("bad"),
            exchange_date(at).alias("bar_date"), *[v.alias(n) for n, v in values.items()],
        )

    # a null among the bars is no bar
    listed = F.filter(F.coalesce("bars", F.array().cast(opened.schema["bars"].dataType)), lambda b: b.isNotNull())
    rows = opened.select(
        "landing_key", "ticker", "not_json", "no_bars", once(F.transform(listed, typed)).alias("rows")
    )
    problem = first_problem(
        (F.col("not_json"), "daily payload not JSON"),
        (F.col("no_bars"), "daily payload missing 'bars'"),
        (F.exists("rows", lambda r: r["bad"]), "malformed bar row"),
    )
    return split_payloads(rows, problem, F.col("rows"), BAR)


DAILY_FRAME = {
    "time": ("Date",),
    "required": PRICE_COLUMNS,
    "optional": ("Volume", "Adj Close"),
}


def parse_frame_bars(payloads: DataFrame) -> Parsed:
    """Parquet payloads with columns `Open` or `Open_<ticker>` -> bars plus adj_close.

    payloads: (landing_key, ticker, content). Needs `Date` and prices; volume and adjusted close may
    be absent. No rows is drift.
    """
    rows, rejects = parse_frames(payloads, "daily", empty_is_drift=True, **DAILY_FRAME)
    return Parsed(
        rows.select(
            "landing_key", "ticker", F.to_date("at").alias("bar_date"),
            *[F.col(c).alias(c.lower()) for c in (*PRICE_COLUMNS, "Volume")],
            F.col("Adj Close").alias("adj_close"),
        ),
        rejects,
    )
