"""Secret scan: three kinds of marked secrets, and tokens that pass a battery of randomness tests.

Base kinds are patterns: `assign` (a keyword, a separator and a value), `access` (key identifiers) and `hex`
(long hexadecimal runs). Beside them every run of 20 or more characters that may stand in an encoded secret
is a candidate. Its encoding is the smallest alphabet that holds it: hex, base32, base36, base62 or base64; text of one
letter case, or digits alone, has none, and is no candidate. For symbols x_1..x_n over an alphabet of m
the battery has, with exact means and variances under independent uniform symbols,

* chi-squared uniformity of the symbol counts, and of the alphabet's letters of one case against its other
  symbols (words joined in mixed case are mostly small letters),
* the runs of symbols from the lower and upper half of the alphabet (Wald and Wolfowitz),
* the circular serial correlation at lag 1.

The sum S of the squared deviations is chi-squared with four degrees, so p = exp(-S/2) (1 + S/2).

False-discovery control is by length, since ordinary tokens get past the tests where these have little power:

* within each encoding and length class (powers of two), Benjamini and Hochberg's procedure at RATE settles
  which tokens are not random; at most that share of those turned away are random;
* a token is looked at only if it is so long that text (two symbols agree with probability TEXT_AGREES) would
  stand POWER deviations from uniformity.

Candidates that remain and lie in no base span are spans of kind `random`.

Only DataFrame functions. Texts are read once; their spans and candidates (a few per document) are stored.
Ranks are not needed: deviations are cut to 1/16ths, so a class is a histogram of at most some thousand bins.
The thresholds that come to the driver are at most one per encoding and length class. No document is shuffled.

Null and empty texts have no spans. Repeated rows are judged alike. Very long texts are matched as a whole;
patterns need no backtracking beyond a keyword. Columns other than the named ones are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlake.llm.common import let
from pitlake.plans.scratch import staged

#: Fixed values of the base kinds: pattern, the group whose length counts, and the least length.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]{16,}", 0, 16),  # the longest runs, as [0-9a-f]+ would give them, shorter ones left out
)
RANDOM = "random"

LETTERS, CAPITALS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings from small to large: name, symbols in their order, and classes that a token of it keeps to and needs.
ENCODINGS = (
    ("hex", DIGITS + LETTERS[:6], "0-9a-f", ("0-9", "a-f")),
    ("hex_upper", DIGITS + CAPITALS[:6], "0-9A-F", ("0-9", "A-F")),
    ("base32", CAPITALS + "234567", "A-Z2-7", ("A-Z", "2-7")),
    ("base36", DIGITS + LETTERS, "0-9a-z", ("0-9", "a-z")),
    ("base36_upper", DIGITS + CAPITALS, "0-9A-Z", ("0-9", "A-Z")),
    ("base62", CAPITALS + LETTERS + DIGITS, "A-Za-z0-9", ("a-z", "A-Z")),
    ("base64", CAPITALS + LETTERS + DIGITS + "+/", "A-Za-z0-9+/", ("A-Za-z", "0-9+/")),
    ("base64_url", CAPITALS + LETTERS + DIGITS + "-_", "A-Za-z0-9_-", ("A-Za-z", "0-9")),
)
MIN_LENGTH = 20
CANDIDATE = f"[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}"
#: Share of random tokens among those turned away, at most.
RATE = 0.05
#: Chance that two symbols of ordinary text agree, and the deviations by which text has to stand out.
TEXT_AGREES = 0.065
POWER = 3
#: Deviations are counted in steps of one in STEPS, up to CAP.
STEPS = 16
CAP = 400.0


def least_length(symbols: int) -> int:
    """The length from which ordinary text would stand POWER deviations from uniform over so many symbols."""
    agrees = max(TEXT_AGREES, 1.75 / symbols)
    return max(MIN_LENGTH, 1 + int(POWER * (2 * (symbols - 1)) ** 0.5 / (symbols * agrees - 1)) + 1)


SPAN = "struct<start:int,end:int,token:string>"
#: Scans keep what they emit in blocks of so many items, so that appending does not copy all of it.
BLOCK = 256


def _nothing(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def scan(items: Column, state: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """What `step` emits (an array of `kind`) going over `items`, from the state it leaves after each."""
    def on(a: Column, item: Column) -> Column:
        left, emitted = step(a["state"], item)
        return F.struct(left.alias("state"), F.concat(a["out"], emitted).alias("out"))

    def over(a: Column, at: Column) -> Column:
        block = F.aggregate(F.slice(items, at + 1, BLOCK), F.struct(a["state"].alias("state"), _nothing(kind).alias("out")), on)
        return let(block, lambda r: F.struct(
            r["state"].alias("state"), F.concat(a["out"], F.array(r["out"])).alias("out")
        ))

    starts = F.sequence(F.lit(0), F.size(items) - 1, F.lit(BLOCK))
    out = F.aggregate(starts, F.struct(state.alias("state"), _nothing(f"array<{kind}>").alias("out")), over)["out"]
    return F.when(F.size(items) > 0, F.flatten(out)).otherwise(_nothing(kind))


def matches(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """(start, end, token) of the matches in order, in code points; `token` is the text of `group`.

    Matches are leftmost and do not overlap; those whose group is shorter than `least` are left out.
    """
    found = F.arrays_zip(
        F.slice(F.split(text, pattern), F.lit(1), F.regexp_count(text, F.lit(pattern))).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("token"),
    )

    def placed(at: Column, x: Column) -> tuple[Column, Column]:
        start, end = at + F.length(x["gap"]), at + F.length(x["gap"]) + F.length(x["whole"])
        span = F.struct(start.alias("start"), end.alias("end"), x["token"].alias("token"))
        return end, F.when(F.length(x["token"]) >= least, F.array(span)).otherwise(_nothing(SPAN))

    return F.when(text.rlike(pattern), let(found, lambda items: scan(items, F.lit(0), SPAN, placed))).otherwise(_nothing(SPAN))


def _squared(value: Column, mean: Column, variance: Column) -> Column:
    """Squared deviation; where nothing can vary, nothing is random."""
    return F.when(variance > 0, (value - mean) * (value - mean) / variance).otherwise(F.lit(CAP))


def _letters(symbols: str) -> tuple[int, int]:
    """First and last number of an alphabet's letters of one case (the small ones, if it has both)."""
    inside = [k for k, c in enumerate(symbols) if c.islower()] or [k for k, c in enumerate(symbols) if c.isupper()]
    return inside[0], inside[-1]


def _moments(x: Column, symbols: str) -> Column:
    """Integer sums that the tests need, of the symbol numbers `x`."""
    n = F.size(x).cast("long")
    zero = F.lit(0).cast("long")

    def added(array: Column) -> Column:
        return F.aggregate(array, zero, lambda a, v: a + v)

    def turned(by: int) -> Column:
        return F.concat(F.slice(x, F.lit(1 + by), n.cast("int")), F.slice(x, 1, by))

    def products(by: int) -> Column:
        return added(F.zip_with(x, turned(by), lambda a, b: a * b))

    half = len(symbols) // 2
    ordered = F.sort_array(x)
    # sum of squared counts: of sorted symbols, each adds 2 k - 1 as the k-th of its kind
    squares = F.aggregate(
        ordered, F.struct(F.lit(-1).cast("long").alias("last"), zero.alias("k"), zero.alias("sum")),
        lambda a, v: let(F.when(a["last"] == v, a["k"] + 1).otherwise(F.lit(1).cast("long")), lambda k: F.struct(
            v.alias("last"), k.alias("k"), (a["sum"] + 2 * k - 1).alias("sum")
        )),
    )["sum"]
    return F.struct(
        n.cast("double").alias("n"), squares.cast("double").alias("squares"),
        added(F.transform(x, lambda v: (v >= half).cast("long"))).cast("double").alias("upper"),
        added(F.zip_with(
            F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1),
            lambda a, b: ((a >= half) != (b >= half)).cast("long"),
        )).cast("double").alias("turns"),
        added(F.transform(x, lambda v: v.between(*_letters(symbols)).cast("long"))).cast("double").alias("letters"),
        added(x).cast("double").alias("sum"), products(0).cast("double").alias("p0"), products(1).cast("double").alias("p1"),
    )


def _statistic(s: Column, symbols: str) -> Column:
    """The battery's sum of squared deviations from the moments `s` of a token."""
    n, m = s["n"], float(len(symbols))
    first, last = _letters(symbols)
    share = (last - first + 1) / m
    cased = _squared(s["letters"], n * share, n * (share * (1 - share)))
    uniform = _squared(m / n * s["squares"] - n, F.lit(m - 1), 2 * (m - 1) * (n - 1) / n)
    pairs = 2 * s["upper"] * (n - s["upper"])
    runs = _squared(s["turns"] + 1, pairs / n + 1, pairs * (pairs - n) / (n * n * (n - 1)))
    spread = n * s["p0"] - s["sum"] * s["sum"]

    value = F.when(spread > 0, (n * s["p1"] - s["sum"] * s["sum"]) / spread).otherwise(1.0)
    serial = _squared(value, -1 / (n - 1), n * n / ((n - 1) * (n - 1) * (n - 2)))
    return F.least(F.lit(CAP), uniform + cased + runs + serial)


def _bin(token: Column, symbols: str) -> Column:
    """The battery's sum for a token over an alphabet, in STEPS-ths."""
    numbers = F.transform(F.split(token, ""), lambda c: F.position(c, F.lit(symbols)).cast("long") - 1)
    moments = let(numbers, lambda x: _moments(x, symbols))
    return let(moments, lambda s: F.floor(STEPS * _statistic(s, symbols)).cast("int"))


def judged_token(token: Column) -> Column:
    """(encoding, bin) of a token; null where it has no encoding or is too short for it."""
    out = F.lit(None).cast("struct<encoding:string,bin:int>")
    for name, symbols, inside, needed in reversed(ENCODINGS):
        fits = reduce(lambda a, b: a & b, (token.rlike(f"[{x}]") for x in needed), token.rlike(f"^[{inside}]+$"))
        judged = F.struct(F.lit(name).alias("encoding"), _bin(token, symbols).alias("bin"))
        out = F.when(fits, F.when(F.length(token) >= least_length(len(symbols)), judged)).otherwise(out)
    return out


def found(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, candidates) per document: spans of the base kinds in order, and tokens with an encoding.

    base: (start, rank, end), where `rank` counts the kinds. candidates: (start, end, stratum, bin).
    """
    body = F.coalesce(F.col(text), F.lit(""))

    def ranked(rank: int) -> Callable[[Column], Column]:
        return lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"))

    base = F.flatten(F.array(*(
        F.transform(matches(body, pattern, group, least), ranked(k)) for k, (_, pattern, group, least) in enumerate(BASE)
    )))
    tokens = F.transform(matches(body, CANDIDATE), lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), judged_token(x["token"]).alias("as")
    ))
    return docs.select(
        F.col(key).alias("doc_id"), F.array_sort(base).alias("base"),
        F.transform(F.filter(tokens, lambda x: x["as"].isNotNull()), lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"),
            F.concat(x["as"]["encoding"], F.lit(":"), F.length(F.bin(x["end"] - x["start"]))).alias("stratum"),
            x["as"]["bin"].alias("bin"),
        )).alias("candidates"),
    )


def not_random_from(spans: DataFrame, rate: float = RATE) -> DataFrame:
    """(stratum, bin): the least deviation from which tokens of a stratum are turned away.

    Benjamini and Hochberg's step-up over the histogram of deviations; strata that turn away none are left out.
    """
    each = spans.select(F.explode("candidates").alias("c")).groupBy("c.stratum", "c.bin").agg(F.count(F.lit(1)).alias("n"))
    within = Window.partitionBy("stratum")
    ranked = each.select(
        "stratum", "bin",
        F.sum("n").over(within.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)).alias("up_to"),
        F.sum("n").over(within).alias("all"),
    )
    half = F.col("bin") / (2.0 * STEPS)
    away = F.exp(-half) * (1 + half) <= rate * F.col("up_to") / F.col("all")
    return ranked.filter(away).groupBy("stratum").agg(F.min("bin").alias("bin"))


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: float = RATE) -> DataFrame:
    """(doc_id, spans) per document; a span is (start, rank, end), rank 3 for those of the battery."""
    spans = staged(found(docs, key, text), "secret-spans")
    limits = {r["stratum"]: r["bin"] for r in not_random_from(spans, rate).collect()}  # one per encoding and length class
    known = [F.lit(x) for pair in limits.items() for x in pair]
    limit = F.create_map(*known) if known else F.lit(None).cast("map<string,int>")
    random = F.filter("candidates", lambda c: c["bin"] < F.coalesce(limit[c["stratum"]], F.lit(int(CAP * STEPS) + 1)))
    everything = F.array_sort(F.concat("base", F.transform(random, lambda c: F.struct(
        c["start"].alias("start"), F.lit(len(BASE)).alias("rank"), c["end"].alias("end")
    ))))

    def uncovered(reach: Column, x: Column) -> tuple[Column, Column]:
        """Tokens that end within a base span seen before are left out."""
        base = x["rank"] < len(BASE)
        new = F.when(base | (x["end"] > reach), F.array(x)).otherwise(_nothing("struct<start:int,rank:int,end:int>"))
        return F.when(base, F.greatest(reach, x["end"])).otherwise(reach), new

    return spans.select("doc_id", F.when(F.size("candidates") == 0, F.col("base")).otherwise(let(
        everything, lambda items: scan(items, F.lit(0), "struct<start:int,rank:int,end:int>", uncovered)
    )).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    kinds = F.array(*(F.lit(k) for k in (*(b[0] for b in BASE), RANDOM)))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["rank"]), x["start"], x["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Per document: how many spans of each base kind, a digest of these, and all spans."""
    def of(rank: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["rank"] == rank)).cast("long").alias(f"n_{BASE[rank][0]}")

    return secrets(docs).select(
        "doc_id", *(of(k) for k in range(len(BASE))),
        F.sha2(written(F.filter("spans", lambda x: x["rank"] < len(BASE))), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def _oracle() -> str:
    """The same with one row per match, and lists in place of scans."""
    keyword = "|".join(
        "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
        for w in ("password", "passwd", "secret", "token", "api_?key")
    )
    kinds = [*((k, re.sub(r"\(\?i:\(.*?\)\)", lambda _: f"({keyword})", p), g, n) for k, p, g, n in BASE), (RANDOM, CANDIDATE, 0, MIN_LENGTH)]
    quoted = [(r, p.replace("'", "''"), g, n) for r, (_, p, g, n) in enumerate(kinds)]
    found = " UNION ALL ".join(
        f"""SELECT uid, {r} AS rank, {n} AS least, string_split_regex(text, '{p}') AS gaps,
            regexp_extract_all(text, '{p}', 0) AS wholes, regexp_extract_all(text, '{p}', {g}) AS tokens FROM t"""
        for r, p, g, n in quoted
    )
    encodings = " ".join(
        f"WHEN regexp_full_match(token, '[{inside}]+') AND "
        + " AND ".join(f"regexp_matches(token, '[{x}]')" for x in needed)
        + f" THEN {{'encoding': '{name}', 'symbols': '{symbols}', 'least': {least_length(len(symbols))}, 'first': {_letters(symbols)[0]}, 'last': {_letters(symbols)[1]}}}"
        for name, symbols, inside, needed in ENCODINGS
    )
    names = " ".join(f"WHEN {r} THEN '{k}'" for r, (k, *_) in enumerate(kinds))
    moved = "list_sum(list_transform(range(1, len(xs) + 1), lambda j: xs[j] * xs[(j + {0} - 1) % len(xs) + 1]))::DOUBLE"
    return f"""
    WITH t AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text FROM documents),
    found AS ({found}),
    each AS (
        SELECT uid, rank, least, i, gaps[i] AS gap, wholes[i] AS whole, tokens[i] AS token
        FROM (SELECT *, unnest(range(1, len(wholes) + 1)) AS i FROM found)),
    placed AS (
        SELECT uid, rank, least, token, length(whole) AS n,
            sum(length(gap) + length(whole)) OVER (PARTITION BY uid, rank ORDER BY i) AS at_end FROM each),
    spans AS (
        SELECT uid, rank, token, (at_end - n)::BIGINT AS at_start, at_end::BIGINT AS at_end
        FROM placed WHERE length(token) >= least),
    coded AS (SELECT *, CASE {encodings} END AS e FROM spans WHERE rank = {len(BASE)}),
    numbers AS (
        SELECT uid, at_start, at_end, length(token)::DOUBLE AS n, length(e.symbols)::DOUBLE AS m,
            e.first AS first, e.last AS last, (e.last - e.first + 1) / length(e.symbols)::DOUBLE AS share,
            e.encoding || ':' || length(bin(length(token))) AS stratum,
            list_transform(range(1, length(token) + 1), lambda j: strpos(e.symbols, token[j]) - 1) AS xs
        FROM coded WHERE e IS NOT NULL AND length(token) >= e.least),
    sums AS (
        SELECT *, list_sum(list_transform(list_distinct(xs), lambda v: len(list_filter(xs, lambda y: y = v)) ** 2))::DOUBLE AS squares,
            len(list_filter(xs, lambda y: y >= m // 2))::DOUBLE AS upper, list_sum(xs)::DOUBLE AS total,
            len(list_filter(range(1, len(xs)), lambda j: (xs[j] >= m // 2) <> (xs[j + 1] >= m // 2)))::DOUBLE AS turns,
            len(list_filter(xs, lambda y: y BETWEEN first AND last))::DOUBLE AS letters,
            {moved.format(0)} AS p0, {moved.format(1)} AS p1
        FROM numbers),
    terms AS (
        SELECT *, 2 * upper * (n - upper) AS pairs, n * p0 - total * total AS spread, -1 / (n - 1) AS mean,
            n * n / ((n - 1) * (n - 1) * (n - 2)) AS variance, pairs * (pairs - n) / (n * n * (n - 1)) AS runs_variance,
            (m / n) * squares - n - (m - 1) AS far FROM sums),
    tested AS (
        SELECT *, far * far / (2 * (m - 1) * (n - 1) / n)
            + (letters - n * share) * (letters - n * share) / (n * (share * (1 - share)))
            + CASE WHEN runs_variance > 0
                THEN (turns + 1 - (pairs / n + 1)) * (turns + 1 - (pairs / n + 1)) / runs_variance ELSE {CAP} END
            + (CASE WHEN spread > 0 THEN (n * p1 - total * total) / spread ELSE 1 END - mean)
                * (CASE WHEN spread > 0 THEN (n * p1 - total * total) / spread ELSE 1 END - mean) / variance AS s
        FROM terms),
    binned AS (SELECT uid, at_start, at_end, stratum, floor({STEPS} * least({CAP}, s))::INT AS bin FROM tested),
    ranked AS (
        SELECT stratum, bin, sum(count(*)) OVER (PARTITION BY stratum ORDER BY bin DESC) AS up_to,
            sum(count(*)) OVER (PARTITION BY stratum) AS total FROM binned GROUP BY stratum, bin),
    limits AS (
        SELECT stratum, min(bin) AS bin FROM ranked
        WHERE exp(-(bin / {2.0 * STEPS})) * (1 + bin / {2.0 * STEPS}) <= {RATE} * up_to / total GROUP BY stratum),
    base AS (SELECT uid, rank, at_start, at_end FROM spans WHERE rank < {len(BASE)}),
    kept AS (
        SELECT * FROM base UNION ALL
        SELECT b.uid, {len(BASE)}, b.at_start, b.at_end FROM binned b LEFT JOIN limits USING (stratum)
        WHERE b.bin < coalesce(limits.bin, {int(CAP * STEPS) + 1}) AND NOT EXISTS (
            SELECT 1 FROM base WHERE base.uid = b.uid AND base.at_start <= b.at_start AND base.at_end >= b.at_end)),
    joined AS (
        SELECT uid, (CASE rank {names} END) || ':' || at_start || ':' || at_end AS word, rank, at_start, at_end FROM kept),
    g AS (
        SELECT uid, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
            count(*) FILTER (rank = 2) AS n_hex, string_agg(word, ',' ORDER BY at_start, rank, at_end) AS spans,
            string_agg(word, ',' ORDER BY at_start, rank, at_end) FILTER (rank < {len(BASE)}) AS based FROM joined GROUP BY uid)
    SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
        coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(based, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM t LEFT JOIN g USING (uid)"""


ORACLE = _oracle()
