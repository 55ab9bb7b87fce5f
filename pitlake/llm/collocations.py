"""Phrase collocations per language, by marginalising counts of the longest windows.

Texts are cut into pieces and words. At every word stands one window: the word and the three that follow it in
its piece, padded at the end (the lead columns are the words shifted by one to three places; no sort and no
shuffle is needed for them). Only these windows are counted. The count
of a phrase is the sum over the windows that begin with it, so a ROLLUP over the window columns gives the
counts of all shorter phrases: no phrase length is exploded by itself. Single words are counted while the
dictionary is made.

What keeps it small:

* Words travel as 64-bit hashes of language and word. The dictionary (language, word, hash, count) tells them
  apart again; words whose hashes clash are found there and hashed anew.
* A phrase that occurs often has no rare part, so a window is padded from the first pair of neighbours that is
  rare, and one that begins with such a pair is left out. Which pairs are frequent is counted first, on one
  hash per pair. They go to the tasks as a filter of fixed size (FILTER_BITS); the fuller it is, the more
  rare pairs it lets through, and never does it stop a frequent one.
* Windows are counted chunk by chunk before they are shuffled (numpy and Arrow over the hashes of a chunk of
  bounded size).
* Windows are dealt out by their first two words, so exact counts of
  all prefixes are at hand before the ROLLUP; behind the last prefix that is frequent a window is padded again.
* A first pair that many windows share would meet in one task. Prefixes above a share of the windows are
  looked for in a sample; windows of such a pair are dealt out by three words, of such a triple by four (equal
  windows are one row a chunk by then). These prefixes are frequent, so no local count is needed to keep
  them. The sample decides where rows go, never which.

Scores are exact: products are decimals of 38 digits.

Null texts are empty. A null language is `und`, together with documents so marked. Repeated rows count as
often as they occur. A very long text is one row until it is cut into words. Ties are settled by phrase, so
the result is unique. Columns other than the two named ones are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlake.llm.common import reach_workers
from pitlake.plans.scratch import staged

#: What ends a piece, and what separates words in it.
ENDS = r"[.,;:!?\x0A-\x0D]"
BLANKS = r"[\x20\x09]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONGEST = 4
MIN_COUNT = 30
#: A phrase goes if a longer one has at least this percentage of its occurrences.
ABSORBED_PERCENT = 80
SCALE = 2_000_000
TOP = 2000
#: Prefixes above one in HOT_SHARE of the windows of about HOT_DOCS documents are dealt out further.
HOT_SHARE = 5000
HOT_DOCS = 20_000
#: Words whose windows are counted together in a task.
CHUNK = 1_000_000
#: Bits of the filter of frequent pairs: 16 MB in the driver and in every task.
FILTER_BITS = 1 << 27
#: Clashing hashes are some n * n / 2**65 of n words; far more would mean that something else is wrong.
MAX_CLASHES = 10_000

COLUMNS = [f"w{k}" for k in range(1, LONGEST + 1)]
COUNTED = ", ".join(f"{c} long" for c in (*COLUMNS, "n"))
#: Stands for what is padded; no word has it.
PAD = 0


def prepared(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, text) with languages filled in and texts lower-cased in A-Z."""
    return docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
        F.translate(F.coalesce(F.col(text), F.lit("")), CAPITALS, SMALL).alias("text"),
    )


def _words(text: Column, gaps: str) -> Column:
    return F.filter(F.split(text, gaps), lambda w: w != "")


def code(lang: Column, word: Column, clashing: list[tuple[str, str]] = ()) -> Column:
    """The number a word goes by."""
    plain = F.xxhash64(lang, word)
    out = F.when(plain == PAD, F.lit(1).cast("long")).otherwise(plain)
    if clashing:
        again = reduce(lambda a, b: a | b, ((lang == x) & (word == w) for x, w in clashing))
        out = F.when(again, F.xxhash64(F.lit("again"), lang, word)).otherwise(out)
    return out


def dictionary(rows: DataFrame) -> tuple[DataFrame, list[tuple[str, str]]]:
    """(lang, word, code, f) of all words, stored, and the words whose hash another word has."""
    counts = rows.select("lang", F.explode(_words(F.col("text"), r"[.,;:!?\x0A-\x0D\x20\x09]+")).alias("word"))
    known = staged(counts.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("f")), "words")
    coded = known.withColumn("code", code(F.col("lang"), F.col("word")))
    twice = coded.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("lang", "word")).alias("first"))
    clashes = coded.join(twice.filter("n > 1"), "code").filter(F.struct("lang", "word") != F.col("first"))
    clashing = [(r["lang"], r["word"]) for r in clashes.select("lang", "word").limit(MAX_CLASHES + 1).collect()]
    if len(clashing) > MAX_CLASHES:
        raise ValueError(f"over {MAX_CLASHES} words share a hash")
    return known.withColumn("code", code(F.col("lang"), F.col("word"), clashing)), clashing


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(31))


def _lead(codes: np.ndarray) -> list[np.ndarray]:
    """The lead columns of `codes`, where PAD stands between pieces: windows of two words and more."""
    padded = np.concatenate([codes, np.full(LONGEST - 1, PAD, np.int64)])
    lead = [padded[k : k + len(codes)] for k in range(LONGEST)]
    begins = (lead[0] != PAD) & (lead[1] != PAD)
    return [w[begins] for w in lead]


def counted_pairs(codes: np.ndarray) -> pa.Table:
    """(h, n) of the pairs of neighbours in `codes`."""
    first, second, *_ = _lead(codes)
    h, n = np.unique(pair_hashes(first, second), return_counts=True)
    return pa.table({"h": h.view(np.int64), "n": n})


def counted_windows(codes: np.ndarray, frequent: np.ndarray | None = None) -> pa.Table:
    """(w1..w4, n) of the windows in `codes`, padded where a pair of neighbours is not in the filter `frequent`."""
    lead = _lead(codes)

    def often(k: int) -> np.ndarray:
        if frequent is None:
            return np.ones(len(lead[0]), bool)
        at = pair_hashes(lead[k], lead[k + 1]) & np.uint64(64 * len(frequent) - 1)
        return (frequent[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    begins = often(0)
    lead = [w[begins] for w in lead]
    for k in range(2, LONGEST):
        lead[k] = np.where((lead[k - 1] == PAD) | ~often(k - 1), PAD, lead[k])
    counts = pa.table(dict(zip(COLUMNS, lead))).group_by(COLUMNS).aggregate([([], "count_all")])
    return counts.rename_columns([*COLUMNS, "n"])


def _by_chunk(rows: DataFrame, clashing: list[tuple[str, str]], count: Callable[[np.ndarray], pa.Table], ddl: str) -> DataFrame:
    """`count` of the codes of words, PAD between pieces, for chunks of about CHUNK of them."""
    pieces = F.transform(F.split("text", ENDS), lambda p: F.concat(
        F.transform(_words(p, BLANKS), lambda w: code(F.col("lang"), w, clashing)), F.array(F.lit(PAD).cast("long"))
    ))
    chunk = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):  # a batch of long texts is more than a chunk
                codes = batch.column(0).slice(start, 64).flatten().to_numpy(zero_copy_only=False)
                held.append(codes)
                size += len(codes)
                if size >= chunk:
                    yield from count(np.concatenate(held)).to_batches(max_chunksize=65_536)
                    held, size = [], 0
        if held:
            yield from count(np.concatenate(held)).to_batches(max_chunksize=65_536)

    return rows.select(F.flatten(pieces).alias("codes")).mapInArrow(run, ddl)


def frequent_pairs(rows: DataFrame, clashing: list[tuple[str, str]] = (), min_count: int = MIN_COUNT) -> np.ndarray:
    """The filter of pairs that occur `min_count` times, as words of 64 bits."""
    counts = _by_chunk(rows, clashing, counted_pairs, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    at = F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1))
    bits = counts.filter(F.col("n") >= min_count).groupBy(F.shiftright(at, 6).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    )
    held = staged(bits, "frequent-pairs").toArrow()  # at most FILTER_BITS / 64 rows
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[held["word"].to_numpy()] = held["bits"].to_numpy().view(np.uint64)
    return out


def windows(rows: DataFrame, clashing: list[tuple[str, str]] = (), frequent: Broadcast | None = None) -> DataFrame:
    """(w1..w4, n): the codes of words and of those after them in their piece, and how often a chunk has them."""
    return _by_chunk(rows, clashing, lambda codes: counted_windows(codes, frequent and frequent.value), COUNTED)


def hot_prefixes(
    rows: DataFrame, clashing: list[tuple[str, str]] = (), frequent: Broadcast | None = None
) -> list[list[int]]:
    """For two and three words: hashes of the prefixes that many windows of a sample share."""
    n = rows.count()
    some = rows.sample(min(1.0, HOT_DOCS / n), seed=1) if n else rows
    counted = windows(some, clashing, frequent).rollup(F.struct("w1", "w2").alias("pair"), "w3").agg(
        F.sum("n").alias("n"), F.grouping_id().alias("level")
    )
    counted = staged(counted.filter(F.col("n") >= MIN_COUNT), "hot-prefixes")
    total = counted.filter("level = 3").agg(F.max("n")).first()[0] or 0
    often = counted.filter((F.col("level") < 3) & (F.col("n") * HOT_SHARE > total))
    h = F.when(F.col("level") == 1, F.xxhash64("pair.w1", "pair.w2")).otherwise(F.xxhash64("pair.w1", "pair.w2", "w3"))
    out: list[list[int]] = [[], []]
    for r in often.select("level", h.alias("h")).collect():
        out[1 - r["level"]].append(r["h"])  # fewer than HOT_SHARE of each
    return out


def phrases(rows: DataFrame, clashing: list[tuple[str, str]] = (), min_count: int = MIN_COUNT) -> DataFrame:
    """(words, f): the codes of every phrase of two to four words that occurs `min_count` times."""
    frequent = rows.sparkSession.sparkContext.broadcast(frequent_pairs(rows, clashing, min_count))
    found = hot_prefixes(rows, clashing, frequent)
    hot = [F.lit(False) if not h else F.xxhash64(*COLUMNS[: k + 2]).isin(h) for k, h in enumerate(found)]
    place = F.xxhash64("w1", "w2", F.when(hot[0], F.col("w3")), F.when(hot[0] & hot[1], F.col("w4")))
    dealt = windows(rows, clashing, frequent).repartition(place)
    counted = dealt.withColumn("place", place).groupBy("place", *COLUMNS).agg(F.sum("n").alias("n"))
    by = Window.partitionBy
    counted = counted.select(
        "place", *COLUMNS, "n", F.sum("n").over(by("place", "w1", "w2", "w3")).alias("n3"),
        F.sum("n").over(by("place", "w1", "w2")).alias("n2"),
    )
    often2 = hot[0] | (F.col("n2") >= min_count)
    often3 = often2 & ((hot[0] & hot[1]) | (F.col("n3") >= min_count))
    often4 = often3 & (F.col("n") >= min_count)
    padded = counted.filter(often2).select(
        F.struct("w1", "w2").alias("pair"), F.when(often3, F.col("w3")).otherwise(PAD).alias("w3"),
        F.when(often4, F.col("w4")).otherwise(PAD).alias("w4"), "n",
    )
    summed = padded.rollup("pair", "w3", "w4").agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    whole = (F.col("level") == 3) | ((F.col("level") == 1) & (F.col("w3") != PAD)) | (
        (F.col("level") == 0) & (F.col("w4") != PAD)
    )
    words = F.array(F.col("pair")["w1"], F.col("pair")["w2"], "w3", "w4")
    return summed.filter(whole & (F.col("f") >= min_count)).select(F.array_compact(words).alias("words"), "f")


def scored(found: DataFrame, singles: DataFrame) -> DataFrame:
    """(words, a, l, r, score) of phrases not absorbed by longer ones, by their worst cut.

    found: (words, f) of all phrases. singles: the same of frequent words.
    """
    counts = found.unionByName(singles)
    cuts = found.select("words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select(
        "words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("left"),
        F.slice("words", F.col("k") + 1, F.size("words")).alias("right"),
    )
    left = counts.select(F.col("words").alias("left"), F.col("f").alias("l"))
    right = counts.select(F.col("words").alias("right"), F.col("f").alias("r"))
    value = F.expr(f"CAST({SCALE} AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0)) DIV (CAST(l AS DECIMAL(20,0)) + r)")
    worst = cuts.join(left, "left").join(right, "right").groupBy("words", "a").agg(
        F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("cut")
    )
    inner = found.filter(F.size("words") > 2).select("f", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("words") - 1),
        lambda n: F.transform(F.sequence(F.lit(1), F.size("words") - n + 1), lambda at: F.slice("words", at, n)),
    ))).alias("words"))
    longer = inner.groupBy("words").agg(F.max("f").alias("longer"))
    kept = worst.join(longer, "words", "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < ABSORBED_PERCENT * F.col("a"))
    )
    return kept.select("words", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", top: int | None = TOP, min_count: int = MIN_COUNT
) -> DataFrame:
    """Each language's best phrases (all, if `top` is None): lang, rank, phrase, a, l, r, n, score."""
    reach_workers(docs.sparkSession)
    rows = prepared(docs, text, lang)
    known, clashing = dictionary(rows)
    frequent = known.filter(F.col("f") >= min_count)
    found = staged(phrases(rows, clashing, min_count), "phrases")
    best = scored(found, frequent.select(F.array("code").alias("words"), "f"))
    each = best.select("*", F.posexplode("words").alias("at", "code")).join(frequent.select("lang", "word", "code"), "code")
    named = each.groupBy("words", "a", "l", "r", "score", "lang").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")
    )
    sizes = known.groupBy("lang").agg(F.sum("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order))
    ranked = ranked if top is None else ranked.filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def report(docs: DataFrame) -> DataFrame:
    return collocations(docs)


ORACLE = rf"""
    WITH t AS (
        SELECT row_number() OVER () AS uid, coalesce(lang, 'und') AS lang,
            translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}') AS text FROM documents),
    p AS (SELECT lang, unnest(regexp_split_to_array(text, '{ENDS}')) AS piece FROM t),
    w AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '{BLANKS}') IF x <> ''] AS w FROM p),
    spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
    grams AS (
        SELECT lang, w[i : i + k - 1] AS g, count(*) AS f FROM spots, (SELECT unnest(range(1, {LONGEST + 1})) AS k)
        WHERE i + k - 1 <= len(w) GROUP BY ALL),
    sizes AS (SELECT lang, sum(f) AS n FROM grams WHERE len(g) = 1 GROUP BY lang),
    c AS (SELECT * FROM grams WHERE len(g) > 1 AND f >= {MIN_COUNT}),
    cuts AS (
        SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r, ({SCALE}::HUGEINT * c.f) // (l.f + r.f) AS score
        FROM (SELECT *, unnest(range(1, len(g))) AS k FROM c) c
        JOIN grams l ON l.lang = c.lang AND l.g = c.g[1 : k] JOIN grams r ON r.lang = c.lang AND r.g = c.g[k + 1 :]),
    worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    parts AS (
        SELECT lang, f, g[i : i + n - 1] AS g FROM (
            SELECT lang, f, g, n, unnest(range(1, len(g) - n + 2)) AS i
            FROM (SELECT *, unnest(range(2, len(g))) AS n FROM c))),
    longer AS (SELECT lang, g, max(f) AS f FROM parts GROUP BY ALL),
    kept AS (
        SELECT worst.lang, array_to_string(worst.g, ' ') AS phrase, a, l, r, score FROM worst
        LEFT JOIN longer ON longer.lang = worst.lang AND longer.g = worst.g
        WHERE longer.f IS NULL OR 100 * longer.f < {ABSORBED_PERCENT} * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
        a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
    FROM kept JOIN sizes USING (lang)
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {TOP}"""
