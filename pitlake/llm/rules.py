"""Quality rules: counts within a text, and how many documents of a host share its lines.

Lines are normalised (lower case, digits as 0, white space as one space) and hashed. Per host, the
distinct documents holding a line are counted, where documents of the same text count once: copies of a
document don't make its lines boilerplate, but documents that differ only in digits or case do. A line goes
when more than MAX_DOCS documents of its host hold it, or, on hosts too small for that, when more than MAX_SHARE of
them (and MIN_DOCS) do. A document is rejected when too little is left: under MIN_LEFT_SHARE of its words, or
fewer than the base rule asks of any document.

Only DataFrame expressions. One pass reads the texts and stores counts, and per line its hash and its number
of words, but no text; the rest works on those. Counting is two-phase with partial sums before each shuffle, so
neither a host with a third of all rows nor a line on every page meets in one task. `cleaned` stores the
texts too, as it gives them out.

Null texts have no words. Null hosts are one host. Repeated rows are counted as one document and judged
alike. A very long text is one row. Columns other than the three named ones are not read, and may have any
names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import GAPS, let, words
from pitlake.plans.scratch import staged

#: Base rules.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: A line is boilerplate of its host when in more documents than this, whatever the host's size,
MAX_DOCS = 50
#: or when in more than this share of the host's documents, and in so many at least.
MAX_SHARE = 0.3
MIN_DOCS = 5
#: A document is depleted when less than this share of its words is left.
MIN_LEFT_SHARE = 0.1


def repeat_words(w: Column) -> Column:
    """Words covered by windows of WINDOW words that occur twice or more among the words `w`."""
    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1), p + WINDOW) - p))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def repeated(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, k: (
            F.coalesce(F.get(ordered, k + 1)["h"] == x["h"], F.lit(False))
            | F.when(k > 0, F.get(ordered, k - 1)["h"] == x["h"]).otherwise(False)
        ))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    hashed = F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW),
        lambda i: F.struct(F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))).alias("h"), i.alias("i")),
    )
    return F.when(F.size(w) >= WINDOW, let(F.sort_array(hashed), repeated)).otherwise(0)


def normalised_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"\p{Nd}", "0"), GAPS, " "))


def profile(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", rest: tuple[str, ...] | None = None
) -> DataFrame:
    """Per document: counts, and `lines` with the hash and the words of each normalised line that has a word.

    With `rest` the text goes along, and those columns in a struct.
    """
    carried = [] if rest is None else [
        F.col(text).alias("text"),
        F.struct(F.lit(0).alias("none"), *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(rest))).alias("rest"),
    ]
    body = F.coalesce(F.col(text), F.lit(""))
    within = let(words(body), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), repeat_words(w).cast("long").alias("n_repeat_words")
    ))
    lines = let(F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.struct(
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup"),
        F.transform(x, lambda line: F.struct(
            F.xxhash64(normalised_line(line)).alias("h"), F.size(words(line)).alias("words")
        )).alias("each"),
    ))
    return docs.select(
        F.xxhash64(body).alias("content"),
        *carried,
        F.col(key).alias("doc_id"),
        F.col(host).alias("host"),
        F.length(F.regexp_replace(body, GAPS, "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        within.alias("within"),
        lines.alias("lines"),
    ).select(
        F.monotonically_increasing_id().alias("uid"), "content", *([] if rest is None else ["text", "rest"]), "doc_id", "host", F.col("within.n_words").alias("n_words"),
        "word_chars", "n_symbols", F.col("lines.n_dup").alias("n_dup_lines"),
        F.col("within.n_repeat_words").alias("n_repeat_words"), F.col("lines.each").alias("lines"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def line_frequencies(profiled: DataFrame) -> DataFrame:
    """(host, h, docs): distinct documents of a host that hold a line."""
    contents = profiled.select("host", F.array_distinct("lines.h").alias("lines"), "content")
    return contents.select("host", "content", F.explode("lines").alias("h")).groupBy("host", "h").agg(
        F.count_distinct("content").alias("docs")
    )


def host_sizes(profiled: DataFrame) -> DataFrame:
    """(host, host_docs): distinct documents of a host."""
    return profiled.groupBy("host").agg(F.count_distinct("content").alias("host_docs"))


def boilerplate(profiled: DataFrame, max_docs: int, max_share: float, min_docs: int = MIN_DOCS) -> DataFrame:
    """(on_host, line): the lines of stored `profiled` that go."""
    often = line_frequencies(profiled).filter(F.col("docs") >= min(min_docs, max_docs + 1))
    sizes = host_sizes(profiled)
    many = (F.col("docs") > max_docs) | ((F.col("docs") >= min_docs) & (F.col("docs") > max_share * F.col("host_docs")))
    return often.join(sizes, often["host"].eqNullSafe(sizes["host"])).filter(many).select(
        often["host"].alias("on_host"), F.col("h").alias("line")
    )


def removed_words(profiled: DataFrame, gone: DataFrame) -> DataFrame:
    """`profiled` with n_removed_words: the words of its lines that are `boilerplate` of its host."""
    each = profiled.select("uid", "host", F.explode("lines").alias("l")).groupBy("uid", "host", F.col("l.h").alias("h")).agg(
        F.sum("l.words").alias("words")
    )
    removed = (
        each.join(gone, each["h"].eqNullSafe(F.col("line")) & each["host"].eqNullSafe(F.col("on_host")))
        .groupBy("uid").agg(F.sum("words").alias("n_removed_words"), F.collect_set("h").alias("gone"))
    )
    return profiled.join(removed, "uid", "left").withColumn(
        "n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long")
    )


def _kept(min_left_share: float) -> Column:
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & ((left < min_left_share * F.col("n_words")) | (left < MIN_WORDS))
    return ~F.col("base_failed") & ~depleted


def judged(
    docs: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE, min_left_share: float = MIN_LEFT_SHARE,
    key: str = "doc_id", text: str = "text", host: str = "source",
) -> DataFrame:
    """Per document: the counts, base_failed, kept, and how many of its words stand in removed lines."""
    profiled = staged(profile(docs, key, text, host), "line-profile")
    return removed_words(profiled, boilerplate(profiled, max_docs, max_share)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        _kept(min_left_share).alias("kept"), "n_removed_words",
    )


def cleaned(
    docs: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE, min_left_share: float = MIN_LEFT_SHARE,
    key: str = "doc_id", text: str = "text", host: str = "source",
) -> DataFrame:
    """The kept documents with boilerplate lines cut out of their text; columns as they were."""
    profiled = staged(profile(docs, key, text, host, tuple(docs.columns)), "line-profile")
    kept = removed_words(profiled, boilerplate(profiled, max_docs, max_share)).filter(_kept(min_left_share))
    left = F.filter(F.split("text", "\n"), lambda line: (
        ~line.rlike(r"[^\x20\x09-\x0D]") | ~F.array_contains("gone", F.xxhash64(normalised_line(line)))
    ))
    # what is not removed stays as it was, blank lines too
    kept = kept.withColumn("text", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")))
    return kept.select(*(
        F.col("text").alias(c) if c == text else F.col("rest")[f"c{k}"].alias(c) for k, c in enumerate(docs.columns)
    ))


ORACLE = rf"""
    WITH t AS (
        SELECT row_number() OVER () AS uid, doc_id, source, coalesce(text, '') AS text FROM documents),
    w AS (SELECT uid, [x FOR x IN regexp_split_to_array(text, '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM t),
    p AS (SELECT uid, w, unnest(range(0, len(w) - {WINDOW - 1})) AS i FROM w WHERE len(w) >= {WINDOW}),
    g AS (SELECT uid, i, count(*) OVER (PARTITION BY uid, w[i + 1 : i + {WINDOW}]) AS n FROM p),
    c AS (
        SELECT uid, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n
        FROM (SELECT uid, i, lead(i) OVER (PARTITION BY uid ORDER BY i) AS nxt FROM g WHERE n > 1) GROUP BY uid),
    l0 AS (SELECT uid, source, unnest(string_split(text, chr(10))) AS l FROM t),
    l1 AS (SELECT * FROM l0 WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
    l AS (
        SELECT uid, source, l,
            trim(regexp_replace(regexp_replace(lower(l), '\p{{Nd}}', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
        FROM l1),
    d AS (SELECT uid, count(*) - count(DISTINCT l) AS n FROM l GROUP BY uid),
    sizes AS (SELECT source, count(DISTINCT text) AS n FROM t GROUP BY source),
    f AS (
        SELECT l.source, norm, count(DISTINCT text) AS n FROM l JOIN t USING (uid) GROUP BY l.source, norm),
    b AS (
        SELECT f.source, norm FROM f JOIN sizes s ON f.source IS NOT DISTINCT FROM s.source
        WHERE f.n > {MAX_DOCS} OR (f.n >= {MIN_DOCS} AND f.n > {MAX_SHARE} * s.n)),
    r AS (
        SELECT uid, sum(len(string_split(l.norm, ' '))) AS n
        FROM l JOIN b ON l.norm = b.norm AND l.source IS NOT DISTINCT FROM b.source GROUP BY uid),
    o AS (
        SELECT doc_id, len(w)::BIGINT AS n_words,
            length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
            coalesce(d.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
            coalesce(r.n, 0)::BIGINT AS n_removed_words
        FROM t JOIN w USING (uid) LEFT JOIN c USING (uid) LEFT JOIN d USING (uid) LEFT JOIN r USING (uid)),
    v AS (
        SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
            n_removed_words > 0 AND (n_words - n_removed_words < {MIN_LEFT_SHARE} * n_words
                OR n_words - n_removed_words < {MIN_WORDS}) AS depleted FROM o)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND NOT depleted AS kept, n_removed_words FROM v"""
