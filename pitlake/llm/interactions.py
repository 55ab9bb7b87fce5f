"""Filter interaction audit: what each filter does in every order of application, by path counting.

A document is summed up by the set of filters it fails. The states of the audit are the subsets of filters
applied so far, its edges "filter f is applied in state s". What happens on an edge does not depend on how
the state was reached, so all orders are read from the 80 edges of five filters instead of being run:

* removed(s, f): documents failing f and none of s; redundant(s, f): failing f and some of s;
* forward(s): orders in which state s can be reached, backward(s): orders in which it can be left for the
  full set. An order passes edge (s, f) in forward(s) * backward(s + f) ways, which weights its removals in
  the sum over all orders (the Shapley value times the number of orders);
* step k of an order is the edge from the set of its first k - 1 filters.

Documents are read once. Their thin rows (identifier, part, digest of the text, failed filters, labels) are
stored; "identical to an earlier text" is decided from the smallest identifier of every text held more than
once, joined back by digest, where a hot digest can be split by adaptive execution. Then only counts per
part and set of failed filters are left, at most 32 a part, and every part is audited within its own row.

Null texts are empty. Null parts are the empty string. A null identifier is neither smaller nor larger than
any other, and carries no labels. Repeated rows are documents of their own; with equal identifiers none is
smaller. Of repeated labels, one that says 1 counts. Very long texts are words of one row, as in every
count of words. Columns other than the named ones are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import let, words
from pitlake.plans.scratch import staged

NAMES = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
SIGNS = "[#$%&*|]"
#: Name of the filter that needs other documents.
COPY = "E"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def own_failures(text: Column) -> dict[str, Column]:
    """The failure conditions that a text decides by itself."""
    counts = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.size(F.array_distinct(w)).cast("long").alias("distinct")
    ))
    return {
        "A": counts["n"] < MIN_WORDS,
        "B": 100 * counts["distinct"] < MIN_DISTINCT_PERCENT * counts["n"],
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > MAX_CAPITAL_PERCENT * F.length(text),
        "D": text.rlike(SIGNS),
    }


def forward_counts(n: int) -> list[int]:
    """Per state (bits of the filters applied): orders that reach it from the empty set."""
    out = [1] + [0] * (2**n - 1)
    for state in range(1, 2**n):
        out[state] = sum(out[state ^ (1 << f)] for f in range(n) if state >> f & 1)
    return out


def backward_counts(n: int) -> list[int]:
    """Per state: orders that leave it for the full set."""
    out = [0] * (2**n - 1) + [1]
    for state in range(2**n - 2, -1, -1):
        out[state] = sum(out[state | (1 << f)] for f in range(n) if not state >> f & 1)
    return out


def edges(n: int) -> list[tuple[int, int, int]]:
    """(state, filter, paths): every edge of the lattice and the orders that pass it."""
    there, on = forward_counts(n), backward_counts(n)
    return [
        (s, f, there[s] * on[s | (1 << f)]) for s in range(2**n) for f in range(n) if not s >> f & 1
    ]


def failures(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source",
    conditions: dict[str, Column] | None = None, copies: str | None = COPY,
) -> DataFrame:
    """(part, mask, docs, good, toxic): documents by the set of filters they fail.

    `conditions` maps a filter to its failure condition over the column `text`, with nulls read as empty;
    bit k of the mask is the k-th of the sorted names. `copies` names the filter of identical texts, if any.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    conditions = own_failures(body) if conditions is None else conditions
    names = sorted([*conditions, *([copies] if copies else [])])
    bits = [F.when(conditions[x], 1 << k).otherwise(0) for k, x in enumerate(names) if x in conditions]
    marked = labels.select(F.col(key).alias("labelled"), "quality", "toxic").groupBy("labelled").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    thin = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.unhex(F.sha2(body, 256)).alias("digest"), reduce(lambda a, b: a + b, bits, F.lit(0)).alias("own"),
    ).groupBy("key", "part", "digest", "own").agg(F.count(F.lit(1)).alias("n"))
    thin = thin.join(marked, F.col("key") == F.col("labelled"), "left").drop("labelled")
    if copies:
        thin = staged(thin, "filter-failures")
        firsts = thin.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("rows"))
        firsts = staged(firsts.filter(F.col("rows") > 1).select(F.col("digest").alias("copied"), "first"), "first-copies")
        again = F.coalesce(F.col("first") < F.col("key"), F.lit(False))
        thin = thin.join(firsts, F.col("digest") == F.col("copied"), "left").withColumn(
            "own", F.col("own") + F.when(again, 1 << names.index(copies)).otherwise(0)
        )
    n = F.col("n")
    return thin.groupBy("part", F.col("own").alias("mask")).agg(
        F.sum(n).alias("docs"), F.sum(n * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(n * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def _on_edge(held: Column, state: Column, bit: Column) -> Column:
    """The counts of one edge from `held`, a part's (mask, docs, good, toxic)."""
    def total(what: str, when) -> Column:
        return F.aggregate(held, F.lit(0).cast("long"), lambda a, x: a + F.when(when(x["mask"]), x[what]).otherwise(0))

    def hits(mask: Column) -> Column:
        return mask.bitwiseAND(bit) != 0

    def clear(mask: Column) -> Column:
        return mask.bitwiseAND(state) == 0

    return F.struct(
        total("docs", lambda m: clear(m) & ~hits(m)).alias("kept"),
        total("docs", lambda m: clear(m) & hits(m)).alias("removed"),
        total("docs", lambda m: ~clear(m) & hits(m)).alias("redundant"),
        total("docs", lambda m: m == bit).alias("unique_fails"),
        total("good", lambda m: clear(m) & hits(m)).alias("good_lost"),
        total("toxic", lambda m: clear(m) & hits(m)).alias("toxic_lost"),
    )


def _lattice(counts: DataFrame, n: int) -> DataFrame:
    """One row per part: the counts of all edges, in the order of `edges`."""
    held = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("held"))
    shape = F.array(*(F.struct(F.lit(s).alias("state"), F.lit(1 << f).alias("bit")) for s, f, _ in edges(n)))
    return held.select("part", F.transform(shape, lambda e: _on_edge(F.col("held"), e["state"], e["bit"])).alias("on"))


def shapley(counts: DataFrame, names: Sequence[str] = NAMES) -> DataFrame:
    """(part, filter, shapley): removals summed over all orders, from the weighted edges."""
    at = edges(len(names))
    sums = [
        reduce(lambda a, b: a + b, (F.col("on")[i]["removed"] * w for i, (_, g, w) in enumerate(at) if g == f))
        for f in range(len(names))
    ]
    each = F.array(*(F.struct(F.lit(x).alias("filter"), s.cast("long").alias("shapley")) for x, s in zip(names, sums)))
    return _lattice(counts, len(names)).select("part", F.inline(each))


def audit(counts: DataFrame, names: Sequence[str] = NAMES) -> DataFrame:
    """Per part, order of the filters and step: the counts of COUNTS and the step's filter's `shapley`.

    counts: as `failures` gives them, at most one row per part and mask.
    """
    at = edges(len(names))
    place = {(s, f): i for i, (s, f, _) in enumerate(at)}
    steps = []
    for order in permutations(range(len(names))):
        state = 0
        for k, f in enumerate(order):
            steps.append((place[state, f], f, "".join(names[x] for x in order), k + 1))
            state |= 1 << f
    # the orders as columns of one constant array: a row per part turns into its rows without a join
    shape = F.from_json(
        F.lit("[" + ",".join(f'{{"edge":{e},"own":{f},"filter_order":"{o}","step":{k}}}' for e, f, o, k in steps) + "]"),
        "array<struct<edge:int,own:int,filter_order:string,step:int>>",
    )
    sums = F.array(*(
        reduce(lambda a, b: a + b, (F.col("on")[i]["removed"] * w for i, (_, g, w) in enumerate(at) if g == f))
        for f in range(len(names))
    ))
    lattice = _lattice(counts, len(names)).select("part", "on", sums.alias("sums"))
    return lattice.select("part", "on", "sums", F.explode(shape).alias("at")).select(
        "part", F.col("at.filter_order").alias("filter_order"), F.col("at.step").alias("step"),
        *(F.get("on", F.col("at.edge"))[c].cast("long").alias(c) for c in COUNTS),
        F.get("sums", F.col("at.own")).cast("long").alias("shapley"),
    )


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over documents, by source."""
    return audit(failures(docs, labels))


ORACLE = rf"""
    WITH t AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
    w AS (
        SELECT doc_id, part, text, [x FOR x IN regexp_split_to_array(text, '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM t),
    firsts AS (SELECT text, min(doc_id) AS first FROM t GROUP BY text),
    marks AS (
        SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    f AS (
        SELECT w.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
            (CASE WHEN len(w) < {MIN_WORDS} THEN 1 ELSE 0 END)
            + (CASE WHEN 100 * len(list_distinct(w)) < {MIN_DISTINCT_PERCENT} * len(w) THEN 2 ELSE 0 END)
            + (CASE WHEN 100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > {MAX_CAPITAL_PERCENT} * length(w.text)
                THEN 4 ELSE 0 END)
            + (CASE WHEN regexp_matches(w.text, '{SIGNS}') THEN 8 ELSE 0 END)
            + (CASE WHEN firsts.first < w.doc_id THEN 16 ELSE 0 END) AS mask
        FROM w JOIN firsts ON w.text = firsts.text LEFT JOIN marks ON w.doc_id = marks.doc_id),
    m AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
    orders AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
        FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
        JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
    steps AS (
        SELECT filter_order, k AS step, bits[k] AS bit, coalesce(list_sum(bits[1 : k - 1]), 0)::INT AS before
        FROM orders, (SELECT unnest(range(1, 6)) AS k)),
    r AS (
        SELECT part, filter_order, step, bit,
            sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
            sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
            sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
            sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
            sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
            sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
        FROM m, steps GROUP BY ALL)
    SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
        redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
        toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
    FROM r"""
