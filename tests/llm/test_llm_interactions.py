from __future__ import annotations

from llm_support import documents, sf_dir, workers  # noqa: F401

import math
import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from pitlake.llm import interactions

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, marks):
    """rows: (doc_id, source, text). Every order is run filter by filter."""
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    fails = []
    for i, s, t in rows:
        t = t or ""
        w = WORD.findall(t)
        bad = {"A"} if len(w) < 200 else set()
        bad |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        bad |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else set()
        bad |= {"D"} if re.search("[#$%&*|]", t) else set()
        bad |= {"E"} if i is not None and t in first and first[t] < i else set()
        fails.append((s or "", bad, *marks.get(i, (0, 0))))
    out = {}
    for part in {s for s, *_ in fails}:
        mine = [x for x in fails if x[0] == part]
        sums = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                here = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                sums[f] += len(here)
                out[part, "".join(order), k + 1] = [
                    len(left), len(here), sum(f in x[1] for x in mine) - len(here), sum(x[1] == {f} for x in mine),
                    sum(x[2] for x in here), sum(x[3] for x in here), f,
                ]
        for key, v in out.items():
            if key[0] == part:
                v[-1] = sums[v[-1]]
    return out


def table(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", s, len(t or "")) for i, s, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def got(df):
    return {
        (r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
        for r in df.collect()
    }


def test_orders_run_one_by_one_give_the_same(spark):
    random.seed(3)
    pieces = ["a few words", "Capitals HERE", "100 % sure", "word " * 250, " ".join(f"w{k}" for k in range(230)), "", "\n", "é"]
    texts = [" ".join(random.sample(pieces, random.randrange(3))) for _ in range(60)] + [None, "", "x " * 40_000]
    rows = [(random.randrange(50), random.choice(["a", "b", None, ""]), t) for t in texts]
    rows += [rows[0], rows[0], (None, "a", "a few words"), (None, None, None)]
    marks = [(i, random.choice([0, 1, None]), random.choice([0, 1])) for i in range(0, 50, 2)]
    want = brute(rows, {i: (int(q == 1), int(t == 1)) for i, q, t in marks})
    # labels given twice count once; other columns, whatever their names, don't matter
    docs = table(spark, rows).withColumn("part", F.lit(1)).withColumn("mask", F.lit(2)).withColumn("quality", F.lit(1))
    assert got(interactions.report(docs, labels(spark, marks + marks[:3] + [(None, 1, 1)]))) == want


def test_path_counts_cover_every_order():
    for n in range(1, 7):
        there, on = interactions.forward_counts(n), interactions.backward_counts(n)
        assert there[-1] == on[0] == math.factorial(n)
        assert all(there[s] == math.factorial(s.bit_count()) for s in range(2**n))
        # of every order one edge leads into each size of state
        by_size = {}
        for s, _, w in interactions.edges(n):
            by_size[s.bit_count()] = by_size.get(s.bit_count(), 0) + w
        assert by_size == dict.fromkeys(range(n), math.factorial(n))


def test_shapley_shares_all_removals(spark, sf_dir):
    from pitlake.llm.common import table as read

    docs, marks = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    counts = interactions.failures(docs, marks)
    shares = interactions.shapley(counts).groupBy("part").agg(F.sum("shapley").alias("all"))
    gone = counts.groupBy("part").agg(F.sum(F.when(F.col("mask") > 0, F.col("docs")).otherwise(0)).alias("gone"))
    for r in shares.join(gone, "part").collect():
        assert r["all"] == 120 * r["gone"]  # whatever the order, all failing documents go


def test_other_filters_and_no_copies(spark):
    docs = table(spark, [(1, "s", "x"), (2, "s", "y"), (3, "s", "xy")])
    conditions = {"A": F.col("text").contains("x"), "B": F.col("text").contains("y")}
    out = interactions.audit(interactions.failures(docs, labels(spark, []), conditions=conditions, copies=None), "AB")
    assert got(out)["s", "BA", 2] == [0, 1, 1, 1, 0, 0, 3] and out.count() == 4


@pytest.mark.parametrize("rows", [[], [(1, None, None)]])
def test_empty_table_and_one_row(spark, rows):
    out = got(interactions.report(table(spark, rows), labels(spark, [])))
    assert out == brute(rows, {})
