"""Quality classifier: a sparse ensemble of rules.

A bounded forest of shallow trees is fitted on statistics of labelled texts; every path from a root to a
node becomes a conjunctive rule. A logistic regression with lasso penalty weighs the rules, most get
weight zero, and what is left is compiled into one Spark column expression over the statistics. Scoring
is that expression and runs wherever the statistics are.

The statistics are built-in expressions over the whole text. Labels, languages, sources and identifiers
are never inputs. Null texts count as empty; an empty text has all statistics zero. Rows without labels,
or labels of one class only, give a constant score: the share of label 1, or 0.5 where there is none.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import let, words
from pitlake.plans.scratch import staged

#: Patterns whose number of matches per character or word is a statistic.
COUNTED = {
    "upper": r"\p{Lu}", "symbols": r"[#*$%&|<>]", "bangs": "!", "pipes": r"\|", "digits": r"\p{N}",
    "stops": r"[.?](?=[\x20\x09-\x0D]|$)", "lines": r"\n",
}
#: Most labelled rows that trees and weights are fitted on.
MAX_FIT_ROWS = 40_000
THRESHOLD = 0.3


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text; all doubles."""
    text = F.coalesce(text, F.lit(""))
    raw = F.struct(
        F.length(text).cast("double").alias("chars"),
        *(F.regexp_count(text, F.lit(p)).cast("double").alias(n) for n, p in COUNTED.items()),
        let(words(text), lambda w: F.struct(
            F.size(w).cast("double").alias("n"),
            F.size(F.array_distinct(w)).cast("double").alias("distinct"),
            F.size(F.filter(w, lambda x: F.length(x) > 20)).cast("double").alias("long"),
            F.aggregate(w, F.lit(0), lambda a, x: a + F.length(x)).cast("double").alias("chars"),
        )).alias("w"),
        let(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.struct(
            F.size(x).cast("double").alias("n"),
            F.size(F.array_distinct(x)).cast("double").alias("distinct"),
        )).alias("l"),
    )
    return {"raw": raw}


NAMES = [
    "words", "word_length", "distinct_words", "long_words", "distinct_lines", "words_per_line", "spread",
    *(f"{n}_per_char" for n in COUNTED), *(f"{n}_per_word" for n in COUNTED),
]


def with_statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` and one double per name in NAMES."""
    raw = docs.select(*keep, statistics(F.col(text))["raw"].alias("raw"))
    w, lines = "raw.w", "raw.l"
    values = {
        "words": F.log1p(f"{w}.n"),
        "word_length": ratio(F.col(f"{w}.chars"), F.col(f"{w}.n")),
        "distinct_words": ratio(F.col(f"{w}.distinct"), F.col(f"{w}.n")),
        "long_words": ratio(F.col(f"{w}.long"), F.col(f"{w}.n")),
        "distinct_lines": ratio(F.col(f"{lines}.distinct"), F.col(f"{lines}.n")),
        "words_per_line": ratio(F.col(f"{w}.n"), F.col(f"{lines}.n")),
        "spread": ratio(F.log1p(f"{w}.distinct"), F.log1p(f"{w}.n")),
    }
    values |= {f"{n}_per_char": ratio(F.col(f"raw.{n}"), F.col("raw.chars")) for n in COUNTED}
    values |= {f"{n}_per_word": ratio(F.col(f"raw.{n}"), F.col(f"{w}.n")) for n in COUNTED}
    return raw.select(*keep, *(values[n].alias(n) for n in NAMES))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, whether at most, threshold)."""

    terms: frozenset[tuple[str, bool, float]]

    def column(self) -> Column:
        each = [F.col(n) <= t if at_most else F.col(n) > t for n, at_most, t in sorted(self.terms)]
        return reduce(lambda a, b: a & b, each)


def rules_of(forest, names: list[str]) -> list[Rule]:
    """Every path from a root to a node below it, in the forest's own order, each once."""
    found: dict[Rule, None] = {}

    def walk(node, path: dict) -> None:
        if path:
            found[Rule(frozenset((n, at_most, t) for (n, at_most), t in path.items()))] = None
        if node.getClass().getSimpleName() != "InternalNode":
            return
        split = node.split()
        name, cut = names[split.featureIndex()], split.threshold()
        for child, at_most in ((node.leftChild(), True), (node.rightChild(), False)):
            tighter = min if at_most else max
            own = {**path, (name, at_most): tighter(path.get((name, at_most), cut), cut)}
            walk(child, own)

    for tree in forest.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(found)


@dataclass
class RuleEnsemble:
    """Intercept and weighted rules; `score` is the column expression."""

    intercept: float
    weighted: list[tuple[float, Rule]]

    def score(self) -> Column:
        margin = reduce(
            lambda total, wr: total + F.when(wr[1].column(), wr[0]).otherwise(0.0), self.weighted, F.lit(self.intercept)
        )
        return 1.0 / (1.0 + F.exp(-margin))


def fit(
    labelled: DataFrame, label: str = "label", trees: int = 12, depth: int = 3, penalty: float = 1e-3,
    max_rows: int = MAX_FIT_ROWS, row_hash: Column | None = None,
) -> RuleEnsemble:
    """Fit on a stored table of statistics with a 0/1 label.

    Beyond `max_rows` labelled rows, those whose hash falls in the share that makes about `max_rows`.
    """
    labelled = labelled.filter(F.col(label).isin(0, 1))
    total, ones = labelled.agg(F.count("*"), F.sum(F.col(label).cast("long"))).first()
    if not total or not ones or ones == total:
        share = (ones or 0) / total if total else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return RuleEnsemble(math.log(share / (1 - share)), [])
    if total > max_rows:
        mark = F.xxhash64(*NAMES) if row_hash is None else row_hash
        labelled = labelled.filter(F.pmod(mark, F.lit(1 << 20)) < int(max_rows / total * (1 << 20)))
    rows = staged(
        VectorAssembler(inputCols=NAMES, outputCol="features").transform(labelled)
        .select("features", *NAMES, F.col(label).cast("double").alias("y")), "quality-fit",
    )
    forest = RandomForestClassifier(
        labelCol="y", numTrees=trees, maxDepth=depth, seed=7, featureSubsetStrategy="sqrt", maxBins=64
    ).fit(rows)
    rules = rules_of(forest, NAMES)
    if not rules:
        share = ones / total
        return RuleEnsemble(math.log(share / (1 - share)), [])
    fired = rows.select("y", *(r.column().cast("double").alias(f"r{k}") for k, r in enumerate(rules)))
    fired = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="rules").transform(fired)
    lasso = LogisticRegression(
        featuresCol="rules", labelCol="y", regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=100
    ).fit(staged(fired.select("rules", "y"), "quality-rules"))
    weights = lasso.coefficients.toArray()
    return RuleEnsemble(float(lasso.intercept), [(float(w), r) for w, r in zip(weights, rules, strict=True) if w])


def fit_on(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, **how) -> RuleEnsemble:
    """Fit on (doc_id, text) rows that `labels` (doc_id, quality) covers.

    At most about `max_rows` labels are taken, by hash of the identifier, so the labels that are sent to
    every executor have a fixed bound, and only the texts they name are measured.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).select(
        F.col("doc_id").alias("labelled"), F.col("quality").alias("label")
    )
    total = known.count()
    if total > max_rows:
        known = known.filter(F.pmod(F.xxhash64("labelled"), F.lit(1 << 20)) < int(max_rows / total * (1 << 20)))
    named = docs.join(F.broadcast(known), F.col("doc_id") == F.col("labelled"))
    return fit(staged(with_statistics(named, keep=("label",)), "labelled-statistics"), max_rows=max_rows, **how)


def is_held_out(key: Column) -> Column:
    """Whether crc32 of the decimal identifier is a multiple of 5; a null identifier counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: identifier, whether it is held out, score, prediction."""
    table = staged(with_statistics(docs), "statistics")
    training = table.filter(~is_held_out(F.col("doc_id"))).join(
        labels.select("doc_id", F.col("quality").alias("label")), "doc_id"
    )
    score = fit(training).score()
    return table.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
