"""Mixing sources to target weights with soft domain membership.

A multinomial classifier over hashed words, fitted on a bounded sample of rows whose domain is known,
gives every document posteriors over the domains. A document's rate is how often it is expected to be
seen; expected tokens of a domain are the sum of rate x tokens x posterior. Projected gradient descent
fits the rates so that those totals meet the targets: each step is one pass over the stored posteriors,
sums one number per domain, and moves every rate along its document's posteriors; rates are projected
onto those of at least min_rate. An upper bound is an option, not the default. A rate depends on the document's posteriors and the steps' residuals only, so
the steps (one short vector each) are all that a pass has to be told.

Null texts have no tokens. Rows without a domain are not learnt from but get rates like any other. With
no labelled rows or one domain only, that domain has posterior one. Targets of domains nobody can supply
are met as closely as the rates allow; a fitted mixture tells target and reached total of each domain. Repeated rows each have their own rate. An empty table gives an
empty result.
"""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import words
from pitlake.plans.scratch import staged

BUCKETS = 1 << 12
#: Most labelled rows that the classifier is fitted on.
MAX_FIT_ROWS = 20_000
#: The steps stop when no domain's total is off by more than this share of its own target, or when no rate can move.
TOLERANCE = 1e-5
#: A rate that moves by less than this part of itself in a step does not move.
STILL = 1e-12
MAX_STEPS = 60
#: Steps that take domains one by one; if these do not do, steps take account of overlapping posteriors.
APART = 8
#: With every document kept, how much more the total may grow so that targets can be met exactly.
GROWTH = 1.25
#: After so many steps the rates reached are stored, so a pass never replays all steps before it.
STORED_EVERY = 8


@dataclass
class Classifier:
    """Posterior column over `domains`; without a fitted model, the first domain has all of it."""

    domains: list[str]
    model: object = None

    def posteriors(self, df: DataFrame) -> DataFrame:
        """`df` (with `words`) with `posterior`, an array in the order of `domains`."""
        if self.model is None:
            one = F.array(*(F.lit(1.0 if k == 0 else 0.0) for k in range(len(self.domains))))
            return df.withColumn("posterior", one)
        vectors = HashingTF(inputCol="words", outputCol="hashed", numFeatures=BUCKETS).transform(df)
        scored = self.model.transform(vectors)
        return scored.select(*df.columns, vector_to_array("probability").alias("posterior"))


def fit_classifier(labelled: DataFrame, max_rows: int = MAX_FIT_ROWS) -> Classifier:
    """From rows (domain, words); beyond `max_rows`, rows whose hash falls in the share that makes as many."""
    labelled = labelled.filter(F.col("domain").isNotNull())
    total, kinds = labelled.agg(F.count("*"), F.collect_set("domain")).first()
    if not total or len(kinds) < 2:
        return Classifier(kinds or ["all"])
    if total > max_rows:
        share = int(max_rows / total * (1 << 20))
        labelled = labelled.filter(F.pmod(F.xxhash64("words"), F.lit(1 << 20)) < share)
    rows = HashingTF(inputCol="words", outputCol="hashed", numFeatures=BUCKETS).transform(labelled)
    rows = staged(rows.select("hashed", "domain"), "mixing-fit")
    index = StringIndexer(inputCol="domain", outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    if len(index.labels) < 2:
        return Classifier(list(index.labels))
    model = LogisticRegression(
        featuresCol="hashed", labelCol="label", family="multinomial", regParam=1e-4, maxIter=30
    ).fit(index.transform(rows))
    return Classifier(list(index.labels), model)


def temperature_weights(shares: dict[str, float], power: float) -> dict[str, float]:
    """Target weights from natural shares: share ** power, scaled to one."""
    raised = {d: s**power if s > 0 else 0.0 for d, s in shares.items()}
    total = sum(raised.values()) or 1.0
    return {d: v / total for d, v in raised.items()}


@dataclass
class Rates:
    """Fitted steps; `column` is the rate of a row with `posterior`."""

    min_rate: float
    max_rate: float | None = None
    steps: list[list[float]] = field(default_factory=list)

    def start(self) -> Column:
        return F.lit(self._bounded(max(1.0, self.min_rate), min))

    def _bounded(self, rate, least):
        return rate if self.max_rate is None else least(rate, self.max_rate)

    def column(self, start: Column | None = None, since: int = 0) -> Column:
        """The rate after all steps; or after those from `since` on, from a rate already reached."""
        start = self.start() if start is None else start
        if not self.steps[since:]:
            return start
        steps = F.lit([[float(x) for x in s] for s in self.steps[since:]])

        def move(rate: Column, step: Column) -> Column:
            along = F.aggregate(
                F.zip_with(step, F.col("posterior"), lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x
            )
            return self._bounded(F.greatest(F.lit(self.min_rate), rate - along), lambda r, most: F.least(r, F.lit(most)))

        return F.aggregate(steps, start, move)


def _totals(df: DataFrame, values: dict[str, Column]) -> dict[str, float]:
    got = df.agg(*(F.sum(v).alias(n) for n, v in values.items())).first()
    return {n: float(got[n] or 0.0) for n in values}


def natural_totals(rows: DataFrame, n: int) -> np.ndarray:
    got = _totals(rows, {f"t{k}": F.col("tokens") * F.col("posterior")[k] for k in range(n)})
    return np.array([got[f"t{k}"] for k in range(n)])


def curvature(rows: DataFrame, n: int) -> np.ndarray:
    """Tokens times products of posteriors, summed."""
    second = _totals(rows, {
        f"m{i}_{j}": F.col("tokens") * F.col("posterior")[i] * F.col("posterior")[j]
        for i in range(n) for j in range(i, n)
    })
    return np.array([[second[f"m{min(i, j)}_{max(i, j)}"] for j in range(n)] for i in range(n)])


def met(now: np.ndarray, targets: np.ndarray, tolerance: float = TOLERANCE) -> np.ndarray:
    """Per domain, whether its total is within the tolerance of its own target."""
    return np.abs(now - targets) <= tolerance * targets


def fit_rates(
    rows: DataFrame, targets: np.ndarray, min_rate: float = 0.0, max_rate: float | None = None,
    tolerance: float = TOLERANCE, max_steps: int = MAX_STEPS,
) -> tuple[Rates, np.ndarray]:
    """Rates for stored (tokens, posterior) so that domain totals meet `targets` (in tokens), and the totals.

    The step length is the inverse of the largest curvature, which one pass over the rows gives. After APART
    steps, residuals are weighed by the inverse of the whole curvature, for which that length is one.
    """
    n = len(targets)
    total = float(natural_totals(rows, n).sum())
    rates = Rates(min_rate, max_rate)
    if not total:
        return rates, np.zeros(n)
    curve = curvature(rows, n) / total
    # curvature differs between small and large domains: each moves by its own
    scale = 1.0 / np.maximum(curve.sum(axis=1), 1e-9)
    length = 1.0 / max(float(np.abs(np.linalg.eigvals(scale[:, None] * curve)).max()), 1e-9)
    # rare domains make small entries: scaled before they are inverted
    root = np.sqrt(scale)
    inverse = root[:, None] * np.linalg.pinv(root[:, None] * curve * root, rcond=1e-9, hermitian=True) * root
    reached, since = rows.select("tokens", "posterior", rates.start().alias("reached")), 0
    while True:
        last = max(len(rates.steps) - 1, since)
        before = Rates(min_rate, max_rate, rates.steps[:last]).column(F.col("reached"), since)
        passed = reached.select("tokens", "posterior", before.alias("before"))
        passed = passed.select("*", rates.column(F.col("before"), last).alias("rate"))
        got = passed.agg(
            *(F.sum(F.col("rate") * F.col("tokens") * F.col("posterior")[k]) for k in range(n)),
            F.max(F.abs(F.col("rate") - F.col("before")) / F.greatest(F.lit(1.0), "rate")),
        ).first()
        now = np.array([float(x or 0.0) for x in got[:n]])
        still = len(rates.steps) > since and got[n] <= STILL
        if met(now, targets, tolerance).all() or still or len(rates.steps) == max_steps:
            return rates, now
        if len(rates.steps) - since >= STORED_EVERY:
            reached, since = staged(passed.select("tokens", "posterior", F.col("rate").alias("reached")), "rates"), len(rates.steps)
        off = (now - targets) / total
        rates.steps.append((length * scale * off if len(rates.steps) < APART else inverse @ off).tolist())


def copies(rate: Column, draw: Column) -> Column:
    """How often a document is taken: its rate, rounded up or down by a hash in place of a coin."""
    coin = F.pmod(F.xxhash64(draw, F.lit("mixing")), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + coin).cast("int")


@dataclass
class Mixture:
    """A fitted mixture: `rated` gives any document its posteriors and rate, `table` has the fitted ones."""

    classifier: Classifier
    rates: Rates
    targets: np.ndarray
    totals: np.ndarray
    table: DataFrame

    def rated(self, docs: DataFrame) -> DataFrame:
        """`docs` (with `words` and `draw`) with `posterior`, `rate` and `copies`."""
        return self._taken(self.classifier.posteriors(docs))

    def reached(self) -> list[tuple[str, float, float]]:
        """Per domain its target and the total that the rates reach, in tokens."""
        return list(zip(self.classifier.domains, self.targets.tolist(), self.totals.tolist(), strict=True))

    def fitted(self) -> DataFrame:
        return self._taken(self.table)

    def _taken(self, df: DataFrame) -> DataFrame:
        return df.withColumn("rate", self.rates.column()).withColumn("copies", copies(F.col("rate"), F.col("draw")))


def known_domains(
    docs: DataFrame, labels: DataFrame, domain: str = "lang", key: str = "doc_id", text: str = "text",
    max_rows: int = MAX_FIT_ROWS,
) -> DataFrame:
    """(domain, words) of a bounded sample of the documents that the labels table covers.

    The sample is taken from the identifiers, by hash, so what is sent to every executor is about
    `max_rows` integers at most.
    """
    ids = labels.select(F.col(key).alias("known")).filter("known IS NOT NULL").distinct()
    total = ids.count()
    if total > max_rows:
        ids = ids.filter(F.pmod(F.xxhash64("known"), F.lit(1 << 20)) < int(max_rows / total * (1 << 20)))
    return docs.select(F.col(key).alias("id"), F.col(domain).alias("domain"), F.col(text).alias("text")).join(
        F.broadcast(ids), F.col("id") == F.col("known"), "left_semi"
    ).select("domain", words(F.col("text")).alias("words"))


def mix(
    docs: DataFrame, labelled: DataFrame, power: float = 0.5, weights: dict[str, float] | None = None,
    every_document: bool = False, max_rate: float | None = None, key: str = "doc_id", text: str = "text",
) -> Mixture:
    """Fit a mixture of `docs` from `labelled` rows (domain, words).

    Targets are `weights`, or natural shares to `power`, of all tokens. With `every_document` no rate is
    below one, and the total grows until the most plentiful domain needs no less than it has; somewhat more
    where posteriors overlap, so that rates of one and more can meet all targets. Missed targets are logged.
    """
    classifier = fit_classifier(labelled)
    n = len(classifier.domains)
    scored = classifier.posteriors(with_words(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))))
    table = staged(
        scored.select("doc_id", "draw", F.size("words").cast("double").alias("tokens"), "posterior"), "posteriors"
    )
    natural = natural_totals(table, n)
    total = natural.sum()
    shares = dict(zip(classifier.domains, natural / total if total else natural, strict=True))
    aim = weights or temperature_weights(shares, power)
    wanted = np.array([aim.get(d, 0.0) for d in classifier.domains])
    wanted = wanted / wanted.sum() if wanted.sum() else wanted
    if every_document and total and wanted.sum():
        total = max(natural[k] / wanted[k] for k in range(n) if wanted[k])
        # rates linear in the posteriors meet all targets with these slopes times the total
        slopes = np.linalg.lstsq(curvature(table, n), wanted, rcond=None)[0]
        if slopes.min() > 0 and 1.0 / slopes.min() <= GROWTH * total:
            total = max(total, 1.0 / slopes.min())
    rates, totals = fit_rates(table, wanted * total, 1.0 if every_document else 0.0, max_rate)
    mixture = Mixture(classifier, rates, wanted * total, totals, table)
    for (domain, target, reached), ok in zip(mixture.reached(), met(totals, mixture.targets), strict=True):
        if not ok:
            logging.getLogger(__name__).warning("domain %s: target %.1f tokens, reached %.1f", domain, target, reached)
    return mixture


def with_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with what the classifier reads, and the hash that decides on copies."""
    return docs.withColumn("words", words(F.col(text))).withColumn("draw", F.xxhash64(key, text))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: tokens, posterior of each domain, rate, copies taken; target and reached total of each domain.

    Domains are languages; the classifier learns from documents that the labels table covers.
    """
    mixture = mix(docs, known_domains(docs, labels))
    return mixture.fitted().select(
        "doc_id", F.col("tokens").cast("long").alias("tokens"),
        F.to_json(F.map_from_arrays(F.lit(mixture.classifier.domains), "posterior")).alias("posterior"), "rate", "copies",
        F.lit(json.dumps({d: {"target": t, "reached": r} for d, t, r in mixture.reached()})).alias("domains"),
    )
