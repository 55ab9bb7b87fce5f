from __future__ import annotations

from llm_support import documents, sf_dir, workers  # noqa: F401

import random

import numpy as np
from pyspark.sql import functions as F

from pitlake.llm import mixing


def talk(spark, sizes):
    random.seed(11)
    words = {"en": "the of and to in".split(), "de": "der die und zu ist".split(), "fr": "le la et de est".split()}
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((i, " ".join(random.choices(words[lang], k=random.randrange(5, 40))), lang))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def labels(spark, docs):
    return docs.select("doc_id").withColumn("quality", F.lit(1))


def test_totals_meet_targets(spark):
    docs = talk(spark, {"en": 200, "de": 60, "fr": 40})
    mixture = mixing.mix(docs, mixing.known_domains(docs, labels(spark, docs)), weights={"en": 1, "de": 1, "fr": 2})
    rows = mixture.fitted().collect()
    got = np.array([sum(r.rate * r.tokens * r.posterior[k] for r in rows) for k in range(3)])
    assert np.allclose(got, mixture.targets, rtol=1e-3)
    assert np.allclose(mixture.targets / mixture.targets.sum(), [0.25, 0.25, 0.5])
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    named = docs.join(mixture.fitted(), "doc_id").groupBy("lang").agg(F.avg("rate").alias("r")).collect()
    rate = {r.lang: r.r for r in named}
    assert rate["fr"] > rate["de"] > rate["en"]


def test_against_dense_projected_gradient(spark):
    docs = talk(spark, {"en": 50, "de": 20})
    mixture = mixing.mix(docs, mixing.known_domains(docs, labels(spark, docs)), power=0.3)
    rows = mixture.fitted().collect()
    p, t = np.array([r.posterior for r in rows]), np.array([r.tokens for r in rows])
    curve = (p * t[:, None]).T @ p / t.sum()
    scale = 1 / curve.sum(axis=1)
    length = 1 / np.abs(np.linalg.eigvals(scale[:, None] * curve)).max()
    r = np.ones(len(rows))
    for _ in range(len(mixture.rates.steps)):
        off = ((p * (t * r)[:, None]).sum(0) - mixture.targets) / t.sum()
        r = np.clip(r - p @ (length * scale * off), 0, 8)
    assert np.allclose(r, [x.rate for x in rows], atol=1e-9)


def test_every_document_stays(spark):
    docs = talk(spark, {"en": 120, "de": 30, "fr": 10})
    mixture = mixing.mix(docs, mixing.known_domains(docs, labels(spark, docs)), every_document=True)
    rows = mixture.rated(mixing.with_words(docs)).collect()
    assert min(r.rate for r in rows) >= 1 and min(r.copies for r in rows) >= 1
    assert {(r.doc_id, r.copies) for r in rows} == {(r.doc_id, r.copies) for r in mixture.fitted().collect()}


def test_odd_tables(spark):
    schema = "doc_id long, text string, lang string, words int, rate int"
    rows = [(1, None, None, 0, 0), (None, "the of and", "en", 0, 0), (1, "the " * 50_000, "en", 0, 0), (1, "", "en", 0, 0)]
    docs = spark.createDataFrame(rows, schema)
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = mixing.report(docs, none).collect()
    assert sorted(r.tokens for r in got) == [0, 0, 3, 50_000] and all(r.rate >= 0 for r in got)
    assert mixing.report(docs, docs.select("doc_id")).count() == 4
    assert mixing.report(docs.limit(0), none).count() == 0


def test_temperature():
    assert mixing.temperature_weights({"a": 0.64, "b": 0.36, "c": 0.0}, 0.5) == {"a": 0.8 / 1.4, "b": 0.6 / 1.4, "c": 0.0}


def scored(spark, rows):
    return spark.createDataFrame(rows, "tokens double, posterior array<double>")


def test_a_rare_domain_meets_its_target(spark):
    """A domain of 0.1 % needs a rate of about thirty at power 0.5."""
    rows = scored(spark, [(100.0, [1.0, 0.0])] * 999 + [(100.0, [0.0, 1.0])])
    natural = mixing.natural_totals(rows, 2)
    aim = np.sqrt(natural) / np.sqrt(natural).sum() * natural.sum()
    rates, totals = mixing.fit_rates(rows, aim)
    assert np.allclose(totals, aim, rtol=1e-5)
    bounded, less = mixing.fit_rates(rows, aim, max_rate=8.0)
    assert less[1] == 800 and bounded.max_rate == 8 and len(bounded.steps) < mixing.MAX_STEPS


def test_each_domain_is_held_against_its_own_target(spark):
    """Soft posteriors and a domain with a hundredth of a percent of all tokens."""
    random.seed(13)
    rows = []
    for k in range(3000):
        x = random.uniform(0.05, 0.6)
        rows.append((random.randrange(50, 200) * 1.0, [1 - x - 1e-4, x, 1e-4] if k % 1000 else [0.3, 0.1, 0.6]))
    rows = scored(spark, rows)
    natural = mixing.natural_totals(rows, 3)
    aim = natural ** 0.7 / (natural ** 0.7).sum() * natural.sum()
    rates, totals = mixing.fit_rates(rows, aim)
    assert np.allclose(totals, aim, rtol=1e-5, atol=0)


def test_report_shows_targets_and_totals(spark):
    import json

    docs = talk(spark, {"en": 300, "de": 60, "fr": 2})
    row = mixing.report(docs, labels(spark, docs)).first()
    got = json.loads(row.domains)
    assert set(got) == {"en", "de", "fr"} and all(abs(d["reached"] / d["target"] - 1) <= 1e-5 for d in got.values())


def test_targets_are_met_where_every_document_stays(spark):
    docs = talk(spark, {"en": 120, "de": 30, "fr": 10})
    mixture = mixing.mix(docs, mixing.known_domains(docs, labels(spark, docs)), power=0.7, every_document=True)
    assert np.allclose(mixture.totals, mixture.targets, rtol=1e-5)
