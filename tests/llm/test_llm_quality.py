from __future__ import annotations

from llm_support import documents, sf_dir, workers  # noqa: F401

import math
import random
import re
import unicodedata
import zlib

from pyspark.sql import functions as F

from pitlake.llm import quality


def test_statistics_of_odd_texts(documents):
    long = "word " * 100_000
    docs = documents([(1, None), (2, ""), (3, "A b!\n\nA b!\nc|d"), (4, long), (None, "x")]).withColumn("raw", F.lit(1))
    got = {r.doc_id: r.asDict() for r in quality.with_statistics(docs).collect()}
    assert all(got[1][n] == 0 for n in quality.NAMES) and got[1] | {"doc_id": 2} == got[2]
    assert round(got[3]["distinct_words"], 6) == 0.6
    assert round(got[3]["distinct_lines"], 6) == round(2 / 3, 6)
    assert got[4]["distinct_words"] == 1 / 100_000


def test_held_out_is_crc32(spark):
    ids = [0, 1, 77, 123456, -5]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = {r.doc_id: r.h for r in df.select("doc_id", quality.is_held_out(F.col("doc_id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}


def test_rules_learn_a_conjunction(spark, documents):
    random.seed(3)

    def text(bad):
        words = ["".join(random.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
        return " ".join(w.upper() + "!!" if bad else w for w in words)

    rows = [(i, text(i % 4 == 0)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = quality.scored(documents([*rows, (None, None), (5000, "")]), labels).collect()
    judged = {r.doc_id: r for r in got}
    assert len(got) == 402 and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert len(held) > 40 and all(r.predicted == int(r.doc_id % 4 != 0) for r in held)
    assert judged[5000].score is not None


def test_held_out_accuracy(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.scored(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def test_labels_of_one_class_or_none(spark, documents):
    docs = documents([(1, "a b"), (2, "c d"), (3, "e f")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.scored(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in (1, 2, 3)], none.schema)
    assert all(r.score > 0.99 for r in quality.scored(docs, ones).collect())
    assert quality.scored(documents([]), ones).count() == 0


def test_bounded_fit_uses_a_share(spark, documents):
    docs = documents([(i, ("GOOD text here " if i % 2 else "||| ||| |||") + str(i)) for i in range(300)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    ensemble = quality.fit_on(docs, labels, max_rows=100)
    assert ensemble.weighted


def plain_statistics(text):
    text = text or ""
    w = [x for x in re.split("[\x20\x09-\x0d]+", text) if x]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    kinds = [unicodedata.category(c) for c in text]
    counts = {
        "upper": kinds.count("Lu"), "symbols": len(re.findall(r"[#*$%&|<>]", text)), "bangs": text.count("!"),
        "pipes": text.count("|"), "digits": sum(k[0] == "N" for k in kinds),
        "stops": len(re.findall("[.?](?=[\x20\x09-\x0d]|\\Z)", text)), "lines": text.count("\n"),
    }

    def ratio(a, b):
        return a / b if b else 0.0

    out = {
        "words": math.log1p(len(w)), "word_length": ratio(sum(map(len, w)), len(w)),
        "distinct_words": ratio(len(set(w)), len(w)), "long_words": ratio(sum(len(x) > 20 for x in w), len(w)),
        "distinct_lines": ratio(len(set(lines)), len(lines)), "words_per_line": ratio(len(w), len(lines)),
        "spread": ratio(math.log1p(len(set(w))), math.log1p(len(w))),
    }
    out |= {f"{n}_per_char": ratio(c, len(text)) for n, c in counts.items()}
    return out | {f"{n}_per_word": ratio(c, len(w)) for n, c in counts.items()}


def test_scores_equal_the_rules_applied_one_by_one(spark, documents, monkeypatch):
    random.seed(6)

    def text(k):
        words = ["".join(random.choices("abcdeÄé7", k=random.randrange(1, 30 if k % 5 == 0 else 9))) for _ in range(random.randrange(90))]
        marks = ["!", " | ", ". ", "?\n", " #"] if k % 3 else [" ", " ", ", ", "\n", ".\n"]
        return "".join(w.upper() + random.choice(marks) if k % 4 == 0 else w + random.choice(marks) for w in words)

    rows = [(k, text(k)) for k in range(300)] + [(400, None), (401, ""), (402, "Word. " * 20_000), (None, "x y")]
    labels = spark.createDataFrame([(k, int(k % 3 == 0 and k % 4 != 0)) for k in range(300)], "doc_id long, quality int")
    fitted, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda *a, **k: fitted.append(fit(*a, **k)) or fitted[-1])
    got = {r.doc_id: r.score for r in quality.scored(documents(rows), labels).collect()}
    assert fitted[0].weighted and any(len(rule.terms) > 1 for _, rule in fitted[0].weighted)
    for key, one in rows:
        values = plain_statistics(one)
        margin = fitted[0].intercept + sum(
            weight for weight, rule in fitted[0].weighted
            if all(values[n] <= t if at_most else values[n] > t for n, at_most, t in rule.terms)
        )
        assert abs(got[key] - 1 / (1 + math.exp(-margin))) < 1e-9
