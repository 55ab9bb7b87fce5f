from __future__ import annotations

from llm_support import documents, sf_dir, workers  # noqa: F401

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pitlake.llm import collocations as co

SMALL = str.maketrans(co.CAPITALS, co.SMALL)


def brute(rows, least=30, top=2000):
    """rows: (text, lang)."""
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(SMALL)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for i in range(len(w)):
                for k in range(1, min(4, len(w) - i) + 1):
                    counts[lang or "und"][tuple(w[i : i + k])] += 1
    out = {}
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(
                len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in found.items()
            ):
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out[lang, rank] = (p.decode(), -a, l, r, n[lang], -s)
    return out


def got(df):
    return {(r["lang"], r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


@pytest.fixture
def texts():
    random.seed(13)
    common = ["New York", "as well as", "in order to make", "à la carte", "the"]
    out = []
    for _ in range(600):
        words = [random.choice(common) if random.random() < 0.3 else f"w{int(random.expovariate(0.4))}" for _ in range(40)]
        out.append("".join(w + random.choice([" ", " ", " ", "\t ", ". ", "\n", ", "]) for w in words))
    out += ["one same line of text"] * 35 + [None, "", " .,; ", "É é", "a " * 20_000, "go!" * 40]
    return [(t, random.choice(["en", "fr", None, "und"])) for t in out]


def table(spark, rows):
    return spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string")


def test_scores_equal_those_of_plain_python(spark, texts):
    docs = table(spark, texts).withColumn("w1", F.lit(1)).withColumn("n", F.lit(2)).withColumn("word", F.lit("x"))
    want = brute(texts)
    assert len(want) > 100 and got(co.report(docs)) == want
    assert got(co.collocations(docs, top=3, min_count=40)) == brute(texts, 40, 3)


def test_hot_prefixes_move_rows_and_change_nothing(spark, texts, monkeypatch):
    """Every prefix is hot, and windows are counted in many small chunks."""
    want = brute(texts)
    monkeypatch.setattr(co, "HOT_SHARE", 10**6)
    monkeypatch.setattr(co, "CHUNK", 500)
    assert all(co.hot_prefixes(co.prepared(table(spark, texts))))
    assert got(co.report(table(spark, texts))) == want
    monkeypatch.setattr(co, "hot_prefixes", lambda *a: [[], []])
    assert got(co.report(table(spark, texts))) == want


def test_clashing_words_are_told_apart(spark, texts, monkeypatch):
    plain = co.code

    def narrow(lang, word, clashing=()):
        """Two common words get one hash, unless they are known to clash."""
        out = F.when(word == "york", plain(lang, F.lit("new"))).otherwise(plain(lang, word))
        for a, w in clashing:
            out = F.when((lang == a) & (word == w), F.xxhash64(F.lit("again"), lang, word)).otherwise(out)
        return out

    monkeypatch.setattr(co, "code", narrow)
    assert co.dictionary(co.prepared(table(spark, texts)))[1]
    assert got(co.report(table(spark, texts))) == brute(texts)


def test_products_beyond_64_bits_are_exact(spark):
    big = 10**13
    found = spark.createDataFrame([([1, 2], 9 * big + 1)], "words array<long>, f long")
    singles = spark.createDataFrame([([1], 10 * big), ([2], 9 * big + 7)], "words array<long>, f long")
    r = co.scored(found, singles).first()
    assert r["score"] == 2_000_000 * (9 * big + 1) // (19 * big + 7)


def test_ties_fall_to_the_shortest_first_part(spark):
    found = spark.createDataFrame([([1, 2, 3], 30), ([1, 2], 60), ([2, 3], 45)], "words array<long>, f long")
    singles = spark.createDataFrame([([1], 75), ([2], 90), ([3], 60)], "words array<long>, f long")
    r = co.scored(found, singles).filter(F.size("words") == 3).first()
    assert (r["score"], r["l"], r["r"]) == (500_000, 75, 45)


def test_empty_tables(spark):
    assert co.report(table(spark, [])).count() == 0
    assert co.report(table(spark, [(None, None), ("", "en"), ("one", "en")])).count() == 0


def test_windows_do_not_cross_pieces():
    import numpy as np

    counted = co.counted_windows(np.array([1, 2, 3, 0, 4, 0, 1, 2, 3, 9, 0, 1, 2, 3], np.int64)).to_pylist()
    assert sorted(tuple(r.values()) for r in counted) == [
        (1, 2, 3, 0, 2), (1, 2, 3, 9, 1), (2, 3, 0, 0, 2), (2, 3, 9, 0, 1), (3, 9, 0, 0, 1),
    ]


def test_a_full_filter_changes_nothing(spark, texts, monkeypatch):
    """However many rare pairs the filter lets through, the phrases are the same."""
    import numpy as np

    monkeypatch.setattr(co, "frequent_pairs", lambda *a: np.full(co.FILTER_BITS // 64, 2**64 - 1, np.uint64))
    assert got(co.report(table(spark, texts))) == brute(texts)
    few = co.FILTER_BITS
    monkeypatch.undo()
    monkeypatch.setattr(co, "FILTER_BITS", 64)
    assert few > 64 and got(co.report(table(spark, texts))) == brute(texts)
