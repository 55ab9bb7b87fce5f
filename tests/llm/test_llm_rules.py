from __future__ import annotations

from llm_support import documents, sf_dir, workers  # noqa: F401

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from pitlake.llm import rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    n = Counter(windows)
    hit = {k + o for k, x in enumerate(windows) if n[x] > 1 for o in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
        len(w) < 10 or 100 * len(hit) > 20 * len(w),
    )


def test_base_counts(documents):
    random.seed(6)
    texts = [None, "", " \n\t", "a b c d e a b c d e", "x " * 2000, "é# |ü\nl1\nl1\n \nl1 ", "word " * 30_000]
    texts += [" ".join(random.choice("abc") for _ in range(random.randrange(60))) for _ in range(60)]
    docs = documents(list(enumerate(texts))).withColumn("uid", F.lit(1)).withColumn("lines", F.lit(2))
    for r in rules.judged(docs).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(texts[r.doc_id])


def make(documents):
    rows = []
    for i in range(40):
        own = " ".join(chr(97 + i % 26) + chr(97 + i // 26) + chr(97 + k) for k in range(20))
        rows.append((i, f"Shared LINE  of page {i % 10}\nown words {own}"))
    rows += [(100 + i, "shared line of page 3\n" * 4 + str(i) * (i > 0)) for i in range(3)]
    return rows


def test_lines_over_a_limit_go_and_depleted_documents_with_them(documents):
    docs = documents(make(documents))
    got = {r.doc_id: r for r in rules.judged(docs, max_docs=10, max_share=0.2, min_left_share=0.3).collect()}
    # digits are read as 0, so all forty first lines are one line
    assert all(got[i].n_removed_words == 5 and got[i].kept for i in range(40))
    assert all(got[100 + i].n_removed_words == 20 and not got[100 + i].kept for i in range(3))
    loose = rules.judged(docs, max_docs=100, max_share=1.0).filter("n_removed_words > 0")
    assert loose.count() == 0
    # either limit is enough
    for limits in ({"max_docs": 10, "max_share": 1.0}, {"max_docs": 100, "max_share": 0.2}):
        assert rules.judged(docs, **limits).filter("n_removed_words > 0").count() == 43


def test_limits_hold_at_every_host_size(documents):
    """A line on all pages of a host of eight goes, and one on 60 pages of a host of 400."""
    def pages(first, n, shared, on):
        own = lambda i: " ".join(chr(97 + i % 26) + chr(97 + i // 26 % 26) + chr(97 + i // 676) + chr(97 + k) for k in range(20))
        return [(first + i, own(first + i) + (f"\n{shared}" if i < on else "")) for i in range(n)]

    host = F.when(F.col("doc_id") < 100, "small").when(F.col("doc_id") < 1000, "large").otherwise("rare")
    docs = documents(pages(0, 8, "all of us say this", 8) + pages(100, 400, "some of us say this", 60) + pages(1000, 8, "few say this", 4))
    docs = docs.withColumn("source", host)
    gone = {r.doc_id for r in rules.judged(docs).filter("n_removed_words > 0").collect()}
    assert gone == {*range(8), *range(100, 160)}


def test_what_is_left_must_pass_the_base_rule(documents):
    rows = [(i, f"only nine words here of my own {chr(97 + i)} yes\nthe same line of boilerplate on every page of this host") for i in range(9)]
    assert [r.kept for r in rules.judged(documents(rows)).collect()] == [False] * 9
    longer = [(i, t + f"\nand some more words {chr(97 + i)}") for i, t in rows]
    kept = rules.judged(documents(longer), max_share=0.9).collect()
    assert all(r.kept for r in kept)


def test_copies_and_other_hosts_do_not_make_a_line_frequent(documents):
    copied = documents([(i, "the very same text on one line, nothing else, ten words long") for i in range(30)])
    assert rules.judged(copied, max_docs=5, max_share=0.0).filter("kept").count() == 30
    apart = documents([(i, f"same line of five words\n{' '.join('abcdefghijkl')} {chr(97 + i)}") for i in range(20)])
    apart = apart.withColumn("source", F.concat(F.lit("h"), F.col("doc_id")))
    assert rules.judged(apart, max_docs=5, max_share=0.0).filter("n_removed_words > 0").count() == 0
    one = apart.withColumn("source", F.lit(None).cast("string"))
    assert rules.judged(one, max_docs=5, max_share=0.0).filter("n_removed_words = 5").count() == 20


def test_nulls_repeated_rows_and_empty_table(documents):
    docs = documents([(None, None), (1, "a"), (1, "a")])
    assert sorted((r.doc_id or -1, r.n_words, r.kept) for r in rules.judged(docs).collect()) == [
        (-1, 0, False), (1, 1, False), (1, 1, False)
    ]
    assert rules.judged(documents([])).count() == 0


def test_no_python_on_the_main_path(documents):
    plan = rules.judged(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_documents_that_differ_in_digits_or_case_are_documents(documents):
    """Pages of one template: each is a document; exact copies of one still count once."""
    rows = [(i, f"Item {i} costs {2 * i}\nsold by the one shop of this town") for i in range(30)]
    rows += [(100 + i, rows[3][1]) for i in range(30)]
    got = rules.judged(documents(rows), max_docs=29, max_share=0.5)
    assert got.filter("n_removed_words > 0").count() == 60
    assert got.count() == 60 and rules.judged(documents(rows), max_docs=30, max_share=1.0).filter("n_removed_words > 0").count() == 0


def test_removed_lines_are_cut_out_of_the_text(documents):
    rows = make(documents) + [(200, None), (201, "\n own  Words\tonly, \n\nSHARED line of   page 7 \nten or more words are in here, so it stays\n")]
    docs = documents(rows).withColumn("uid", F.lit(1)).withColumn("lines", F.lit(2))
    limits = dict(max_docs=10, max_share=0.2, min_left_share=0.3)
    judged = {r.doc_id: r for r in rules.judged(docs, **limits).collect()}
    out = rules.cleaned(docs, **limits)
    got = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == docs.columns and set(got) == {i for i, r in judged.items() if r.kept}
    assert got[201] == "\n own  Words\tonly, \n\nten or more words are in here, so it stays\n"
    assert all(got[i] == dict(rows)[i].split("\n")[1] for i in range(40))
    assert all(len(WORD.findall(t)) == judged[i].n_words - judged[i].n_removed_words for i, t in got.items())


def test_the_sql_says_the_same(spark, documents, tmp_path):
    """Template pages that differ in numbers, exact copies, small and large hosts, through SQL and Spark."""
    import duckdb

    rows = [(i, f"Item {i} costs {2 * i}\nsold by the one shop of this town\nand here are some words of its own {chr(97 + i % 26)}") for i in range(80)]
    rows += [(100 + i, rows[3][1]) for i in range(60)]
    rows += [(200 + i, f"a page of a small host\nwith the very same second line\nfollowed by words {i} which are its own alone") for i in range(7)]
    rows += [(300, None), (301, ""), (302, "x " * 300), (303, "\n\n same line \n same line\t\n")] + make(documents)[:40]
    rows = [(1000 + i if k >= 151 else i, t) for k, (i, t) in enumerate(rows)]
    docs = documents(rows).withColumn("source", F.when(F.col("doc_id").between(200, 299), "small").when(F.col("doc_id") >= 1000, None).otherwise("big"))
    docs.toPandas().to_parquet(tmp_path / "d.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d.parquet'")
    want = con.execute(rules.ORACLE).df()
    got = rules.judged(docs).toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))
    assert (want.n_removed_words > 0).sum() > 100
