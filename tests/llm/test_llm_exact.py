from __future__ import annotations

from llm_support import documents, sf_dir, workers  # noqa: F401

import hashlib
import random
import re

from pyspark.sql import functions as F

from pitlake.llm import exact


def brute(rows):
    norm = {k: re.sub("[\x20\x09-\x0d]+", " ", t or "") for k, (_, t) in enumerate(rows)}
    groups: dict[str, list[int]] = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(norm[k], []).append(i)
    key = lambda i: (i is None, i or 0)
    return sorted(
        (
            (i, min(groups[norm[k]], key=key), len(groups[norm[k]]), hashlib.sha256(norm[k].encode()).hexdigest())
            for k, (i, _) in enumerate(rows)
        ), key=str,
    )


def result(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


def some_rows():
    random.seed(2)
    texts = ["a b", "a  b", "a\tb", " a b", "", None, "   ", "x" * 50_000, "é ü", "a b"]
    return [(i, random.choice(texts)) for i in range(60)] + [(None, "a b"), (None, "only here"), (7, "a b")]


def test_against_brute_force_over_several_batches(documents):
    rows = some_rows()
    docs = documents(rows).repartition(7)
    groups = exact.exact_groups(docs, files_per_batch=1)
    got = groups.select(
        F.col("id").alias("doc_id"), F.col("first.id").alias("keep_id"), F.col("members").alias("group_size"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
    assert result(got) == brute(rows)
    assert groups.filter(exact.is_kept()).count() == len({r[3] for r in brute(rows)})


def test_colliding_digests_are_told_apart_by_their_bytes(documents):
    rows = some_rows()
    weak = exact.exact_groups(documents(rows), digest=lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 1)))
    got = [(r.id, r["first"]["id"], r.members) for r in weak.collect()]
    assert sorted(got, key=str) == sorted(((a, b, c) for a, b, c, _ in brute(rows)), key=str)


def test_report_and_empty_table(documents):
    rows = some_rows()
    assert result(exact.report(documents(rows))) == brute(rows)
    assert exact.report(documents([])).count() == 0


def test_deduplicate_keeps_columns_whatever_their_names(spark, documents):
    docs = documents(some_rows()).withColumn("file", F.lit("f")).withColumn("row", F.lit(1)).withColumn("digest", F.lit(2))
    got = exact.deduplicate(docs)
    assert got.columns == docs.columns
    assert got.count() == len({r[3] for r in brute(some_rows())})
    path = spark.conf.get("spark.checkpoint.dir") + "/exact-input"
    docs.write.mode("overwrite").parquet(path)
    assert exact.deduplicate(spark.read.parquet(path)).count() == got.count()


def test_no_python_on_the_main_path(documents):
    plan = exact.report(documents([(1, "a"), (2, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
