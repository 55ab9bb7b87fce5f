from __future__ import annotations

from llm_support import documents, sf_dir, workers  # noqa: F401

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from pitlake.llm import exact, quality
from pitlake.plans.scratch import staged

import __spark_entry__ as entry


def test_stages_in_order_and_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "simhash_near_dedup", "mixing_to_targets", "byte_bpe"
    ]
    names = entry.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))


@pytest.fixture(scope="module")
def stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], sf_dir), name))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns_of_documents_until_the_last(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_quality_keeps_good_and_drops_bad(spark, stages):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = labels.join(stages[1], "doc_id", "left_semi").groupBy("quality").count().collect()
    kept, total = {r[0]: r[1] for r in kept}, {r[0]: r[1] for r in labels.groupBy("quality").count().collect()}
    assert kept.get(0, 0) <= 0.1 * total[0] and kept[1] >= 0.97 * total[1]


def test_exact_stage_keeps_one_of_each_text(stages):
    norm = exact.normalised(F.col("text"))
    assert stages[2].count() == stages[1].select(norm).distinct().count() == stages[2].select(norm).distinct().count()
    first = stages[1].groupBy(norm).agg(F.min("doc_id").alias("doc_id"))
    assert ids(stages[2]) == ids(first)


def test_near_stage_keeps_the_first_of_each_group(stages):
    """Against all pairs: what is clearly similar goes, what is clearly not stays."""
    texts = {r.doc_id: r.text for r in stages[2].select("doc_id", "text").collect()}
    kept, sets, near, apart = ids(stages[3]), {}, set(), set(texts)
    for i, text in texts.items():
        words = text.lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    order = sorted(sets)
    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            if min(len(sets[a]), len(sets[b])) < 0.6 * max(len(sets[a]), len(sets[b])):
                continue
            both = len(sets[a] & sets[b])
            similarity = both / (len(sets[a]) + len(sets[b]) - both)
            if similarity >= 0.85:
                near.add(b)
            if similarity >= 0.7:
                apart -= {a, b}
    assert len(near & kept) <= 0.05 * len(near) and apart <= kept


def test_mixing_keeps_every_document_and_raises_small_languages(stages):
    assert ids(stages[4]) == ids(stages[3])
    size = [{r.lang: r.n for r in s.groupBy("lang").agg(F.sum("n_chars").alias("n")).collect()} for s in stages[3:5]]
    assert size[1]["en"] / sum(size[1].values()) < size[0]["en"] / sum(size[0].values())


def test_tokens_decode_to_the_text(stages):
    assert stages[5].count() == stages[4].count() and stages[5].filter("NOT round_trip").count() == 0


def test_odd_tables_pass_every_stage(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, words int, whole int, file int"
    rows = [(1, None, None, None, None, 0.0, 1, 1, 1), (None, "", "en", "s", 0, None, 1, 1, 1)]
    rows += [(2, "plain words in a row " * 3000, "en", "s", 1, 1.0, 1, 1, 1)] * 2 + [(3, "other words", "de", "s", 1, 1.0, 1, 1, 1)]
    spark.createDataFrame([(2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    full = spark.createDataFrame(rows, schema)
    for docs in (full, full.limit(0)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, staged(stage(spark, docs, str(tmp_path)), name)
            if name != "byte_bpe":
                assert docs.columns == before.columns
        assert (docs.count() > 0) == (n > 0)
    assert quality.THRESHOLD == 0.3
