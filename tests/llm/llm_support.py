from __future__ import annotations

import pytest

from pitlake.llm.common import reach_workers


@pytest.fixture(autouse=True)
def workers(spark):
    reach_workers(spark)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """Builds a documents table from (doc_id, text) with all columns."""
    def build(rows, source="s"):
        rows = [(i, t, "en", source, len(t or "")) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return build
