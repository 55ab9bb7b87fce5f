from __future__ import annotations

import sys
import tempfile
from datetime import UTC, date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pitlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root():
    """A fresh scratch folder."""
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def d(text: str) -> date:
    return date.fromisoformat(text)


def at(text: str) -> datetime:
    """A UTC instant as Spark returns it in a UTC session: naive."""
    return datetime.fromisoformat(text)


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def rows(df, *columns):
    """Sorted tuples of a small result."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [str(x) for x in r])
