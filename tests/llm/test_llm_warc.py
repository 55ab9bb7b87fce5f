from __future__ import annotations

from llm_support import documents, sf_dir, workers  # noqa: F401

import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from pitlake.llm import warc
from pitlake.plans.scratch import scratch


def page(k, body=b"<p>body</p>"):
    return warc.page_record(str(k), f"http://x/{k} y\n", body, hashlib.sha256(body).hexdigest(), None, "1970-01-01T00:00:00Z")


def walk(data):
    return list(warc.salvage(warc.Window(io.BytesIO(data).read)))


def ids(found):
    return [x.headers["warc-record-id"][14:-1] for x in found if isinstance(x, warc.Record)]


def gaps(found):
    return [(x.start, x.end) for x in found if isinstance(x, warc.Gap)]


@pytest.mark.parametrize("pack", [warc.member, bytes])
def test_whole_archives(pack):
    parts = [pack(page(k, bytes([k]) * 5000)) for k in range(30)]
    found = walk(b"".join(parts))
    assert ids(found) == [str(k) for k in range(30)] and not gaps(found)
    assert all(warc.payload_of(x) == (bytes([k]) * 5000, 5000) for k, x in enumerate(found))


@pytest.mark.parametrize("pack", [warc.member, bytes])
@pytest.mark.parametrize("damage", ["cut", "flip", "insert", "head", "tail"])
def test_damage_costs_what_is_damaged(pack, damage):
    random.seed(8)
    parts = [pack(page(k, random.randbytes(300_000))) for k in range(6)]
    starts = [sum(map(len, parts[:k])) for k in range(7)]
    if damage == "cut":
        parts[2] = parts[2][: len(parts[2]) // 2]
    elif damage == "flip":
        parts[2] = parts[2][:5000] + bytes([parts[2][5000] ^ 255]) + parts[2][5001:]
    elif damage == "insert":
        parts[2] = b"\x1f\x8b\x08junk WARC/1.0 junk" + parts[2]
    elif damage == "head":
        parts[0] = parts[0][30:]
    else:
        parts[5] = parts[5][:-30]
    found = walk(b"".join(parts))
    lost = {"cut": ["2"], "flip": ["2"], "insert": [], "head": ["0"], "tail": ["5"]}[damage]
    assert ids(found) == [str(k) for k in range(6) if str(k) not in lost]
    bad = 0 if damage == "head" else 5 if damage == "tail" else 2
    expected = (starts[bad], starts[bad] + (21 if damage == "insert" else len(parts[bad])))
    assert gaps(found) == [expected] or sum(b - a for a, b in gaps(found)) == expected[1] - expected[0]


def test_bad_record_inside_a_member():
    good, bad = page(1), page(2).replace(b"<p>body", b"<p>BODY")
    found = walk(warc.member(good + bad + page(3)) + warc.member(page(4)))
    assert ids(found) == ["1", "3", "4"]
    assert [x.reason for x in found if isinstance(x, warc.Gap)][0].startswith("in member")


def test_junk_and_empty_archives():
    assert walk(b"") == []
    assert gaps(walk(b"no archive at all")) == [(0, 17)]


def test_write_read_and_revisits(spark):
    long = "x" * 200
    rows = [(3, "u3", long, 1), (1, "ü\n", long, 1), (2, None, "short", 1), (4, None, "short", 1), (5, "u", None, 1),
            (None, "u", long, 1), (6, "u", "ü" * 100_000, 1), (3, "u3", long, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int").repartition(3)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.report(pages).collect()), key=str)
    assert got == sorted([
        (3, "revisit", 1, 200), (3, "revisit", 1, 200), (1, "response", None, 200), (2, "response", None, 5),
        (4, "response", None, 5), (5, "response", None, 0), (None, "revisit", 1, 200), (6, "response", None, 200_000),
    ], key=str)
    digests = {r.payload_digest for r in warc.report(pages).filter("page_id in (1, 3)").collect()}
    assert digests == {hashlib.sha256(long.encode()).hexdigest()}
    assert warc.report(pages.limit(0)).count() == 0


def test_archives_roll_over_and_gaps_are_rows(spark):
    pages = spark.createDataFrame([(k, "u", str(k) * 500) for k in range(20)], "page_id long, url string, html string")
    made = warc.write(pages.coalesce(1), scratch(spark, "warc"), archive_bytes=500)
    assert made.count() > 3
    path = made.orderBy("path").first()["path"].removeprefix("file://").removeprefix("file:")
    data = bytearray(open(path, "rb").read())
    data[-20] ^= 255
    with open(path, "wb") as out:
        out.write(data)
    found = warc.read(made)
    assert found.filter("gap IS NOT NULL").count() == 1
    assert found.filter("record_type = 'response'").count() == 19


def test_archives_are_read_in_as_many_tasks(spark):
    rows = [(k, "u", str(k) * 500, "x", 1) for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, path string, payload int")
    made = warc.write(pages.coalesce(1), scratch(spark, "warc"), archive_bytes=1)
    assert made.count() == 40
    tasks = warc.read(made).select("path", F.spark_partition_id().alias("task")).distinct().collect()
    assert len({r.path for r in tasks}) == 40 and len({r.task for r in tasks}) == 40
