from __future__ import annotations

from llm_support import documents, sf_dir, workers  # noqa: F401

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from pitlake.llm import repeats

W = repeats.WIDTH


def brute(rows):
    seen, out = {}, {}
    for doc, text in sorted(rows):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - W + 1):
            if seen.setdefault(raw[k : k + W], (doc, k)) != (doc, k):
                gone[k : k + W] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone, [0]]).astype(int)) == 1).sum())
        out[doc] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def some_rows(n=120):
    random.seed(3)
    parts = ["".join(random.choice("ab cé") for _ in range(random.randrange(60, 300))) for _ in range(6)]
    parts += ["x" * 500, "ab" * 200, "short"]
    rows = [(k, "".join(random.choice([*parts, str(random.random())]) for _ in range(random.randrange(8)))) for k in range(n)]
    return [*rows, (n, None), (n + 1, "y" * 60_000), (n + 2, "")]


def result(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_against_brute_force(documents):
    rows = some_rows()
    assert result(repeats.report(documents(rows).repartition(5))) == brute(rows)


def test_shards_and_long_anchors_in_process(monkeypatch):
    rows = some_rows(80)
    for shard, long in ((1 << 20, 4 << 20), (2000, 4 << 20), (2000, 1500)):
        monkeypatch.setattr(repeats, "SHARD_BYTES", shard)
        monkeypatch.setattr(repeats, "LONG_BYTES", long)
        docs = pa.RecordBatch.from_pydict({"doc": [r[0] for r in rows], "text": [r[1] for r in rows]})
        order = [(c, "ascending") for c in repeats.FOUND.fieldNames()]
        found = pa.Table.from_batches(list(repeats.find_anchors(iter([docs])))).sort_by(order)
        told = [r for b in repeats.sort_out(iter(found.to_batches(max_chunksize=7))) for r in b.to_pylist()]
        marks = [r for r in told if r["anchor"] is None]
        by_doc = {}
        for r in told:
            if r["anchor"] is not None:
                by_doc.setdefault(r["doc"], []).append(r)
        joined = pa.RecordBatch.from_pydict({
            "doc": list(by_doc), "text": [dict(rows)[d] for d in by_doc],
            **{c: [[r[c] for r in own] for own in by_doc.values()] for c in ("anchor", "start", "n")},
        })
        cut = list(repeats.cut_contexts(iter([joined])))
        bodies = pa.Table.from_batches(cut).sort_by("anchor")
        out = [r for b in repeats.compare(iter(bodies.to_batches(max_chunksize=11))) for r in b.to_pylist()]
        marks += [r for r in out if r["body"] is None]
        left = [r for r in out if r["body"] is not None]
        assert bool(left) == (long == 1500)
        if left:
            batch = repeats._contexts([tuple(r[c] for c in ("anchor", "doc", "start", "n", "body")) for r in left])
            first = {}
            hashed = [r for b in repeats.window_hashes(iter([batch])) for r in b.to_pylist()]
            for r in hashed:
                key, here = (r["anchor"], r["doc"]), (r["start"], r["n"])
                first[key] = min(here, first.get(key, here))
            marks += [
                {"doc": r["start"], "start": r["n"], "n": 1} for r in hashed
                if first[r["anchor"], r["doc"]] != (r["start"], r["n"])
            ]
        want = brute(rows)
        for doc, text in rows:
            own = [(m["start"], m["n"]) for m in marks if m["doc"] == doc]
            size = len((text or "").encode())
            gone = repeats.covered(size, np.array([o[0] for o in own], int), np.array([o[1] for o in own], int))
            assert int(gone.sum()) == want[doc][1]


@pytest.mark.parametrize("seed", range(3))
def test_statistics_are_the_longest_matches(seed):
    random.seed(seed)
    base = "".join(random.choice("abc") for _ in range(400))
    texts = [(base[: k * 37] + "d" + base[k * 11 :]).encode() for k in range(8)]
    index = repeats.RunIndex(texts)
    assert index.runs < index.length / 4  # repetitive texts have few runs
    agree, above = index.statistics()
    marks = {}
    whole = b"".join(t + bytes([200 + k]) for k, t in enumerate(texts))
    for p in range(len(whole)):
        q = above[p]
        if q >= 0:
            k = 0
            while p + k < len(whole) and q + k < len(whole) and whole[p + k] == whole[q + k] and whole[p + k] < 200:
                k += 1
            assert agree[p] == k
    for p in range(len(whole) - W):
        window = whole[p : p + W]
        if max(window) < 200:
            marks.setdefault(window, []).append(p)
    assert sorted(index.repeats().tolist()) == sorted(p for at in marks.values() for p in at[1:])


def test_shared_identifiers_nulls_and_empty_table(documents):
    long = "".join(random.Random(1).choices("abcdef ", k=400))
    rows = [(1, long), (1, long), (2, long), (None, long), (None, None)]
    docs = documents(rows)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in repeats.report(docs).collect()), key=str)
    assert got == sorted([(1, 400, 0), (1, 400, 0), (2, 400, 400), (None, 400, 400), (None, 0, 0)], key=str)
    assert repeats.report(documents([])).count() == 0
    spans = repeats.remove_repeats(documents([(1, long), (2, "x" + long + "y")])).collect()
    assert {tuple(r.spans) for r in spans} == {(), (1, 401)}
