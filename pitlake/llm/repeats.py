"""Removing repeated byte strings with run-length indexes.

A byte goes if a string of WIDTH bytes covering it also starts earlier, in a document with a smaller
identifier or before it in the same document; strings never cross documents.

1. Every window of WIDTH bytes has an anchor, the first of its grams with the least hash, which depends on
   nothing but its bytes. Neighbouring windows with the same gram for anchor form a context. Equal windows have equal anchors,
   so only contexts whose anchor occurs again can repeat anything.
2. A context travels as anchor, 64-bit digest of its windows and place. Of contexts equal in both hashes
   all windows repeat but those of the first.
3. Where an anchor has different contexts, the first of each is cut from its text; they meet in a shard. A shard of about SHARD_BYTES is put in suffix order
   and kept as the runs of its Burrows-Wheeler transform with a sample at the head of each run: the
   suffix there, its predecessor in the order, and how far the two agree. From the samples alone the
   matching statistics of all other positions follow in text order, each one less than the position
   before. Positions that agree with their predecessor for WIDTH bytes are one class with it; all but
   the first of a class repeat.
4. Marked windows go back to their documents, where what they cover is cut.

An anchor with more than LONG_BYTES of different contexts doesn't fit a shard; its windows are grouped by
a 128-bit hash of their bytes instead, counted before the shuffle, so no anchor is ever dropped.

Null texts are empty. Rows that share an identifier count as one document: a string at the same place in
two of them is one occurrence. Null identifiers are one document, the last one. An empty table gives an
empty result; texts shorter than WIDTH keep all bytes. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.plans.scratch import staged

WIDTH = 100
#: Bytes of a gram; a window has WIDTH - GRAM + 1 of them. A power of two.
GRAM = 32
SHARD_BYTES = 1 << 20
LONG_BYTES = 4 << 20
LAST = (1 << 63) - 1

U64 = np.uint64
FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor", "digest", "doc", "place")])
PLACED = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor", "doc", "start", "n")])
CONTEXTS = T.StructType([*PLACED.fields, T.StructField("body", T.BinaryType())])


def gram_hashes(raw: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of the `size` bytes from each position on; `size` is a power of two."""
    h = (raw.astype(U64) + U64(salt + 1)) * U64(0x9E3779B97F4A7C15)
    h ^= h >> U64(29)
    step = 1
    while step < size:
        right = h[step:]
        h = (h[:-step] * U64(0xD6E8FEB86659FD93)) ^ (right + (right >> U64(31)))
        h ^= h >> U64(32)
        step *= 2
    return h * U64(0x9E3779B97F4A7C15)


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    rest = width - step
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


#: Weights of the parts of a window, and of the windows of a context, in its digest.
PARTS = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
WEIGHTS = np.cumprod(np.full(WIDTH, 0x2545F4914F6CDD1D, U64))


def window_digests(grams: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the WIDTH bytes from each position on, from the hashes of the grams in them."""
    n = len(grams) - (WIDTH - GRAM)
    at = [*range(0, WIDTH - GRAM, GRAM), WIDTH - GRAM]
    mixed = sum(grams[o : o + n] * w for o, w in zip(at, PARTS, strict=True))
    return (mixed ^ (mixed >> U64(29))) * PARTS[1]


def anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, digest, first window and number of windows of each context of a text."""
    if len(raw) < WIDTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    grams = gram_hashes(raw, GRAM)
    least = sliding_min(grams, WIDTH - GRAM + 1)
    # another gram: the value differs, or the one that was least stood at the start of the window before
    moves = (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1])
    starts = np.concatenate([[0], np.flatnonzero(moves) + 1])
    size = np.diff(np.append(starts, len(least)))
    within = np.arange(len(least)) - np.repeat(starts, size)
    digest = np.add.reduceat(window_digests(grams) * WEIGHTS[within], starts)
    return least[starts].view(np.int64), digest.view(np.int64), starts, size


def raw_text(value: pa.Scalar) -> bytes:
    return (value.as_py() or "").encode("utf-8", "replace")


def _longs(schema: T.StructType, *columns: np.ndarray | pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=schema.fieldNames())


def settle(anchor: np.ndarray, digest: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of equal contexts seen together, later ones are settled: they repeat whatever else comes.

    A settled row has its place negated and, for an anchor, a mix of document and place, which deals it
    anywhere: a passage that a third of all documents hold doesn't meet in one task.
    """
    order = np.lexsort((place, doc, digest, anchor))
    anchor, digest, doc, place = anchor[order], digest[order], doc[order], place[order]
    fresh = np.append(True, (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1]))
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    settled = (doc[first] != doc) | (place[first] != place)
    mixed = (doc[settled].view(U64) * PARTS[0]) ^ (place[settled].view(U64) * PARTS[1])
    anchor[settled], place[settled] = (mixed * PARTS[3]).view(np.int64), ~place[settled]
    return anchor, digest, doc, place


def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text) to contexts without their bytes; a place is the first window and, in 8 bits, how many."""
    for batch in batches:
        held, count = [], 0
        for k, doc in enumerate(batch.column(0).to_pylist()):
            anchor, digest, start, n = anchors(np.frombuffer(raw_text(batch.column(1)[k]), np.uint8))
            held.append((anchor, digest, np.full(len(anchor), doc), start << 8 | n))
            count += len(anchor)
            if count > 100_000:
                yield _longs(FOUND, *settle(*map(np.concatenate, zip(*held, strict=True))))
                held, count = [], 0
        if held:
            yield _longs(FOUND, *settle(*map(np.concatenate, zip(*held, strict=True))))


def sort_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by all columns to windows that repeat (no anchor), and the contexts whose bytes have
    to be compared (with anchor). One row is carried from batch to batch, never a group."""
    first = np.zeros((0, 4), np.int64)  # of the current equal contexts
    told = False  # whether its bytes have been asked for
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([np.asarray(c) for c in batch.columns], axis=1)
        settled = rows[rows[:, 3] < 0]
        if len(settled):
            yield _longs(
                PLACED, pa.nulls(len(settled), pa.int64()), settled[:, 2], ~settled[:, 3] >> 8, ~settled[:, 3] & 255
            )
        rows = np.concatenate([first, rows[rows[:, 3] >= 0]])
        if not len(rows):
            continue
        fresh = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))
        heads = np.flatnonzero(fresh)
        own = rows[heads[np.cumsum(fresh) - 1]]
        repeats = rows[(own[:, 2:] != rows[:, 2:]).any(axis=1)]
        if len(repeats):
            yield _longs(
                PLACED, pa.nulls(len(repeats), pa.int64()), repeats[:, 2], repeats[:, 3] >> 8, repeats[:, 3] & 255
            )
        heads = rows[heads]
        same = heads[1:, 0] == heads[:-1, 0]
        asked = np.append(False, same) | np.append(same, False)
        asked_before = np.zeros(len(heads), bool)
        asked_before[0] = told and len(first) > 0
        ask = heads[asked & ~asked_before]
        if len(ask):
            yield _longs(PLACED, ask[:, 0], ask[:, 2], ask[:, 3] >> 8, ask[:, 3] & 255)
        first, told = heads[-1:], bool(asked[-1] or asked_before[-1])


def _contexts(rows: list[tuple[int, int, int, int, bytes | None]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.binary())],
        names=CONTEXTS.fieldNames(),
    )


def cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, anchors, starts, counts) to contexts with their bytes."""
    for batch in batches:
        rows = []
        for k, doc in enumerate(batch.column(0).to_pylist()):
            raw = raw_text(batch.column(1)[k])
            for anchor, start, n in zip(*(batch.column(c)[k].as_py() for c in (2, 3, 4)), strict=True):
                body = raw[start : start + n + WIDTH - 1]
                if len(body) == n + WIDTH - 1:  # else it is of another row with this identifier
                    rows.append((anchor, doc, start, n, body))
            if len(rows) > 20_000:
                yield _contexts(rows)
                rows = []
        if rows:
            yield _contexts(rows)


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; every suffix is unique since every context ends in its own symbol."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(2, np.int64)])
    key = (padded[:n] << 40) | (padded[1 : n + 1] << 20) | padded[2 : n + 2]
    depth = 3
    while True:
        order = np.argsort(key, kind="stable")
        fresh = np.append(True, key[order[1:]] != key[order[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if fresh.all():
            return order
        key = rank << 32
        key[:-depth] |= rank[depth:]
        depth *= 2


class RunIndex:
    """The Burrows-Wheeler transform of texts as runs, with samples at run heads.

    `head` and `above` are the sampled suffixes and their predecessors in suffix order, sorted by place in
    the text, `agree` is how many symbols the two share.
    """

    def __init__(self, texts: list[bytes]):
        size = np.array([len(t) + 1 for t in texts])
        ends = np.cumsum(size) - 1
        symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + len(texts) + 1
        symbols[ends] = np.arange(1, len(texts) + 1)
        self.length, self.starts = len(symbols), ends + 1 - size
        order = suffix_order(symbols)
        last_column = symbols[order - 1]
        heads = np.flatnonzero(np.append(True, last_column[1:] != last_column[:-1]))
        self.runs = len(heads)
        head, above = order[heads], np.where(heads > 0, order[heads - 1], -1)
        by_place = np.argsort(head)
        self.head, self.above = head[by_place], above[by_place]
        self.agree = self._agreement(symbols, self.head, self.above)

    @staticmethod
    def _agreement(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        live = np.flatnonzero(b >= 0)
        reach = 0
        while len(live):
            at_a, at_b = a[live] + reach, b[live] + reach
            inside = (at_a < len(symbols)) & (at_b < len(symbols))
            live, at_a, at_b = live[inside], at_a[inside], at_b[inside]
            live = live[symbols[at_a] == symbols[at_b]]
            reach += 1
            out[live] = reach
        return out

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For every position in text order, how far it agrees with its predecessor, and where that is."""
        sample = np.zeros(self.length, np.int64)
        sample[self.head] = np.arange(len(self.head))
        sample = np.maximum.accumulate(sample)
        past = np.arange(self.length) - self.head[sample]
        return self.agree[sample] - past, self.above[sample] + past

    def repeats(self) -> np.ndarray:
        """Positions whose WIDTH bytes also start at an earlier position."""
        agree, above = self.statistics()
        joined = agree >= WIDTH
        root = np.where(joined, above, np.arange(self.length))
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further
        member = np.flatnonzero(joined)
        first = np.arange(self.length)
        np.minimum.at(first, root[member], member)
        whole = np.concatenate([member, root[member]])
        whole = np.unique(whole)
        return whole[whole != first[root[whole]]]


def shard_repeats(contexts: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int]]:
    """(doc, start, n) of repeated windows among different contexts (doc, start, n, body)."""
    contexts = sorted(contexts)
    index = RunIndex([c[3] for c in contexts])
    at = index.repeats()
    if not len(at):
        return []
    own = np.searchsorted(index.starts, at, "right") - 1
    place = at - index.starts[own]
    begins = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(own) != 0)))
    size = np.diff(np.append(begins, len(at)))
    return [
        (contexts[o][0], contexts[o][1] + p, n)
        for o, p, n in zip(own[begins].tolist(), place[begins].tolist(), size.tolist(), strict=True)
    ]


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by anchor to repeated windows (no body), and contexts of anchors too long for a shard."""
    shard: list[tuple[int, int, int, bytes]] = []
    out: list[tuple] = []
    shard_size = 0
    anchor, group, group_size, too_long = None, {}, 0, False

    def close_group() -> None:
        nonlocal shard_size
        if len(group) > 1:
            shard.extend((*where, body) for body, where in group.items())
            shard_size += group_size

    for batch in batches:
        keys = batch.column(0).to_pylist()
        for k, key in enumerate(keys):
            if key != anchor:
                if not too_long:
                    close_group()
                if shard_size >= SHARD_BYTES:
                    out += [(0, *r, None) for r in shard_repeats(shard)]
                    shard, shard_size = [], 0
                anchor, group, group_size, too_long = key, {}, 0, False
            here = tuple(batch.column(c)[k].as_py() for c in (1, 2, 3))
            body = batch.column(4)[k].as_py()
            if too_long:
                out.append((key, *here, body))
                continue
            there = group.get(body)
            if there is None:
                group[body] = here
                group_size += len(body)
                if group_size > LONG_BYTES:
                    out += [(key, *where, b) for b, where in group.items()]
                    group, group_size, too_long = {}, 0, True
            elif there != here:
                group[body] = min(here, there)
                out.append((0, *max(here, there), None))
            if len(out) > 20_000:
                yield _contexts(out)
                out = []
    if not too_long:
        close_group()
    if shard:
        out += [(0, *r, None) for r in shard_repeats(shard)]
    if out:
        yield _contexts(out)


def window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, doc, start) of every window of contexts."""
    for batch in batches:
        for k in range(batch.num_rows):
            raw = np.frombuffer(batch.column(4)[k].as_py(), np.uint8)
            n = batch.column(3)[k].as_py()
            pair = []
            for salt in (11, 12):
                half = gram_hashes(raw, 64, salt)
                far = half[WIDTH - 64 :]
                pair.append(((half[: len(far)] * U64(0xD6E8FEB86659FD93)) ^ (far + (far >> U64(31)))).view(np.int64)[:n])
            yield _longs(PLACED, *pair, np.full(n, batch.column(1)[k].as_py()), batch.column(2)[k].as_py() + np.arange(n))


def long_anchors(contexts: DataFrame) -> DataFrame:
    """Repeated windows (doc, start, n) of anchors that don't fit a shard."""
    windows = contexts.mapInArrow(window_hashes, PLACED).toDF("h1", "h2", "doc", "start")
    where = F.struct("doc", "start")
    first = windows.groupBy("h1", "h2").agg(F.min(where).alias("first"))
    return windows.join(first, ["h1", "h2"]).filter(where != F.col("first")).select(
        "doc", "start", F.lit(1).cast("long").alias("n")
    )


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc, start, n): windows of `docs` (doc, text) that also start earlier."""
    found = docs.mapInArrow(find_anchors, FOUND).repartition("anchor").sortWithinPartitions(*FOUND.fieldNames())
    sorted_out = staged(found.mapInArrow(sort_out, PLACED), "contexts")
    places = sorted_out.filter("anchor IS NOT NULL").groupBy("doc").agg(
        F.collect_list(F.struct("anchor", "start", "n")).alias("p")
    ).select("doc", *(F.col(f"p.{c}").alias(c) for c in ("anchor", "start", "n")))
    cut = docs.join(places, "doc").select("doc", "text", "anchor", "start", "n").mapInArrow(cut_contexts, CONTEXTS)
    compared = staged(
        cut.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(compare, CONTEXTS), "compared"
    )
    marks = sorted_out.filter("anchor IS NULL").select("doc", "start", "n").unionByName(
        compared.filter("body IS NULL").select("doc", "start", "n")
    )
    long = compared.filter("body IS NOT NULL")
    return marks if long.isEmpty() else marks.unionByName(long_anchors(long))


def covered(size: int, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which bytes of a text the marked windows cover."""
    edge = np.zeros(size + 1, np.int64)
    ends = starts + counts + WIDTH - 1
    inside = ends <= size
    np.add.at(edge, starts[inside], 1)
    np.add.at(edge, ends[inside], -1)
    return np.cumsum(edge)[:-1] > 0


CUT = T.StructType([
    T.StructField("doc", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("kept", T.BinaryType()),
])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: `doc` (key, or LAST for a null), n_bytes, n_removed, `spans` (starts and ends of removed
    runs by turns), `kept` (the bytes that are left)."""
    rows = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc"), F.col(text).alias("text")
    )
    marks = repeated_windows(rows).groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("m")).select(
        "doc", F.col("m.start").alias("start"), F.col("m.n").alias("n")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("doc", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.int64())),
            ("kept", pa.binary()),
        ])
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part, out = batch.slice(at, 1000), []
                for k, doc in enumerate(part.column(0).to_pylist()):
                    raw, spans = raw_text(part.column(1)[k]), []
                    size = removed = len(raw)
                    if part.column(2)[k].is_valid:
                        gone = covered(
                            size, np.asarray(part.column(2)[k].values), np.asarray(part.column(3)[k].values)
                        )
                        spans = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]))).tolist()
                        raw = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    out.append((doc, size, removed - len(raw), spans, raw))
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                )

    return rows.join(marks, "doc", "left").mapInArrow(run, CUT)


def report(docs: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes, removed runs, digest of what is left."""
    return remove_repeats(docs).select(
        F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed",
        (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
