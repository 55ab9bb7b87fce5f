"""SimHash near-duplicate detection.

A fingerprint has 64 bits, bit b set when more than half of a text's word shingles have it set in their
64-bit hash. Two fingerprints that differ in at most 4 bits share at least 4 of their 8 bytes in place,
so an inverted index over positional bytes finds all such pairs. Its lists are keyed by 4 positions and
the bytes there (70 lists per fingerprint): a pair meets in a list only if it has the guaranteed number
of shared bytes, which keeps lists short at any size of corpus. Within a list the shared positional
bytes of a pair are tallied, pairs below the guaranteed minimum go, the rest is verified by its
differing bits. Equal fingerprints are one entry, so copies never meet as pairs.

A list beyond a bound is not paired at all: its fingerprints are expanded into all values within 2 bits,
and two fingerprints are within 4 bits exactly when they share such a value. That is linear in the
list, so there is no cap: links are complete whatever the size of a list.

Texts of a similarity are found the same way at that distance: fingerprints of 1,024 bits, lists keyed by
positions and the bytes there, tally of shared positional bytes, minimum, differing bits; then the texts
decide. No number of shared bytes is certain there, so an exact completion follows: an index over shingles
compares what the byte index has not brought into one component.

Links become components by alternating stars over stored tables. Nulls and empty texts have fingerprint
zero and link like any other; a null identifier never names a component unless all of it is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.llm.exact import LOCATOR, located, order_of
from pitlake.llm.graph import components
from pitlake.plans.scratch import staged

#: Fixed value: seed of the shingle hash.
SEED = 42
MAX_BITS = 4
SHARED_BYTES = 8 - MAX_BITS
#: Lists up to this size are paired in place, longer ones by shared neighbours.
PAIRED = 4096
SUBSETS = np.array(list(combinations(range(8), SHARED_BYTES)))
#: For each set of shared positions (bit mask), the first list in which such a pair meets.
FIRST_LIST = np.array([
    next((k for k, s in enumerate(SUBSETS) if all(mask >> p & 1 for p in s)), len(SUBSETS)) for mask in range(256)
])
PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1:].tolist(), strict=True)
    return np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in spans], "<u8")


def fingerprint(text: str | None, size: int) -> int:
    """Signed 64-bit fingerprint over shingles of `size` words, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    hashes = _shingle_hashes(words, size)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(id, fp) per row."""
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), size) for t in batch.column(1)), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["id", "fp"])

    return docs.mapInArrow(run, T.StructType([docs.schema["id"], T.StructField("fp", T.LongType())]))


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(list, fp): the lists of each fingerprint, keyed by positions and the bytes there."""
    for batch in batches:
        fps = np.asarray(batch.column(0))
        for k in range(0, len(fps), 20_000):
            part = fps[k : k + 20_000].astype("<i8")
            place = part.view(np.uint8).reshape(-1, 8).astype(np.int64)
            for n, chosen in enumerate(SUBSETS):
                lists = np.full(len(part), n, np.int64)
                for p in chosen:
                    lists = (lists << 8) | place[:, p]
                yield _pairs(lists, part)


def runs(batches: Iterator[pa.RecordBatch], bound: int) -> Iterator[tuple[int, np.ndarray, bool]]:
    """Runs of one key in sorted (key, value) rows: key, values, whether the run exceeds `bound`.

    A run beyond the bound comes in several pieces, a single value only as such a piece.
    """
    none = np.zeros(0, np.int64)
    long_key, tail = None, (none, none)
    for batch in batches:
        keys = np.concatenate([tail[0], np.asarray(batch.column(0))])
        values = np.concatenate([tail[1], np.asarray(batch.column(1))])
        if not len(keys):
            continue
        starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
        size = np.diff(np.append(starts, len(keys)))
        for k in np.flatnonzero((size[:-1] > 1) | (keys[starts[:-1]] == long_key)).tolist():
            key = int(keys[starts[k]])
            yield key, values[starts[k] : starts[k] + size[k]], key == long_key or size[k] > bound
        last = starts[-1]
        tail = keys[last:], values[last:]
        if len(tail[0]) > bound or keys[last] == long_key:
            long_key = int(keys[last])
            yield long_key, tail[1], True
            tail = none, none
    if len(tail[0]) > 1:
        yield int(tail[0][0]), tail[1], False


def shared_mask(diff: np.ndarray) -> np.ndarray:
    """Which positional bytes two fingerprints share, as a bit mask, from their exclusive or."""
    equal = diff.astype("<i8").view(np.uint8).reshape(-1, 8) == 0
    return np.packbits(equal, axis=1, bitorder="little")[:, 0]


def linked(one: np.int64, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of `others`, those within reach of `one`: tally of shared bytes, then differing bits. And masks."""
    diff = others ^ one
    mask = shared_mask(diff)
    enough = np.bitwise_count(mask) >= SHARED_BYTES
    return enough & (np.bitwise_count(diff.view(np.uint64)) <= MAX_BITS), mask


def list_links(members: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Links that span what is linked within one list, with the positions that they share."""
    rest = members
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            near, mask = linked(one, rest)
            for other, shared in zip(rest[near], mask[near].tolist(), strict=True):
                queue.append(other)
                yield int(one), int(other), shared
            rest = rest[~near]


def links_in_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a < b), and (a, a) for each fingerprint of a list too long to be paired.

    A link is told by the first list that has both ends: what an earlier list has linked, directly or
    over others, needs no telling again.
    """
    rows: list[tuple[int, int]] = []
    for key, members, too_long in runs(batches, PAIRED):
        if too_long:
            rows += [(m, m) for m in np.unique(members).tolist()]
        else:
            first = FIRST_LIST[:] == key >> 32
            rows += [(min(a, b), max(a, b)) for a, b, shared in list_links(np.unique(members)) if first[shared]]
        if len(rows) > 50_000:
            yield _pairs(*np.array(rows, np.int64).T)
            rows = []
    if rows:
        yield _pairs(*np.array(rows, np.int64).T)


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, fp): all values within half the distance of each fingerprint."""
    bit = np.uint64(1) << np.arange(64, dtype=np.uint64)
    flips = [np.zeros(1, np.uint64)]
    for n in range(1, MAX_BITS // 2 + 1):
        flips.append(np.array([np.bitwise_or.reduce(bit[list(c)]) for c in combinations(range(64), n)], np.uint64))
    flips = np.concatenate(flips).view(np.int64)
    for batch in batches:
        for fp in np.asarray(batch.column(0)):
            yield _pairs(flips ^ fp, np.full(len(flips), fp))


def links_by_neighbour(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Everything that shares a value is linked to the first that has it."""
    key = first = None
    for batch in batches:
        keys, values = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        if not len(keys):
            continue
        begins = np.append(keys[0] != key, keys[1:] != keys[:-1])
        heads = np.where(begins, np.arange(len(keys)), -1)
        heads = np.maximum.accumulate(heads)
        star = np.where(heads >= 0, values[np.maximum(heads, 0)], first if first is not None else 0)
        key, first = keys[-1], star[-1]
        other = star != values
        if other.any():
            pairs = np.unique(np.stack([np.minimum(star, values), np.maximum(star, values)])[:, other], axis=1)
            yield _pairs(pairs[0], pairs[1])


def by_key(df: DataFrame) -> DataFrame:
    return df.repartition("a").sortWithinPartitions("a", "b")


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that connect all fingerprints within reach of each other; `distinct` has `fp` once each."""
    found = staged(
        by_key(distinct.select("fp").mapInArrow(postings, PAIR)).mapInArrow(links_in_lists, PAIR), "links"
    )
    links = found.filter("a <> b").distinct()
    hot = found.filter("a = b").select(F.col("a").alias("fp"))
    if hot.isEmpty():
        return links
    hot = hot.distinct().repartition("fp")
    more = by_key(hot.mapInArrow(neighbours, PAIR)).mapInArrow(links_by_neighbour, PAIR)
    return links.unionByName(more).distinct()


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """One row per document: `id`, `fp`, `component` (the smallest identifier reachable over links)."""
    prints = staged(fingerprints(docs, key, text, words), "fingerprints")
    distinct = staged(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    labels = components(fingerprint_links(distinct))
    rooted = distinct.join(labels, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    classes = rooted.join(least, "root").select("fp", "component")
    return prints.join(classes, "fp").select("id", "fp", "component")


#: Similarity search: a fingerprint of WIDE x 64 bits filters candidates before their texts are compared.
WIDE = 16
SPREAD = np.cumprod(np.full(WIDE, 0xD1342543DE82EF95, np.uint64)) | np.uint64(1)
#: Deviations above the mean at the limit that a candidate's differing bits may have; bits of a pair are
#: independent, so this loses no pair. Smaller sets than FEWEST differ from the mean's formula and all pass.
LOOSE = 8
FEWEST = 64
#: Byte index over it: each list is keyed by three positions and their bytes. Positions are dealt five times to all
#: lists, so a pair at 0.8, which shares some 34 of the 128 bytes, meets in four of the 210 lists on average.
PLACES = np.concatenate([
    np.random.default_rng([SEED, k]).permutation(8 * WIDE)[: 8 * WIDE // 3 * 3].reshape(-1, 3) for k in range(5)
])
#: Its lists are searched in turns, up to these numbers: the members of what one turn has joined are not paired again in the
#: next one, so a large group of near copies is joined from few lists. And no more than a turn's postings lie on disk at once.
TURNS = (21, 115, len(PLACES))
#: Deviations that shared bytes and differing bits of the byte index's pairs may lie off the mean at the limit, and those
#: of the 64 bits that go along with a posting.
NEAR = 2.5
LOOSE_WORD = 4
#: Lists of the byte index up to this size are compared all at once, longer ones cluster by cluster, and so many members of
#: one list are held at a time.
SHORT = 16
HELD = 1 << 16
#: Lists of shingles up to this size are paired in place.
LISTED = 256
#: Members of a longer list that are compared together, at least; times the root of its members, at most, so that their
#: copies for all blocks grow with the power 1.5 of them. And shingles looked at at a time.
BLOCK = 256
GROWN = 4
COLUMNS = 8192
#: Rounds in which longer lists of nearly the same members are put together.
GATHERED = 2
#: Counts of a set's shingles by their hash, at most MANY each.
COUNTS = 256
MANY = 255
#: Which shingles are frequent is told from about this many texts; frequent in so many of them.
SAMPLED = 20_000
FREQUENT = 8
#: Most frequent shingles known. This and the sample decide on the order of shingles, not on results.
MOST_FREQUENT = 1 << 19
PLACED = T.StructType([T.StructField(n, T.LongType()) for n in ("list", "node", "bits")])
TURN = T.StructType([*PLACED.fields, T.StructField("root", T.LongType())])
MET = T.StructType([T.StructField(n, T.LongType()) for n in ("a", "b", "low", "high", "differing")])
POSTING = T.StructType([T.StructField(n, T.LongType()) for n in ("list", "node", "n", "at")])
FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("list", "a", "n", "at", "b")])
MEMBER = T.StructType([T.StructField(n, T.LongType()) for n in ("list", "a", "a_root")])


def differing(similarity: float) -> float:
    """Share of bits in which two texts differ whose shingle sets have this Jaccard similarity."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def most_bits(similarity: float, bits: int = 64 * WIDE, deviations: float = LOOSE) -> int:
    """Differing bits at this similarity, plus deviations."""
    share = differing(similarity)
    return int(bits * share + deviations * np.sqrt(bits * share * (1 - share)))


def least_bytes(similarity: float) -> int:
    """Positional bytes that two wide fingerprints share at this similarity, less NEAR deviations."""
    share = (1 - differing(similarity)) ** 8
    return int(8 * WIDE * share - NEAR * np.sqrt(8 * WIDE * share * (1 - share)))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Distinct hashes of a text's shingles, ascending."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    return np.unique(_shingle_hashes(words, size)) if words else np.zeros(0, "<u8")


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """Majority bits of WIDE x 64 bits per shingle, each a mix of the shingle's hash."""
    ones = np.zeros(64 * WIDE, np.int64)
    for k in range(0, len(hashes), 4096):
        mixed = hashes[k : k + 4096, None] * SPREAD
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))).astype("<u8")
        ones += np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes()


def counted(hashes: np.ndarray) -> bytes:
    """How many shingles of a set have each value of their hash's first byte; MANY stands for as many or more."""
    first = (hashes >> np.uint64(56)).astype(np.int64)
    return np.minimum(np.bincount(first, minlength=COUNTS), MANY).astype(np.uint8).tobytes()


def _grid(column: pa.Array, width: int = 8 * WIDE) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def frequent_shingles(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many of a bounded sample of texts hold, ascending, and in how many."""
    total = texts.count()
    if total > SAMPLED:
        texts = texts.filter(F.pmod(F.xxhash64("digest"), F.lit(1 << 20)) < int(SAMPLED / total * (1 << 20)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text.as_py(), words).view(np.int64))], names=["h"])

    held = texts.select("text").mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("texts"))
    rows = held.filter(F.col("texts") >= FREQUENT).orderBy(F.desc("texts"), "h").limit(MOST_FREQUENT).collect()
    hashes = np.array([r.h for r in rows], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array([r.texts for r in rows], np.int64)[order]


def prefix(hashes: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], share: Fraction) -> np.ndarray:
    """The first shingles of a set, rarer before more frequent ones, such that sets of similarity `share` or more
    have one of them in common."""
    known, texts = frequent
    often = np.zeros(len(hashes), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        often = np.where(known[at] == hashes, texts[at], 0)
    return hashes[np.lexsort((hashes, often))][: len(hashes) - math.ceil(share * len(hashes)) + 1]


def reachable(n_a, at_a, n_b, at_b, share: Fraction):
    """Whether sets of these sizes can be similar enough if these places hold their first common shingle.

    For arrays as for columns.
    """
    p, q = share.numerator, share.denominator
    least = p * (n_a + n_b)
    return ((n_a - at_a) * (p + q) >= least) & ((n_b - at_b) * (p + q) >= least)


def pairs_in_lists(batches: Iterator[pa.RecordBatch], share: Fraction, bound: int) -> Iterator[pa.RecordBatch]:
    """From postings sorted by list: (null, a, null, null, b) for each pair in reach within a list.

    A list longer than `bound` is told as it is, (list, a, n, at, b) per member, b its first one.
    """
    def told(columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.nulls(len(columns[1]), pa.int64()) if c is None else pa.array(c, pa.int64()) for c in columns
        ], names=FOUND.names)

    held, key, first = np.zeros((0, 4), np.int64), None, None
    for batch in chain(batches, [None]):
        rows = held if batch is None else np.concatenate([held, np.column_stack([np.asarray(c) for c in batch.columns])])
        if not len(rows):
            continue
        starts = np.concatenate([[0], np.flatnonzero(np.diff(rows[:, 0])) + 1])
        size = np.diff(np.append(starts, len(rows)))
        open_end = batch is not None
        if open_end and size[-1] <= bound and rows[-1, 0] != key:
            held, starts, size, open_end = rows[starts[-1] :], starts[:-1], size[:-1], False
        else:
            held = held[:0]
        long = (size > bound) | (rows[starts, 0] == key)
        for k in np.flatnonzero(long).tolist():
            part = rows[starts[k] : starts[k] + size[k]]
            if part[0, 0] != key:
                key, first = part[0, 0], part[0, 1]
            yield told([*part.T, np.full(len(part), first)])
        for s in np.unique(size[~long & (size > 1)]).tolist():
            one, two = np.triu_indices(s, 1)
            lists = starts[~long & (size == s)]
            for k in range(0, len(lists), step := max(1, 500_000 // len(one))):
                a = rows[(lists[k : k + step, None] + one).ravel()]
                b = rows[(lists[k : k + step, None] + two).ravel()]
                ok = reachable(a[:, 2], a[:, 3], b[:, 2], b[:, 3], share)
                a, b = a[ok, 1], b[ok, 1]
                if len(a):
                    ends = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                    yield told([None, ends[0], None, None, ends[1]])


def similar_pairs(pairs: DataFrame, nodes: DataFrame, words: int, share: Fraction, tallied: bool = False) -> DataFrame:
    """Of the pairs (a < b) those whose shingle sets have at least this similarity; stored.

    The fingerprints of `nodes` (node, n, fp, text) are a loose filter, so texts are fetched for few others. With
    `tallied` it is the byte index's own: shared positional bytes are tallied, pairs below the minimum go, then those
    with too many differing bits.
    """
    limit = most_bits(float(share), deviations=NEAR) if tallied else most_bits(float(share))
    least = least_bytes(float(share))

    def ends(pairs: DataFrame, *columns: str) -> DataFrame:
        for side in ("a", "b"):
            one = nodes.select(F.col("node").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns))
            pairs = pairs.join(one, side)
        return pairs.select("a", "b", *(f"{side}_{c}" for c in columns for side in ("a", "b")))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            diff = _grid(batch.column(4)) ^ _grid(batch.column(5))
            near = np.bitwise_count(diff).sum(axis=1, dtype=np.int64) <= limit
            if tallied:
                near &= (diff == 0).sum(axis=1) >= least
            else:
                near |= np.minimum(np.asarray(batch.column(2)), np.asarray(batch.column(3))) < FEWEST
            yield _pairs(np.asarray(batch.column(0))[near], np.asarray(batch.column(1))[near])

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for one, two in zip(batch.column(2), batch.column(3), strict=True):
                x, y = shingle_set(one.as_py(), words), shingle_set(two.as_py(), words)
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(both * share.denominator >= (len(x) + len(y) - both) * share.numerator)
            near = np.array(near, bool)
            yield _pairs(np.asarray(batch.column(0))[near], np.asarray(batch.column(1))[near])

    loose = staged(ends(pairs, "n", "fp").mapInArrow(close, PAIR), "loose-pairs")
    return staged(ends(loose, "text").mapInArrow(similar, PAIR), "similar-pairs")


def byte_postings(batches: Iterator[pa.RecordBatch], turn: range) -> Iterator[pa.RecordBatch]:
    """(list, node, bits, root) from (node, root, fp): this turn's lists of each wide fingerprint, and 64 of its bits."""
    for batch in batches:
        if not batch.num_rows:
            continue
        node, root, grid = batch.column(0), batch.column(1), _grid(batch.column(2))
        place, bits = grid.astype(np.int64), grid.view("<i8")
        for n in turn:
            p, q, r = PLACES[n].tolist()
            lists = n << 24 | place[:, p] << 16 | place[:, q] << 8 | place[:, r]
            yield pa.RecordBatch.from_arrays([pa.array(lists), node, pa.array(bits[:, n % WIDE]), root], names=TURN.names)


def _off(bits: np.ndarray, others: np.ndarray) -> np.ndarray:
    """In how many bits they differ."""
    return np.bitwise_count((bits ^ others).view(np.uint64))


def _clustered(members: np.ndarray, limit: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Members (list, node, bits, root) of one list beside the first of each cluster in reach; and those firsts."""
    pairs, firsts = [], []
    while len(members):
        first, members = members[0], members[1:]
        near = _off(members[:, 2], first[2]) <= limit
        other = members[near & (members[:, 3] != first[3])]
        pairs.append((np.broadcast_to(first, other.shape), other))
        firsts.append(first)
        members = members[~near]
    return pairs, np.array(firsts, np.int64).reshape(-1, 4)


def pairs_by_bytes(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """From postings sorted by list: (a, b, low, high, differing), a < b, each member with the first one in its list, of
    another component, from which its `bits` differ in no more than `limit`; in long lists, with the first of its
    cluster.

    So rows grow with the postings, not with the square of a group. Without a column `root` each node is a component;
    low < high are the components' smallest nodes.
    """
    held = np.zeros((0, 4), np.int64)
    for batch in chain(batches, [None]):
        if batch is None:
            rows = held
        else:
            columns = [np.asarray(c) for c in batch.columns]
            rows = np.concatenate([held, np.column_stack(columns if len(columns) == 4 else [*columns, columns[1]])])
        if not len(rows):
            continue
        starts = np.concatenate([[0], np.flatnonzero(np.diff(rows[:, 0])) + 1])
        size = np.diff(np.append(starts, len(rows)))
        found, held = [], rows[:0]
        if batch is not None:
            held, starts, size = rows[starts[-1] :], starts[:-1], size[:-1]
            if len(held) > HELD:
                found, held = _clustered(held, limit)
        for k in np.flatnonzero(size > SHORT).tolist():
            found += _clustered(rows[starts[k] : starts[k] + size[k]], limit)[0]
        for s in np.unique(size[(size > 1) & (size <= SHORT)]).tolist():
            place = starts[size == s][:, None] + np.arange(s)
            bits, root = rows[place, 2], rows[place, 3]
            near = (_off(bits[:, :, None], bits[:, None, :]) <= limit) & (root[:, :, None] != root[:, None, :])
            near &= np.triu(np.ones((s, s), bool), 1)
            k, two = np.nonzero(near.any(axis=1))
            found.append((rows[place[k, near.argmax(axis=1)[k, two]]], rows[place[k, two]]))
        if sum(len(x) for x, _ in found):
            x, y = (np.concatenate(side) for side in zip(*found, strict=True))
            ends, tops = np.sort([x[:, 1], y[:, 1]], axis=0), np.sort([x[:, 3], y[:, 3]], axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (*ends, *tops, _off(x[:, 2], y[:, 2]))], names=MET.names
            )


def roots_by_bytes(nodes: DataFrame, words: int, share: Fraction) -> DataFrame:
    """Components (node, root) of what the byte index over the wide fingerprints of `nodes` links, without the roots.

    Of the pairs that two components have in a turn's lists the nearest one is looked at: what it joins needs no other,
    and what it does not join comes again in the next turn, or to `completed`.
    """
    p, q = share.numerator, share.denominator
    limit = most_bits(float(share), 64, LOOSE_WORD)
    prints = nodes.filter(F.col("n") * (q - p) >= p).select("node", "fp")  # smaller sets have no other near
    roots = nodes.sparkSession.createDataFrame([], "node long, root long")
    for first, last in zip((0, *TURNS), TURNS):
        turn = range(first, last)
        known = rooted(prints, roots, "node").select("node", F.col("node_root").alias("root"), "fp")
        postings = known.mapInArrow(lambda batches, turn=turn: byte_postings(batches, turn), TURN)
        lists = postings.repartition("list").sortWithinPartitions("list", "node")
        met = lists.mapInArrow(lambda batches: pairs_by_bytes(batches, limit), MET)
        nearest = met.groupBy("low", "high").agg(F.min(F.struct("differing", "a", "b")).alias("pair"))
        pairs = staged(nearest.select("pair.a", "pair.b"), "met-by-bytes")
        roots = merged(roots, similar_pairs(pairs, nodes, words, share, tallied=True))
    return roots


def rooted(df: DataFrame, roots: DataFrame, side: str) -> DataFrame:
    """`df` with the component of its column `side`; what has no links is its own."""
    got = roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
    return df.join(got, side, "left").withColumn(f"{side}_root", F.coalesce(f"{side}_root", side))


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components."""
    return rooted(rooted(pairs, roots, "a"), roots, "b").filter("a_root <> b_root").select("a", "b")


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root), without the roots, after further links (a, b); stored.

    Only links between components are followed, as links of their roots.
    """
    ends = rooted(rooted(links, roots, "a"), roots, "b").filter("a_root <> b_root")
    between = ends.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct()
    above = components(between).filter("node <> root")
    moved = rooted(roots.withColumnRenamed("root", "a"), above, "a").select("node", F.col("a_root").alias("root"))
    return staged(moved.unionByName(above), "roots")


def _overlaps(some: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Shingles that each set of `some` has in common with each of `others`."""
    every, at = np.unique(np.concatenate([*some, *others]), return_inverse=True)
    ends = np.cumsum([len(x) for x in (*some, *others)])
    owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    both = np.zeros((2, len(every)), bool)
    both[(owner >= len(some)).astype(int), at] = True
    both = both.all(axis=0)  # others count for no pair
    at, owner, every = (np.cumsum(both) - 1)[at[both[at]]], owner[both[at]], every[both]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    out = np.zeros((len(some), len(others)), np.float32)
    for start in range(0, len(every), COLUMNS):
        lo, hi = np.searchsorted(at, [start, start + COLUMNS])
        held = np.zeros((len(ends), min(COLUMNS, len(every) - start)), np.float32)
        held[owner[lo:hi], at[lo:hi] - start] = 1
        out += held[: len(some)] @ held[len(some) :].T
    return out.astype(np.int64)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links (a < b) that join what is not joined yet, in ascending order."""
    above: dict[int, int] = {}

    def top(node: int) -> int:
        while (up := above.get(node, node)) != node:
            above[node] = node = above.get(up, up)
        return node

    kept = []
    for x, y in np.unique(np.stack([a, b]), axis=1).T.tolist():
        p, q = top(x), top(y)
        if p != q:
            above[max(p, q)] = min(p, q)
            kept.append((x, y))
    return tuple(np.array(kept, np.int64).reshape(-1, 2).T)


def similar_in_blocks(batches: Iterator[pa.RecordBatch], words: int, share: Fraction) -> Iterator[pa.RecordBatch]:
    """From rows (list, left, right, side, node, root, text) sorted by block, what joins components in each block.

    A block is one (list, left, right): its members of side 0 are compared with those of side 1 of other
    components, by exact similarity. Of the components that similar pairs join, links of a forest are put out,
    the least ones first, so that blocks with the same members say the same.
    """
    def compared(rows: list[tuple]) -> pa.RecordBatch | None:
        some, others = ([r for r in rows if r[3] == side] for side in (0, 1))
        if not some or not others:
            return None
        sets = [[r[6] for r in side] for side in (some, others)]
        both = _overlaps(*sets)
        n = [np.array([len(x) for x in side]) for side in sets]
        enough = both * share.denominator >= (n[0][:, None] + n[1][None, :] - both) * share.numerator
        root = [np.array([r[5] for r in side], np.int64) for side in (some, others)]
        one, two = np.nonzero(enough & (root[0][:, None] != root[1][None, :]))
        a, b = root[0][one], root[1][two]
        links = forest(np.minimum(a, b), np.maximum(a, b))
        return _pairs(*links) if len(links[0]) else None

    held, key = [], None
    for batch in chain(batches, [None]):
        rows = iter([None]) if batch is None else (
            (*head, shingle_set(text.as_py(), words))
            for *head, text in zip(*(c.to_pylist() for c in batch.columns[:6]), batch.column(6), strict=True)
        )
        for r in rows:
            if held and (r is None or r[:3] != key):
                if (out := compared(held)) is not None:
                    yield out
                held = []
            if r is not None:
                key = r[:3]
                held.append(r)


def alike_in_blocks(batches: Iterator[pa.RecordBatch], share: Fraction) -> Iterator[pa.RecordBatch]:
    """From rows (list, left, right, side, a, a_root, n, counts) sorted by block: (list, a, a_root) of each member that has
    one of another component on the other side of its block with which it can be similar.

    Two sets have no more shingles in common than the lesser of their counts, summed up; so this drops no similar pair.
    """
    p, q = share.numerator, share.denominator

    def alike(rows: pa.Table) -> np.ndarray:
        side, root, n = (np.asarray(rows.column(k)) for k in (3, 5, 6))
        counts = _grid(rows.column(7), COUNTS)
        full, hit = (counts == MANY).any(axis=1), np.zeros(len(side), bool)
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        for k in range(0, len(one) if len(two) else 0, 32):
            some = one[k : k + 32]
            both = np.minimum(counts[some, None], counts[None, two]).sum(axis=2, dtype=np.int64)
            near = (both * (p + q) >= p * (n[some, None] + n[two])) | full[some, None] | full[two]
            near &= root[some, None] != root[two]
            hit[some] |= near.any(axis=1)
            hit[two] |= near.any(axis=0)
        return hit

    held = None
    for batch in chain(batches, [None]):
        parts = [x for x in (held, None if batch is None else pa.Table.from_batches([batch])) if x is not None]
        if not parts or not sum(x.num_rows for x in parts):
            continue
        rows = pa.concat_tables(parts)
        key = np.column_stack([np.asarray(rows.column(k)) for k in range(3)])
        starts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(key)]]).tolist()
        held = None
        if batch is not None:
            held, starts = rows.slice(starts[-2]), starts[:-1]
        for start, end in zip(starts, starts[1:]):
            block = rows.slice(start, end - start)
            if (hit := alike(block)).any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.asarray(block.column(k))[hit]) for k in (0, 4, 5)], names=MEMBER.names
                )


def gathered(members: DataFrame, seed: int) -> DataFrame:
    """Members (list, a, a_root) of lists put together that have the same least member by hash; a pair of one list stays in one.

    Lists have it in common as often as their members are the same ones, so a group whose members meet in many lists is
    left in a few, and lists of different members stay apart.
    """
    least = members.groupBy("list").agg(F.min(F.struct(F.xxhash64(F.lit(seed), "a").alias("at"), "a")).alias("least"))
    return members.join(least, "list").select(F.col("least.a").alias("list"), "a", "a_root").distinct()


def in_blocks(members: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """Rows (list, left, right, side, a, a_root, and `columns` of `nodes`) sorted by block (list, left, right).

    A pair of different components has a member outside the list's largest one. Lists are cut into blocks, and of each
    such pair one is on side 0 of a block and the other one on side 1. `nodes` are joined once for all lists of a member.
    """
    sizes = members.groupBy("list", "a_root").agg(F.count("*").alias("size"))
    lists = sizes.groupBy("list").agg(
        F.max(F.struct("size", "a_root")).alias("most"), F.sum("size").alias("all"), F.count("*").alias("roots")
    ).filter("roots > 1").withColumn("block", F.greatest(F.lit(float(BLOCK)), GROWN * F.sqrt("all"))).select(
        "list", F.col("most.a_root").alias("largest"),
        F.ceil((F.col("all") - F.col("most.size")) / F.col("block")).cast("int").alias("lefts"),
        F.ceil(F.col("all") / F.col("block")).cast("int").alias("rights"),
    )
    mixed = members.join(staged(lists, "mixed-lists"), "list").groupBy("a").agg(
        F.collect_list(F.struct("list", "a_root", "largest", "lefts", "rights")).alias("places")
    )
    told = mixed.join(nodes.select(F.col("node").alias("a"), *columns), "a").select("a", *columns, F.inline("places"))
    at = F.xxhash64("a")
    rows = told.filter("a_root <> largest").select(
        "list", F.pmod(at, F.col("lefts")).cast("int").alias("left"), F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("right"),
        F.lit(0).alias("side"), "a", "a_root", *columns,
    ).unionByName(told.select(
        "list", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("left"), F.pmod(at, F.col("rights")).cast("int").alias("right"),
        F.lit(1).alias("side"), "a", "a_root", *columns,
    ))
    block = ["list", "left", "right"]
    return rows.repartition(*block).sortWithinPartitions(*block)


def links_across(members: DataFrame, nodes: DataFrame, words: int, share: Fraction) -> DataFrame:
    """Links (a < b) between the roots of components that similar members of one list join; stored.

    members: (list, a, a_root). Lists of nearly the same members are compared as one (`gathered`). In blocks of a list first
    the counts of its members' shingles are compared, and who is in reach of nobody is left out: texts that have little
    more than the list in common. The texts of the others travel once per block that they meet, pairs not at all unless
    they are similar. So a group of texts that are alike, but not enough, costs its members times its blocks in rows, once.
    """
    for seed in range(GATHERED):
        members = staged(gathered(members, seed), "gathered-lists")
    alike = in_blocks(members, nodes, "n", "counts").mapInArrow(lambda b: alike_in_blocks(b, share), MEMBER)
    rows = in_blocks(staged(alike.distinct(), "alike-in-lists"), nodes, "text")
    return staged(rows.mapInArrow(lambda b: similar_in_blocks(b, words, share), PAIR).distinct(), "links-across")


def completed(roots: DataFrame, nodes: DataFrame, words: int, share: Fraction) -> DataFrame:
    """Components (node, root) of similar texts, without the roots, joined by every similar pair that they leave apart.

    Shingles have one order everywhere, rare ones before frequent ones, and two sets of this similarity have one of
    their first shingles in common. So lists keyed by one of a text's first shingles hold all pairs. All members of a
    list are paired; what the given components or a first round of comparisons, one per text, have brought into one
    component is not compared again. Of a list too long to be paired in place, members outside its largest
    component are compared with those of other components block by block, by counts and then by texts, and only similar
    pairs are written.
    """
    frequent = frequent_shingles(nodes, words)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, one in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                hashes = shingle_set(one.as_py(), words)
                lists = prefix(hashes, frequent, share)
                columns = lists.view(np.int64), np.full(len(lists), node), np.full(len(lists), len(hashes)), np.arange(len(lists))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=POSTING.names)

    bound = LISTED
    lists = nodes.select("node", "text").mapInArrow(post, POSTING).repartition("list").sortWithinPartitions("list", "node")
    found = staged(lists.mapInArrow(lambda batches: pairs_in_lists(batches, share, bound), FOUND), "found")
    candidates = staged(found.filter("list IS NULL").select("a", "b").distinct(), "candidates")
    long = found.filter("list IS NOT NULL")
    open_pairs = staged(apart(candidates, roots), "candidates-apart")
    told = long.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    firsts = open_pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b").unionByName(apart(told, roots)).distinct()
    roots = merged(roots, similar_pairs(firsts, nodes, words, share))
    members = staged(rooted(long.select("list", "a"), roots, "a"), "members")
    left = apart(open_pairs, roots).join(firsts, ["a", "b"], "left_anti")
    return merged(roots, links_across(members, nodes, words, share).unionByName(similar_pairs(left, nodes, words, share)))


def similar_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8
) -> DataFrame:
    """One row per document: `id`, `component` over links between texts of at least this similarity.

    Similarity is the Jaccard similarity of the sets of shingles (64-bit hashes), decided on the texts. Candidates
    come from the byte index over wide fingerprints (`roots_by_bytes`). It finds a pair at the limit with a chance of
    nine in ten, not for certain, so what it leaves in different components is completed exactly
    (`completed`), and no such pair is lost.

    Texts of one set are one node. Texts without a word are alike.
    """
    share = Fraction(str(similarity))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes(), SEED) for s in sets], pa.binary()),
                pa.array([wide_fingerprint(s) for s in sets], pa.binary()), pa.array([counted(s) for s in sets], pa.binary()),
            ], names=["id", "text", "n", "digest", "fp", "counts"])

    shape = T.StructType([
        rows.schema["id"], rows.schema["text"], T.StructField("n", T.LongType()),
        T.StructField("digest", T.BinaryType()), T.StructField("fp", T.BinaryType()), T.StructField("counts", T.BinaryType()),
    ])
    prints = staged(rows.mapInArrow(read, shape).withColumn("node", F.monotonically_increasing_id()), "shingled")
    distinct = staged(prints.groupBy("digest").agg(F.min("id").alias("least"), F.min("node").alias("node")), "distinct-sets")
    named = prints.select("digest", F.col("node").alias("copy")).join(distinct.select("digest", "node"), "digest")
    copies = staged(named.filter("copy <> node").select("copy"), "copies")
    nodes = prints.join(copies, F.col("node") == F.col("copy"), "left_anti").filter("n > 0")
    labels = completed(roots_by_bytes(nodes, words, share), nodes, words, share)
    labels = distinct.join(labels.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select(
        "digest", "least", F.coalesce("root", "node").alias("root")
    )
    least = labels.groupBy("root").agg(F.min("least").alias("component"))
    return prints.select("id", "digest").join(labels.join(least, "root").select("digest", "component"), "digest").select("id", "component")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """`docs` with the first row of every group of similar texts, by identifier (nulls last), then place; columns as they were."""
    columns = docs.columns
    docs = docs.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)))
    rows = located(docs)
    named = rows.select(order_of(F.col(f"c{columns.index(key)}")).alias("at"), f"c{columns.index(text)}")
    groups = similar_groups(named, "at", f"c{columns.index(text)}", words)
    dropped = groups.filter(F.col("id") != F.col("component")).select("id.file", "id.row")
    kept = rows.join(dropped, list(LOCATOR), "left_anti")
    return kept.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(columns)))


def report(docs: DataFrame) -> DataFrame:
    """Fingerprints over 4-word shingles and their components."""
    return near_groups(docs, words=4).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
