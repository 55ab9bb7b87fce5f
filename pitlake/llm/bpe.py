"""Byte-level BPE encoding and decoding over Arrow batches.

Texts are cut into pieces by the pattern; every distinct piece of a chunk is merged once. Pieces of
like length lie side by side in a padded matrix of token ids: each round every row merges its leftmost
pair of minimum rank, found through a hashed pair table, closes the gap, and rows without a mergeable
pair leave the matrix. Long pieces take the same merges on one row: all occurrences of the minimum
pair in a round, unless that makes a pair of no higher rank, which then has its turn first.

Nulls and empty texts have no tokens; very long texts are read in chunks of whole rows and never cut.
No shuffle: rows stay where they are, and all other columns pass through untouched.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: no pair.
NONE = np.int32(1 << 30)
#: The Unicode property White_Space.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Pieces longer than this are merged one by one.
LONG = 64
#: Characters or ids worked on at a time, and pieces remembered by a worker.
CHUNK_CHARS = 1_000_000
CACHE_PIECES = 150_000


def _class(first: str) -> str:
    """The code points whose general category starts with `first`, as the inside of a character class."""
    spans, start = [], None
    for c in range(0x110000):
        inside = unicodedata.category(chr(c))[0] == first
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            spans.append((start, c - 1))
            start = None
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


@lru_cache(maxsize=4)
def splitter(pattern: str) -> re.Pattern:
    """The pattern for Python's `re`, with letters, numbers and white space as explicit classes."""
    for name, inside in ((r"\p{L}", _class("L")), (r"\p{N}", _class("N")), (r"\s", SPACE)):
        pattern = re.sub(
            r"\[(?:\\.(?:\{\w\})?|[^\]\\])*\]|\\.(?:\{\w\})?",
            lambda m, n=name, i=inside: m[0].replace(n, i) if m[0][0] == "[" else (f"[{i}]" if m[0] == n else m[0]),
            pattern,
        )
    return re.compile(pattern.replace(r"(?!\S)", f"(?![^{SPACE}])"))


@lru_cache(maxsize=4)
def quick_splitter(pattern: str) -> tuple[re.Pattern, np.ndarray] | None:
    """The pattern in Python's own, faster classes, and by code point whether they class it differently."""
    pattern = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)")
    pattern = pattern.replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
    if r"\p" in pattern:
        return None
    odd = np.zeros(0x110000, bool)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        own = "N" if chr(c).isdecimal() else "L" if chr(c).isalnum() else ""
        odd[c] = (kind in "LN" or own != "") and own != kind
    odd[0x1C:0x20] = True
    return re.compile(pattern), odd


class Vocabulary:
    """Ranks of byte strings, and the hashed table of pairs that merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.top = max(ranks.values()) + 1
        self.bytes_of = [b""] * self.top
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (left, right, rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if (left := ranks.get(token[:k])) is not None and (right := ranks.get(token[k:])) is not None
        ]
        table = np.array(pairs or [(0, 0, 0)], np.int64).reshape(-1, 3)
        self._hash(table if pairs else table[:0])
        lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _hash(self, pairs: np.ndarray) -> None:
        """Open addressing with linear probing; the table is at most a quarter full."""
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(pairs)) * 4))))
        size = 1 << self.bits
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
        key, value = (pairs[:, 0] << 20) | pairs[:, 1], pairs[:, 2]
        at = self._slot(key)
        while len(key):
            free = self.keys[at] == -1
            first = np.zeros(len(key), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.keys[at[put]], self.values[at[put]] = key[put], value[put]
            key, value, at = key[~put], value[~put], (at[~put] + 1) & (size - 1)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's concatenation, NONE where it is no token. Ids below zero are padding."""
        key = (left.astype(np.int64) << 20) | right
        key[(left < 0) | (right < 0)] = -2
        at = self._slot(key)
        seen = self.keys[at]
        out = np.where(seen == key, self.values[at], NONE)
        left_over = np.flatnonzero((seen != key) & (seen != -1) & (key != -2))
        shape = key.shape
        key, at, flat = key.reshape(-1), at.reshape(-1), out.reshape(-1)
        mask = len(self.keys) - 1
        while len(left_over):
            at[left_over] = (at[left_over] + 1) & mask
            seen = self.keys[at[left_over]]
            hit = seen == key[left_over]
            flat[left_over[hit]] = self.values[at[left_over[hit]]]
            left_over = left_over[~hit & (seen != -1)]
        return flat.reshape(shape)

    def merge_rows(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of pieces of at most `width` bytes: all ids on end, and how many each piece has."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        grid = np.full((len(pieces), width), -1, np.int32)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        filled = np.arange(width) < size[:, None]
        grid[filled] = self.byte_ids[raw]
        done = np.full((len(pieces), width), -1, np.int32)
        rows, columns = np.arange(len(pieces)), np.arange(width)
        rank = self.merged(grid[:, :-1], grid[:, 1:])
        while len(rows):
            at = rank.argmin(axis=1)
            least = rank[np.arange(len(rows)), at]
            ended = least == NONE
            if ended.any():
                done[rows[ended], : grid.shape[1]] = grid[ended]
                going = ~ended
                grid, rank, rows, at, least = grid[going], rank[going], rows[going], at[going], least[going]
                if not len(rows):
                    break
            each = np.arange(len(rows))
            grid[each, at] = least
            behind = columns[None, :-1] > at[:, None]
            grid[:, :-1] = np.where(behind, grid[:, 1:], grid[:, :-1])
            grid[:, -1] = -1
            # ranks move with their left token
            rank[:, :-1] = np.where(behind[:, :-1], rank[:, 1:], rank[:, :-1])
            rank[:, -1] = NONE
            rank[each, at] = self.merged(grid[each, at], self._at(grid, each, at + 1))
            before = np.maximum(at - 1, 0)
            rank[each, before] = np.where(at > 0, self.merged(grid[each, before], grid[each, at]), rank[each, before])
            used = int((grid >= 0).sum(axis=1).max())
            if 2 <= used < grid.shape[1] - 2:
                grid, columns = grid[:, : used + 1], columns[: used + 1]
                rank = rank[:, :used]
        kept = done >= 0
        return done[kept], kept.sum(axis=1)

    @staticmethod
    def _at(grid: np.ndarray, each: np.ndarray, column: np.ndarray) -> np.ndarray:
        last = grid.shape[1] - 1
        return np.where(column <= last, grid[each, np.minimum(column, last)], -1)

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Tokens of one piece of any length."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        rank = np.append(self.merged(ids[:-1], ids[1:]), NONE)
        while len(ids) > 1 and (least := rank.min()) != NONE:
            at = np.flatnonzero(rank == least)
            fresh = np.append(True, np.diff(at) != 1)
            head = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - head) % 2 == 0]
            after, ranks, low = self._merge_at(ids, rank, at, least)
            if low <= least and len(at) > 1:
                after, ranks, _ = self._merge_at(ids, rank, at[:1], least)
            ids, rank = after, ranks
        return ids

    def _merge_at(
        self, ids: np.ndarray, rank: np.ndarray, at: np.ndarray, token: np.int64
    ) -> tuple[np.ndarray, np.ndarray, np.int64]:
        """Tokens and ranks after merging the pairs at `at`, and the least rank that this made."""
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        ids, rank = np.where(np.isin(np.arange(len(ids)), at), token, ids)[keep], rank[keep]
        moved = at - np.arange(len(at))
        touched = np.unique(np.concatenate([moved, np.maximum(moved - 1, 0)]))
        last = len(ids) - 1
        follows = np.where(touched < last, ids[np.minimum(touched + 1, last)], -1)
        rank[touched] = self.merged(ids[touched], follows)
        return ids, rank, rank[touched].min()

    def merge(self, pieces: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Tokens of pieces, in an order of its own: that order, all ids on end, and how many each has."""
        by_width: dict[int, list[int]] = {}
        raw = [p.encode("utf-8", "replace") for p in pieces]
        whole = list(map(self.ranks.get, raw))
        order = [k for k, rank in enumerate(whole) if rank is not None]
        flat, counts = [np.array([whole[k] for k in order], np.int32)], [np.ones(len(order), np.int64)]
        for k, rank in enumerate(whole):
            if rank is None:
                by_width.setdefault(min(-(-len(raw[k]) // 4) * 4, LONG + 1), []).append(k)
        for width, members in by_width.items():
            if width > LONG:
                tokens = [self.merge_long(raw[k]) for k in members]
                ids, size = np.concatenate(tokens), np.array([len(t) for t in tokens])
            else:
                ids, size = self.merge_rows([raw[k] for k in members], width)
            order += members
            flat.append(ids)
            counts.append(size)
        return order, np.concatenate(flat), np.concatenate(counts)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids on end."""
        size = self.starts[ids + 1] - self.starts[ids]
        ends = np.cumsum(size)
        if not len(ids) or not ends[-1]:
            return np.zeros(0, np.uint8)
        return self.flat[np.repeat(self.starts[ids] - (ends - size), size) + np.arange(ends[-1])]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One table per worker process; the file is part of the installed tokenizer package."""
    return Vocabulary(read_ranks(path))


class Encoder:
    """Encodes lists of texts; remembers the pieces it has met, up to a bound."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary, self.exact, self.quick = vocabulary(path), splitter(pattern), quick_splitter(pattern)
        self._forget()

    def split(self, text: str) -> list[str]:
        if self.quick:
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            if not self.quick[1][points].any():
                return self.quick[0].findall(text)
        return self.exact.findall(text)

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and where each text's ids start and the last ones end."""
        if len(self.index) > CACHE_PIECES:
            self._forget()
        pieces = [self.split(t) for t in texts]
        fresh = [p for p in set().union(*pieces) if p not in self.index]
        if fresh:
            order, flat, size = self.vocabulary.merge(fresh)
            known = len(self.index)
            self.index.update(zip(map(fresh.__getitem__, order), range(known, known + len(fresh)), strict=True))
            self.flat = np.concatenate([self.flat, flat])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(size)])
        counts = np.array([len(p) for p in pieces], np.int64)
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(pieces)), np.int32, int(counts.sum()))
        size = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[at] - (ends - size), size) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, bounds


def chunks(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about `most` units each; a longer row is a slice of its own."""
    start, total = 0, 0
    for k, size in enumerate(sizes):
        if k > start and total + size > most:
            yield batch.slice(start, k - start)
            start, total = k, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def text_sizes(column: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.binary_length(column), 0))


def _with(batch: pa.RecordBatch, names: list[str], *more: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *more], names=names)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with the token ids of `text` in `ids` (array<int>); without special tokens."""
    if ids in df.columns:
        raise ValueError(f"{ids} is already a column")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for batch in batches:
            for part in chunks(batch, text_sizes(batch.column(batch.schema.get_field_index(text))), CHUNK_CHARS):
                column = part.column(part.schema.get_field_index(text))
                flat, bounds = encoder.encode([t or "" for t in column.to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
                yield _with(part, [*part.schema.names, ids], lists)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`df` with the bytes of `ids` in `out` (binary); null ids decode to no bytes."""
    if out in df.columns:
        raise ValueError(f"{out} is already a column")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            counts = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
            for part in chunks(batch, counts, CHUNK_CHARS):
                column = part.column(part.schema.get_field_index(ids))
                counts = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
                tokens = np.asarray(column.flatten(), np.int64)
                raw = table.decode(tokens)
                size = table.starts[tokens + 1] - table.starts[tokens]
                ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
                binary = pa.Array.from_buffers(
                    pa.binary(), part.num_rows,
                    [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())],
                )
                yield _with(part, [*part.schema.names, out], binary)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())]))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: number of tokens, digest of the decimal ids, digest of the decoded bytes."""
    coded = decode(encode(docs.select("doc_id", "text"), path, pattern), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
