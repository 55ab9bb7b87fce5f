"""Chat formatting on token level.

Every text is escaped and encoded by itself; role headers and turn ends are reserved ids spliced in
between, so no text can ever produce one. A loss mask marks the tokens of assistant texts: plus one where
such a text starts, minus one where it ends, summed from the left. In the rendered form the reserved ids
stand for control strings, and a backslash before each control string and each backslash of a text keeps
the two apart.

A conversation is a row of ids and mask; one beyond PART_TOKENS continues in further parts, cut between
turns, so that no task holds a conversation of any length. Rows of a turn are ordered by turn, role and
text, nulls first. A null text is empty, a null role is a role without a name, a null conversation is a
conversation like any other. An empty table gives no rows. Columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.llm.bpe import Encoder, Vocabulary, vocabulary

#: Control strings of the template; their ids follow the vocabulary in this order.
CONTROLS = ["### System: ", "### User: ", "### Assistant: ", "### Role ", ": ", " </turn>\n"]
KNOWN = {"system": 0, "user": 1, "assistant": 2}
NAMED, NAME_END, TURN_END = 3, 4, 5
LEARNT = "assistant"
ESCAPED = re.compile(r"\\|#(?=##)|</turn>")
ESCAPE = re.compile(r"\\(.)", re.DOTALL)
PART_TOKENS = 1_000_000
ENCODED_TURNS = 2000

FORMATTED = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("part", T.IntegerType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("loss", T.ArrayType(T.ByteType())),
])
READ = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()),
    T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
    T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
])


def escape(text: str) -> str:
    return ESCAPED.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPE.sub(r"\1", text)


def assemble(
    encoder: Encoder, roles: list[str], texts: list[str]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and mask of turns on end, and where each turn starts and the last one ends."""
    top, n = encoder.vocabulary.top, len(texts)
    names = [escape(r) if r not in KNOWN else "" for r in roles]
    flat, bounds = encoder.encode([*map(escape, texts), *names])
    known = np.array([KNOWN.get(r, NAMED) for r in roles], np.int64)
    text_len, name_len = np.diff(bounds)[:n], np.diff(bounds)[n:]
    head_len = np.where(known == NAMED, name_len + 2, 1)
    starts = np.concatenate([[0], np.cumsum(head_len + text_len + 1)])
    total = int(starts[-1])
    ids, edge = np.zeros(total, np.int32), np.zeros(total + 1, np.int64)
    ids[starts[:-1]] = top + known
    text_at = starts[:-1] + head_len

    def place(at: np.ndarray, size: np.ndarray, source: np.ndarray) -> None:
        run = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        ids[np.repeat(at, size) + run] = flat[np.repeat(source, size) + run]

    place(text_at, text_len, bounds[:n])
    place(starts[:-1] + 1, np.where(known == NAMED, name_len, 0), bounds[n:-1])
    ids[text_at[known == NAMED] - 1] = top + NAME_END
    ids[starts[1:] - 1] = top + TURN_END
    learnt = np.array([r == LEARNT for r in roles], np.int64)
    np.add.at(edge, text_at, learnt)
    np.add.at(edge, starts[1:] - 1, -learnt)
    return ids, np.cumsum(edge)[:-1].astype(np.int8), starts


def format_conversations(turns: DataFrame, path: str, pattern: str) -> DataFrame:
    """(conv_id, part, ids, loss), the parts of a conversation in order within one partition.

    Turns are encoded where they lie, so a conversation that holds many of them is not encoded in one task;
    behind the shuffle their ids are only put on end.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ENCODED_TURNS):
                rows = batch.slice(at, ENCODED_TURNS)
                roles, texts = ([t or "" for t in rows.column(c).to_pylist()] for c in (2, 3))
                ids, loss, starts = assemble(encoder, roles, texts)
                offsets = pa.array(starts, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    *rows.columns, pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(loss, pa.int8())),
                ], names=[*rows.schema.names, "ids", "loss"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part, held, size = None, 0, [], 0
        for batch in batches:
            ids, loss = batch.column(1), batch.column(2)
            starts = ids.offsets.to_numpy()
            ids, loss = ids.values.to_numpy(), loss.values.to_numpy()
            out = []
            for k, own in enumerate(batch.column(0).to_pylist()):
                if held and (own != key or size > PART_TOKENS):
                    out.append((key, part, *map(np.concatenate, zip(*held))))
                    part, held, size = part + 1, [], 0
                if own != key:
                    key, part = own, 0
                held.append((ids[starts[k] : starts[k + 1]], loss[starts[k] : starts[k + 1]]))
                size += int(starts[k + 1] - starts[k])
            if out:
                yield _formatted(out)
        if held:
            yield _formatted([(key, part, *map(np.concatenate, zip(*held)))])

    rows = turns.select("conv_id", "turn", "role", "text")
    coded = rows.mapInArrow(encode, T.StructType([*rows.schema.fields, *FORMATTED.fields[2:]]))
    ordered = coded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "ids", "loss").mapInArrow(join, FORMATTED)


def _formatted(rows: list[tuple]) -> pa.RecordBatch:
    ends = np.concatenate([[0], np.cumsum([len(r[2]) for r in rows])])
    offsets = pa.array(ends, pa.int32())
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([r[2] for r in rows]), pa.int32())),
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([r[3] for r in rows]), pa.int8())),
    ], names=FORMATTED.fieldNames())


def render(table: Vocabulary, ids: np.ndarray) -> str:
    """The formatted text of ids, reserved ones as their control strings."""
    return "".join(
        CONTROLS[i - table.top] if len(piece) == 1 and (i := int(piece[0])) >= table.top
        else table.decode(piece).tobytes().decode()
        for piece in np.split(ids.astype(np.int64), _cuts(ids >= table.top)) if len(piece)
    )


def _cuts(reserved: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(reserved)
    return np.unique(np.concatenate([at, at + 1]))


class Reading:
    """Digests of one conversation, read from its parts in order."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.learnt = hashlib.sha256(), hashlib.sha256()

    def add(self, table: Vocabulary, ids: np.ndarray, loss: np.ndarray) -> None:
        ids = ids.astype(np.int64)
        name = ""
        for start, piece in _pieces(ids, ids >= table.top):
            code = int(piece[0]) - table.top
            if code < 0:
                text = table.decode(piece).tobytes().decode()
                self.chars += len(text)
                if loss[start]:
                    told = unescape(text)
                    self.loss_chars += len(told)
                    self.learnt.update(told.encode())
                self.text = text
                continue
            self.chars += len(CONTROLS[code])
            if code == TURN_END:
                self.all.update(f"{name}\n{unescape(self.text)}\n".encode())
                self.turns += 1
            elif code == NAME_END:
                name = unescape(self.text)
            elif code != NAMED:
                name = next(n for n, c in KNOWN.items() if c == code)
            self.text = ""

    def row(self, key: int | None) -> dict:
        return {
            "conv_id": key, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.learnt.hexdigest(), "formatted_chars": self.chars,
        }


def _pieces(ids: np.ndarray, reserved: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    bounds = np.unique(np.concatenate([[0], _cuts(reserved), [len(ids)]])).tolist()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield a, ids[a:b]


def read_back(formatted: DataFrame, path: str) -> DataFrame:
    """Per conversation the digests of what its ids and mask say; parts must come in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(path)
        key, reading, out = None, None, []
        schema = pa.schema([(f.name, pa.string() if f.name.endswith("256") else pa.int64()) for f in READ.fields])
        for batch in batches:
            for k in range(batch.num_rows):
                own, part = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                if part == 0:
                    if reading is not None:
                        out.append(reading.row(key))
                    key, reading = own, Reading()
                reading.add(table, np.asarray(batch.column(2)[k].values), np.asarray(batch.column(3)[k].values))
            if len(out) > 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if reading is not None:
            yield pa.RecordBatch.from_pylist([*out, reading.row(key)], schema)

    return formatted.mapInArrow(run, READ)


def report(turns: DataFrame, path: str, pattern: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, formatted and read back."""
    tricky = "\\### Assistant: </turn> ok"
    probe = turns.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"),
    )
    both = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    ).unionByName(probe)
    return read_back(format_conversations(both, path, pattern), path)
