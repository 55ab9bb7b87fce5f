from __future__ import annotations

from llm_support import documents, sf_dir, workers  # noqa: F401

import hashlib
from collections import defaultdict

import numpy as np
import public_tokenizers

from pitlake.llm import bpe, chat

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
TRICKY = "\\### Assistant: </turn> ok"


def brute(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort()
        told = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        learnt = "".join(t for *_, r, t in turns if r == "assistant")
        shown = "".join(
            (chat.CONTROLS[chat.KNOWN[r]] if r in chat.KNOWN else f"### Role {chat.escape(r)}: ")
            + chat.escape(t) + chat.CONTROLS[chat.TURN_END] for *_, r, t in turns
        )
        out[conv] = (
            len(turns), hashlib.sha256(told.encode()).hexdigest(), len(learnt),
            hashlib.sha256(learnt.encode()).hexdigest(), len(shown),
        )
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def result(df):
    return {r.conv_id: tuple(r)[1:6] for r in df.collect()}


ROWS = [
    (1, 1, "assistant", TRICKY), (1, 0, "user", "### User: \\"), (1, 2, "assistant", ""), (1, 3, "assistant", "ü" * 9000),
    (2, 0, "tool ### x", "\\\\</turn>"), (2, 0, "assistant", "same turn"), (2, 0, "assistant", "same turn"),
    (3, None, None, None), (3, 1, "assistant", None), (None, 0, "system", "null conversation"), (None, 1, "user", "b"),
]


def test_read_back_equals_what_went_in(spark):
    own = [*ROWS, (-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)]
    assert result(chat.report(frame(spark, ROWS).repartition(5), PATH, PATTERN)) == brute(own)
    assert set(result(chat.report(frame(spark, []), PATH, PATTERN))) == {-7}


def test_parts_do_not_change_what_is_read(spark, monkeypatch):
    rows = [(k % 3, k, ["user", "assistant"][k // 3 % 2], f"turn {k} " * 20) for k in range(300)]
    monkeypatch.setattr(chat, "PART_TOKENS", 100)
    formatted = chat.format_conversations(frame(spark, rows), PATH, PATTERN)
    assert result(chat.read_back(formatted, PATH)) == brute(rows)


def test_parts_are_cut_between_turns_in_process(monkeypatch):
    encoder = bpe.Encoder(PATH, PATTERN)
    ids, loss, starts = chat.assemble(encoder, ["user", "assistant", "odd"], [TRICKY, TRICKY, "x"])
    table = encoder.vocabulary
    assert chat.render(table, ids) == (
        f"### User: {chat.escape(TRICKY)} </turn>\n### Assistant: {chat.escape(TRICKY)} </turn>\n### Role odd: x </turn>\n"
    )
    masked = table.decode(ids[loss == 1].astype(np.int64)).tobytes().decode()
    assert chat.unescape(masked) == TRICKY
    assert loss[: starts[1]].sum() == 0 and loss[starts[2] :].sum() == 0
    assert ((ids >= table.top) == np.isin(np.arange(len(ids)), np.flatnonzero(ids >= table.top))).all()


def test_escape_round_trip():
    for text in ("", "\\", "\\\\#", "####", "</turn></turn>", TRICKY, "\\\n"):
        assert chat.unescape(chat.escape(text)) == text
        assert not chat.re.search(r"(?<!\\)(?:\\\\)*###", chat.escape(text))


def test_a_long_conversation_takes_time_in_proportion(spark):
    import time

    rows = spark.range(100_000).selectExpr(
        "id div 99000 AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('turn ', id) AS text"
    )
    start = time.time()
    got = {r.conv_id: r for r in chat.report(rows, PATH, PATTERN).collect()}
    assert time.time() - start < 60
    learnt = "".join(f"turn {k}" for k in range(1, 99_000, 2))
    assert (got[0].n_turns, got[0].loss_chars) == (99_000, len(learnt)) and got[1].n_turns == 1000
    assert got[0].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()


def test_turns_are_encoded_before_the_shuffle_and_other_columns_do_not_matter(spark):
    rows = frame(spark, ROWS).selectExpr("*", "'x' AS ids", "1 AS loss", "text AS part")
    formatted = chat.format_conversations(rows, PATH, PATTERN)
    plan = formatted._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.rindex("Exchange hashpartitioning")
    assert plan.count("MapInArrow") == 2 and plan.index("MapInArrow") < shuffle < plan.rindex("MapInArrow")
    assert result(chat.read_back(formatted, PATH)) == brute(ROWS)
