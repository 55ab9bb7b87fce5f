from __future__ import annotations

from llm_support import documents, sf_dir, workers  # noqa: F401

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from pitlake.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def odd_texts():
    random.seed(5)
    kinds = [(32, 127), (0xA0, 0x500), (0x3040, 0x9000), (1, 0x30), (0x1F600, 0x1F650), (0x2150, 0x2190)]
    made = [
        "".join(chr(random.randrange(*random.choice(kinds))) for _ in range(random.randrange(1, 200))) for _ in range(300)
    ]
    return ["", " ", "\n\n  \n x", "a" * 5000, "the" * 3000, " " * 777, "aaab" * 999, "it's we'll I'd", "é²Ⅷ\x85\x1f", *made]


def test_ids_equal_the_library_and_decode_back(reference):
    encoder = bpe.Encoder(PATH, PATTERN)
    texts = odd_texts()
    ids, bounds = encoder.encode(texts)
    for k, text in enumerate(texts):
        own = ids[bounds[k] : bounds[k + 1]]
        assert own.tolist() == reference.encode_ordinary(text)
        assert encoder.vocabulary.decode(own.astype("int64")).tobytes() == text.encode()


def test_forgetting_pieces_changes_nothing(monkeypatch, reference):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    encoder = bpe.Encoder(PATH, PATTERN)
    for text in ["one two three four five", "six one two seven", "one"]:
        assert encoder.encode([text])[0].tolist() == reference.encode_ordinary(text)


def test_chunks_keep_rows_whole_and_columns(spark, monkeypatch, reference):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 50)
    rows = [(k, t, "extra") for k, t in enumerate(odd_texts())] + [(None, None, None), (1, "repeated", "x"), (1, "repeated", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe.encode(df, PATH, PATTERN).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.text or "") for r in got if r.doc_id is not None) == sorted(
        (False, i, t or "") for i, t, _ in rows if i is not None
    )
    assert all(r.ids == reference.encode_ordinary(r.text or "") for r in got)


def test_digests(documents, reference):
    text = "Grüße, the end."
    got = {r.doc_id: r for r in bpe.digests(documents([(1, text), (2, None)]), PATH, PATTERN).collect()}
    ids = reference.encode_ordinary(text)
    assert got[1].n_tokens == len(ids)
    assert got[1].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got[1].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert (got[2].n_tokens, got[2].ids_sha256) == (0, hashlib.sha256(b"").hexdigest())


def test_empty_table_and_clashing_names(documents):
    docs = documents([])
    assert bpe.digests(docs, PATH, PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(docs.withColumnRenamed("lang", "ids"), PATH, PATTERN)
