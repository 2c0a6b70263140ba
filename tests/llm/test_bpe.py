"""Token ids against the public tokenizer library itself, and the exact round trip."""

import base64

import pytest

from reconspark.llm.bpe import Encoder, token_counts, token_ids, vocabulary

tiktoken = pytest.importorskip("tiktoken")
RANKS, PATTERN = vocabulary()

HARD = [
    "", "a" * 3000, "=" * 5000, "hello  world\n\n\t x", "　全角　空格 ﬁ été свод № 7 🙏🚚👍", "<|endoftext|>", "it's we'll I'D 'S", "aaaabbbbaaaab" * 50,
    "​﻿\x00\x01", "不可撤销之审计机构终止确认或有负债" * 40, "1234567890" * 30, " " * 100, "\r\n\r\n  \r\n", "ababababab" * 77, "🙏" * 50,
]


@pytest.fixture(scope="module")
def oracle():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), {v: k for k, v in ranks.items()}


def test_hard_texts(oracle):
    encoder = Encoder(RANKS, PATTERN)
    for text in HARD:
        ids = encoder.encode(text)
        assert ids == oracle[0].encode_ordinary(text)
        assert b"".join(oracle[1][i] for i in ids).decode() == text
    assert encoder.encode(None) == []


def test_random_bytes_of_few_letters(oracle):
    import random

    rng, encoder = random.Random(7), Encoder(RANKS, PATTERN)
    for _ in range(3000):
        text = "".join(rng.choice("abtehinsoé审 计") for _ in range(rng.randrange(1, 40)))
        assert encoder.encode(text) == oracle[0].encode_ordinary(text)


def test_table(spark, tiny, oracle):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: list(r.ids) for r in token_ids(docs).collect()}
    assert got == {k: oracle[0].encode_ordinary(v or "") for k, v in rows.items()}
    counts = {r.doc_id: r.tokens for r in token_counts(docs, ("doc_id", "source")).collect()}
    assert counts == {k: len(v) for k, v in got.items()}
    assert token_ids(docs.limit(0)).count() == 0


def test_random_characters_of_many_scripts(oracle):
    """Characters that tokens join across their border and such that none joins, in any order."""
    import random

    rng, encoder = random.Random(3), Encoder(RANKS, PATTERN)
    blocks = ((0x4E00, 0x9FFF), (0x20, 0x7F), (0x80, 0x800), (0x3040, 0x30FF), (0x1F300, 0x1F6FF))
    pool = [chr(rng.randrange(*rng.choice(blocks))) for _ in range(400)] + list("の裏覚醒龍喚士契極 ") * 8
    for _ in range(4000):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(1, 30)))
        assert encoder.encode(text) == oracle[0].encode_ordinary(text)
    assert any(encoder.apart.values()) and not all(encoder.apart.values())
