"""BPE against the reference encoder, and round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from hiremart.llm import bpe as B

RANKS = B.load_ranks(P.path("byte_bpe_50k.tiktoken"))
OURS = B.MergeReplay(RANKS, P.PATTERN)
THEIRS = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=6))
def test_any_text_equals_the_other_encoder_and_decodes(texts):
    for text, ids in zip(texts, OURS.encode_all(texts)):
        assert ids.tolist() == THEIRS.encode_ordinary(text)
        assert OURS.decode(ids) == text.encode()


def test_repetitive_and_long_texts(monkeypatch):
    monkeypatch.setattr(B, "BLOCK_BYTES", 500)
    monkeypatch.setattr(B, "KEPT_WORDS", 50)
    monkeypatch.setattr(B, "LONG_PIECE", 100)
    rng = random.Random(1)
    texts = ["a" * 3000, "ab" * 700, " " * 400, "é" * 900, "\n\n \n" * 50, "<|endoftext|>", "", None, " ".join("".join(rng.choices("abcde", k=9)) for _ in range(600))]
    replay = B.MergeReplay(RANKS, P.PATTERN)
    assert [x.tolist() for x in replay.encode_all(texts)] == [THEIRS.encode_ordinary(t or "") for t in texts]


def test_a_long_piece_is_not_quadratic():
    import time

    rng = random.Random(3)
    for text in ("ng" * 500_000, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)), "!?" * 100_000 + "é" * 100_000, "1" * 300_000, "a" * 300_000):
        t = time.time()
        got = next(OURS.encode_all([text]))
        assert time.time() - t < 60
        assert OURS.decode(got) == text.encode()
    for text in ("ng" * 3000, "".join(rng.choices("inger", k=5000)), "aab" * 900, "é" * 1500, "=" * 2500):
        assert next(OURS.encode_all([text])).tolist() == THEIRS.encode_ordinary(text)


SPACES = [" ", "\n", "  ", "\n\n", " \n", "\n ", "\t", "\r\n", "\u00a0", "\u3000", "\x1c", "\x1f", "\x01", "\x85", "\u200b", "\u2028", "\x0b "]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*SPACES, "a", "The", "é", "'s", "12", "!", ".", "中"]), max_size=14).map("".join), max_size=5))
def test_cutting_at_blanks_changes_nothing(texts):
    for text, ids in zip(texts, OURS.encode_all(texts)):
        assert ids.tolist() == THEIRS.encode_ordinary(text)


def test_words_are_forgotten_and_met_again(monkeypatch):
    monkeypatch.setattr(B, "KEPT_WORDS", 40)
    monkeypatch.setattr(B, "BLOCK_BYTES", 300)
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(200)]
    texts = [" ".join(rng.choices(vocabulary, k=30)) for _ in range(300)]
    replay = B.MergeReplay(RANKS, P.PATTERN)
    assert [x.tolist() for x in replay.encode_all(texts)] == [THEIRS.encode_ordinary(t) for t in texts]
    assert len(replay.words.index) <= 200


def test_ranks_that_turn_back():
    """A merge may bring a lower rank into reach; the leftmost lowest goes first."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"abc": 260, b"cb": 290, b"bcb": 280, b"aa": 270, b"aab": 299}
    ours, theirs = B.MergeReplay(ranks, r"\w+"), tiktoken.Encoding("x", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    texts = ["".join(rng.choices("abc", k=rng.randint(1, 30))) for _ in range(3000)]
    assert [x.tolist() for x in ours.encode_all(texts)] == [theirs.encode_ordinary(t) for t in texts]
    assert [list(ours.replay_long(t.encode())) for t in texts if len(t) > 1] == [theirs.encode_ordinary(t) for t in texts if len(t) > 1]


def test_digest_query(spark, documents):
    rows = [(1, "Hello world"), (2, None), (3, ""), (None, "no id"), (3, "twice"), (3, "twice")]
    got = sorted(map(tuple, B.bpe_digest(documents(rows), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()), key=str)
    want = []
    for i, t in rows:
        ids = THEIRS.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert B.bpe_digest(documents([]), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect() == []
