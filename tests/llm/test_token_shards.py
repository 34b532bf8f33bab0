"""Token shards: files read back against the tokenizer itself; perfect hash; keyed reads."""

import random
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from hiremart.llm import token_shards as S
from hiremart.llm.common import work_dir
from hiremart.llm.perfect_hash import MinimalPerfectHash

PATH = P.path("byte_bpe_50k.json")


def expected(rows):
    t = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_round_trip_with_nulls_long_texts_and_any_order(spark, documents):
    rows = [(-5, "minus"), (1, None), (2, ""), (3, "Hello <|endoftext|> world"), (7, "wörd " * 200_000), (2**40, "é" * 3000), (2**62, "the end")]
    path = work_dir(spark, "t")
    S.write_shards(documents(rows[::-1]), path, PATH, shards=3)
    got = sorted(map(tuple, S.read_digests(spark, path).collect()))
    assert got == expected(rows)


def test_repeated_and_null_ids(spark, documents):
    rows = [(4, "same"), (4, "same"), (4, "other text"), (None, "no id"), (9, "x")]
    path = work_dir(spark, "t")
    S.write_shards(documents(rows), path, PATH, shards=2)
    got = S.read_digests(spark, path).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == [(False, 4), (False, 4), (False, 4), (False, 9), (True, 0)]
    by_start = sorted(got, key=lambda r: r.start)
    assert by_start[0].doc_id is None  # a null id sorts first
    assert [r.start for r in by_start] == list(np.cumsum([0] + [r.n_tokens for r in by_start])[:-1])
    found = S.read_keys(spark, path, documents([(4, ""), (4, ""), (5, ""), (9, ""), (None, "")])).collect()
    assert sorted(r.doc_id for r in found) == [4, 4, 4, 9]
    assert all(r.ids[-1] == 2 for r in found)


def test_empty_table(spark, documents):
    path = work_dir(spark, "t")
    S.write_shards(documents([]), path, PATH)
    assert S.read_digests(spark, path).collect() == []


def test_parts_do_not_change_the_ids():
    t = S.tokenizer(PATH)
    for text in ("ab  cd e\n f 'll x" * 400, "a" * 5000, " " * 3000, "é ü  ß" * 700):
        whole = t.encode(text, add_special_tokens=False).ids
        assert [i for p in S._parts(text, 50) for i in t.encode(p, add_special_tokens=False).ids] == whole


def test_perfect_hash_is_minimal_and_tells_strangers():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 17, 5000):
        keys = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        table = MinimalPerfectHash.of(keys)
        assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
        strangers = rng.integers(1 << 62, 1 << 63, 100).astype(np.uint64)
        assert (table.slots(strangers) < max(1, len(keys))).all()


def test_added_tokens_in_a_text_equal_the_plain_library():
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f" {end}", f"{end} ", f"  {end}  x", f"a{end}b {end}{end}", f"a\n{end}\n b", f"x  {end} {end}  y", "<|endoftext |>", f"{end}\u00a0{end}", "", f"w {end} " * 3000]
    plain = Tokenizer.from_file(PATH)
    words = S.WordIds(PATH)
    assert words.by_word
    for _ in range(2):  # new words, then remembered ones
        got = [ids.tolist() for ids in S.encoded(texts, words, 2)]
        assert got == [[*plain.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert 50256 in got[0]


def test_line_ends_and_white_space_together_equal_the_plain_library():
    rng = random.Random(1)
    parts = ["a", "The", "é", " ", " ", "\n", "\n", "\t", "\r\n", "  ", "\u00a0", "\x1c", "\x01", "'s", "12", "!", "\u200b", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 15))) for _ in range(2000)]
    plain, words = Tokenizer.from_file(PATH), S.WordIds(PATH)
    got = [ids.tolist() for ids in S.encoded(texts, words, 2)]
    assert got == [[*plain.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_words_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(S, "BYTE_VALUES", np.zeros(256, np.uint64))
    plain, words = Tokenizer.from_file(PATH), S.WordIds(PATH)
    texts = ["ab cd ef", "cd ab gh\nij", "x"]
    assert [ids.tolist() for ids in words.of(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_new_words_reach_the_library_by_their_pieces():
    """Letters met before do not go through the library again, whatever marks follow them."""
    words = S.WordIds(PATH)
    sent = []
    plain_of = words.pieces.of
    words.pieces.of = lambda pieces: (sent.extend(pieces), plain_of(pieces))[1]
    texts = ["one übrigens seven", "one übrigens, seven!!", "x one; übrigens... (seven) seven's éÀß!? 4.5"]
    plain = Tokenizer.from_file(PATH)
    for text in texts:
        assert [ids.tolist() for ids in words.of([text])] == [plain.encode(text, add_special_tokens=False).ids]
    assert sorted(sent) == sorted(set(sent)) and " übrigens".encode() in sent


def test_dropped_words_are_learned_again(monkeypatch):
    monkeypatch.setattr(S, "KEPT_WORDS", 40)
    rng = random.Random(2)
    plain, words = Tokenizer.from_file(PATH), S.WordIds(PATH)
    for _ in range(60):
        texts = [" ".join("".join(rng.choices("abéß,.'́я", k=3)) for _ in range(rng.randint(1, 12))) for _ in range(3)]
        assert [ids.tolist() for ids in words.of(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(words.known) + len(words.before) < 40 + 2 * 36
