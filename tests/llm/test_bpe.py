from __future__ import annotations

import random

import public_tokenizers
import tiktoken

from recordforge.llm import bpe

PATH = public_tokenizers.path(bpe.RANKS)
PARTS = ["'s", "'", "''", "'re", "'r", "ve", "'ll", " ", "  ", "\n", "\t", " ", "　", "a", "é", "1", "²", "!", "😀", "中", "\x1c", "\x85", "'T", "s", "<|endoftext|>", "\r\n", "=", " "]


def _reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.coder(PATH).ranks, special_tokens={})


def test_same_ids_as_the_library():
    random.seed(4)
    texts = ["".join(random.choice(PARTS) for _ in range(random.randint(0, 15))) for _ in range(5000)]
    texts += ["a" * 4000, "=" * 999, " " * 700 + "x", "", "x'" * 200, "thisisaverylongword" * 40]
    encoding = _reference()
    assert bpe.coder(PATH).encode(texts) == [encoding.encode_ordinary(t) for t in texts]


def test_scan_does_not_depend_on_blocks():
    text = "it's   a test, isn't it?\n\n" * 400
    encoding = _reference()
    for cut in (0, 1, 255, 256, 257, 1000):
        assert bpe.coder(PATH).encode([text[cut:]]) == [encoding.encode_ordinary(text[cut:])]


def test_cache_limit_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 5)
    coder = bpe.Coder(PATH)
    texts = [f"word{i} and other{i * 7} things" for i in range(200)]
    encoding = _reference()
    for t in texts:
        assert coder.encode([t]) == [encoding.encode_ordinary(t)]


def test_round_trip_keeps_rows_and_columns(spark):
    rows = [(1, "Hello there, it's 5 o'clock", "a"), (2, None, "b"), (3, "", None), (None, "Ünïcode 😀 " * 3000, "c"), (1, "Hello there, it's 5 o'clock", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(df, PATH), PATH)
    assert out.columns == ["doc_id", "text", "ids", "ends", "decoded"]
    found = out.collect()
    assert len(found) == 5
    for r in found:
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
        assert len(r["ids"]) == len(r["ends"]) and (not r["ends"] or r["ends"][-1] == len((r["text"] or "").encode()))
    both = bpe.both_ways(df, PATH)
    assert both.columns == out.columns and sorted(map(str, both.collect())) == sorted(map(str, found))
    assert bpe.encode(df.limit(0), PATH).count() == 0
