from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from recordforge.llm import pieces

PATH = public_tokenizers.path(pieces.MODEL)
PARTS = [" ", "  ", "▁", "\n", "\t", "the", "an", "é", "é", "①", "中", "😀", "　", "\xa0", "1", "42", "<s>", "<0x0A>", "<unk>", "\x00", "퟿", "ing", "​", "A", "!", "▁▁▁", "字", "    "]


def _texts(n=4000):
    random.seed(5)
    texts = ["".join(random.choice(PARTS) for _ in range(random.randint(0, 14))) for _ in range(n)]
    return [*texts, "", " " * 999, "▁" * 77, "a" * 5000, "nospaceatall" * 400, "①" * 300, "x " * 3000]


def _each(model, texts):
    *arrays, sizes = model.encode(texts)
    cuts = np.cumsum(sizes)[:-1]
    return list(zip(*(np.split(a, cuts) for a in arrays), strict=True))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_same_ids_spans_and_texts_as_the_library(library):
    model, texts = pieces.pieces(PATH), _texts()
    for text, (ids, begins, ends) in zip(texts, _each(model, texts), strict=True):
        found = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in found], text
        assert list(zip(begins.tolist(), ends.tolist(), strict=True)) == [(p.begin, p.end) for p in found], text
        assert model.decode(ids.tolist()) == library.decode(ids.tolist()), text


def test_spans_cover_the_text():
    text = "Ünïcode ①② 😀 and\n\n  words▁ "
    data = text.encode()
    ids, begins, ends = _each(pieces.pieces(PATH), [text])[0]
    assert b"".join(data[b:e] for b, e in zip(begins, ends, strict=True)) == data and len(ids) == len(begins)


def test_any_ids_decode_as_in_the_library(library):
    model = pieces.pieces(PATH)
    random.seed(6)
    for _ in range(3000):
        ids = [random.choice([0, 1, 2, *range(3, 259), 28705, 260, 1526, 22557]) for _ in range(random.randint(0, 6))]
        assert model.decode(ids) == library.decode(ids), ids


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf"])
@pytest.mark.parametrize("collapse", [True, False])
def test_compiled_character_maps(rule, collapse):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, remove_extra_whitespaces=collapse, add_dummy_prefix=True, escape_whitespaces=True)
    spec = {}
    for field, value in pieces.message(library.serialized_model_proto()):
        if field == 3:
            spec = dict(pieces.message(value))
    ours = pieces.Normaliser(spec[2], prefix=True, collapse=collapse)
    random.seed(7)
    parts = [*PARTS, "ﬁ", "ﬀ", "Å", "Å", "½", "Ｔ", "ｶﾞ", "¨", "가", "̈́", "ẞ", "Σ", " ", "­", "́", "㌔"]
    for _ in range(3000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 9)))
        normal, origin = ours(text)
        expected, offsets = library.normalize(text, with_offsets=True)
        assert normal == expected, (text, spec.keys())
        at = {0: 0}
        for k, c in enumerate(text):
            at[list(at)[-1] + len(c.encode())] = k + 1
        assert [at[o] for o in origin.tolist()] == list(offsets), text


def test_cache_and_long_words_change_nothing(monkeypatch, library):
    monkeypatch.setattr(pieces, "CACHE", 3)
    monkeypatch.setattr(pieces, "SIZES", (2, 4))
    monkeypatch.setattr(pieces, "SIDE", 3)
    with open(PATH, "rb") as file:
        model = pieces.Pieces(file.read())
    for text in _texts(300):
        assert model.encode([text])[0].tolist() == library.encode(text)


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        pieces.Pieces(b"")


def test_rows_and_columns(spark):
    rows = [(1, "Hello there", "a"), (2, None, "b"), (3, "", None), (None, "Ünïcode 😀 " * 30000, "c"), (1, "Hello there", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ends string")
    out = pieces.decode(pieces.encode(df, PATH), PATH)
    assert out.columns == ["doc_id", "text", "ids", "begins", "ends", "decoded"]
    found = out.collect()
    assert len(found) == 5
    for r in found:
        assert r["decoded"] == (r["text"] or "")
        assert len(r["ids"]) == len(r["begins"]) == len(r["ends"])
        assert not r["ends"] or r["ends"][-1] == len((r["text"] or "").encode())
    both = pieces.both_ways(df, PATH)
    assert both.columns == out.columns and sorted(map(str, both.collect())) == sorted(map(str, found))
    assert pieces.both_ways(df, PATH, drop_text=True).columns == ["doc_id", "ids", "begins", "ends", "decoded"]
    assert pieces.encode(df.limit(0), PATH).count() == 0


def test_query_against_the_library(spark, sf_dir, library):
    import hashlib

    found = {tuple(r) for r in pieces.op13_sentencepiece(spark, sf_dir).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = library.encode(r["text"] or "")
        expected.add((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert found == expected
