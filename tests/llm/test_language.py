from __future__ import annotations

import itertools
import random

import numpy as np

from recordforge.llm import language

WORDS = {
    "en": "the of and thing with which house ring water over under there were".split(),
    "de": "der die und nicht schon haus über wasser straße würde zwischen einer".split(),
    "es": "el la de que niño agua sobre casa entonces mañana ciudad pero".split(),
}


def _docs(spark, n=90):
    random.seed(2)
    rows = []
    for i in range(n):
        lang = list(WORDS)[i % 3]
        rows.append((i, " ".join(random.choice(WORDS[lang]) for _ in range(30)), lang, "z"))
    rows += [(n, None, "en", "z"), (n + 1, "12 34 !", "en", "z"), (n + 2, "", None, "z"), (None, "the house", "en", "z"), (3, rows[3][1], rows[3][2], "z"), (n + 3, "the water " * 20_000, None, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")


def test_forward_backward_is_exact():
    rng = np.random.default_rng(1)
    lengths = np.array([4, 1, 0, 3])
    emission, transition = rng.normal(size=(8, 3)), rng.normal(size=(3, 3))
    found = language.forward_backward(emission, transition, lengths)
    at = 0
    for n in lengths:
        expected = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            w = np.exp(sum(emission[at + t, k] for t, k in enumerate(path)) + sum(transition[a, b] for a, b in zip(path, path[1:])))
            for t, k in enumerate(path):
                expected[t, k] += w
        if n:
            assert np.allclose(found[at : at + n], expected / expected.sum(axis=1, keepdims=True))
        at += n


def _log_likelihood(emission, transition, lengths, gold):
    total, at = 0.0, 0
    for n in lengths:
        score = lambda path: sum(emission[at + t, k] for t, k in enumerate(path)) + sum(transition[a, b] for a, b in zip(path, path[1:]))  # noqa: B023, E731
        total += score(gold[at : at + n]) - np.log(sum(np.exp(score(path)) for path in itertools.product(range(emission.shape[1]), repeat=int(n))))
        at += n
    return total


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(3)
    lengths, gold = np.array([4, 1, 5]), rng.integers(0, 3, 10)
    emission, transition = rng.normal(size=(10, 3)), rng.normal(size=(3, 3))
    p, expected = language.expectations(emission, transition, lengths)
    seen, at = np.zeros((3, 3)), 0
    for n in lengths:
        for t in range(1, n):
            seen[gold[at + t - 1], gold[at + t]] += 1
        at += n
    step = 1e-5
    for array, gradient in ((transition, seen - expected), (emission, np.eye(3)[gold] - p)):
        for place in np.ndindex(array.shape):
            before = array[place]
            array[place] = before + step
            up = _log_likelihood(emission, transition, lengths, gold)
            array[place] = before - step
            down = _log_likelihood(emission, transition, lengths, gold)
            array[place] = before
            assert abs((up - down) / (2 * step) - gradient[place]) < 1e-6


def test_a_language_of_long_texts_only_is_learned(spark):
    random.seed(4)
    long = lambda lang: " ".join(random.choice(WORDS[lang]) for _ in range(9000))
    rows = [(i, long("de") if i % 2 else " ".join(random.choice(WORDS["en"]) for _ in range(30)), "de" if i % 2 else "en") for i in range(12)]
    rows.append((99, "wasser der straße", None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert min(len(r[1]) for r in rows if r[2] == "de") > language.SAMPLE_CHARS
    model = language.train(docs)
    assert model.languages == ["de", "en"]
    assert {r["doc_id"]: r["lang_pred"] for r in language.text_languages(docs, model).collect()} == {i: r[2] or "de" for i, r in zip([*range(12), 99], rows)}
    spans = docs.select(language._spans("text").alias("t"), "text").collect()
    for r in spans:
        assert len(r["t"]) <= language.SAMPLE_CHARS + 100 and set(r["t"].split()) <= set(r["text"].split())


def test_combining_marks_belong_to_words():
    assert language.words_of("e\u0301te\u0301 \u0928\u092e\u0938\u094d\u0924\u0947 x") == ["e\u0301te\u0301", "\u0928\u092e\u0938\u094d\u0924\u0947", "x"]


def test_clashing_columns(spark):
    docs = _docs(spark).withColumn("score", language.F.lit("own"))
    found = language.text_languages(docs, language.train(docs))
    assert found.columns.count("score") == 1 and dict(found.dtypes)["score"] == "double"


def test_documents_and_odd_rows(spark):
    docs = _docs(spark)
    model = language.train(docs)
    found = language.text_languages(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    for r in found.collect():
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (90, 91, 92):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] == (r["lang"] or "en")


def test_a_text_without_letters_has_no_words():
    assert language.words_of("½ ² 12 _ Ⅷ") == [] and language.words_of("½ a2b") == ["½", "a", "b"]


def test_words_of_mixed_text(spark):
    model = language.train(_docs(spark))
    df = spark.createDataFrame([(1, "the house with water der die und nicht el agua que mañana"), (2, None)], "id long, text string")
    words = {r["id"]: r["words"] for r in language.word_languages(df, model).collect()}
    assert [w["lang"] for w in words[1]] == ["en"] * 4 + ["de"] * 4 + ["es"] * 4
    assert words[2] == []


def test_cache_limit_changes_nothing(spark, monkeypatch):
    model = language.train(_docs(spark))
    texts = [language.words_of("the haus of niño entonces über ring"), language.words_of("schon with casa"), []]
    before = model.marginals(texts)[0]
    monkeypatch.setattr(language, "CACHE", 3)
    model.known, model.emitted = {}, None
    assert np.allclose(before, np.concatenate([model.marginals([t])[0] for t in texts]))


def test_nothing_to_learn_from(spark):
    docs = _docs(spark)
    assert language.train(docs.limit(0)) is None
    assert {(r["lang_pred"], r["score"]) for r in language.text_languages(docs, None).collect()} == {("und", 0.0)}
