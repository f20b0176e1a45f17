"""Language of words and texts by a linear-chain conditional random field.

Each word (a run of letters, lower case) has hashed features: the word itself (lexicon) and its character n-grams of two to four
with word-boundary marks, so that those at the marks are prefixes and suffixes.  A word's emission is the sum of its feature
weights by language; learned transitions score neighbouring words.  Training maximises the likelihood of the word labels
by gradients from forward-backward.  ``word_languages`` labels each word of code-switched text by its marginal,
``text_languages`` gives a text the language with the largest sum of marginals and its share as score.

Fit: on a bounded sample of labelled texts, ``SAMPLE`` of each language (the smallest hashes of the id), of a text longer than
``SAMPLE_CHARS`` characters as many from ``SLICES`` places all over it.  They are cut into spans that are strung together in mixed
order, so that switches between languages are seen.

Scale: the model is a fixed-size array that travels with the task; texts are scored where they lie, without a shuffle.  A
sub-batch keeps its texts sorted by length, and one numpy step advances all chains that are still running.

Nulls: texts that are null or have no letter are ``und`` with score 0.  Rows without a language, or with a null id, are not
learned from.  With no labelled row every text is ``und``.  Ties go to the first language in sort order.  Repeated rows
and any other columns pass through; result columns of clashing names are replaced.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordforge.llm.common import table
from recordforge.llm.registry import query

SAMPLE = 150
SAMPLE_CHARS = 20_000
SLICES = 20
BUCKETS = 1 << 17
CHARS = 8_000_000
CACHE = 300_000


def _ranges(codes: Iterable[int]) -> str:
    """Code points as the inside of a character class."""
    runs: list[list[int]] = []
    for code in codes:
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"{re.escape(chr(i))}-{re.escape(chr(j))}" for i, j in runs)


#: Letters with the combining marks that follow them.
WORD = re.compile(rf"[^\W\d_]+(?:[{_ranges(c for c in range(0x300, 0x20000) if unicodedata.category(chr(c))[0] == 'M')}]+[^\W\d_]*)*")
OPEN, CLOSE = 1, 2  # code points that no word holds


def words_of(text: str | None) -> list[str]:
    """Runs of letters and other word characters but digits, lower case; none if the text has no letter at all."""
    words = WORD.findall((text or "").lower())
    if any(map(str.isalpha, words)) or any(c.isalpha() for w in words for c in w):
        return words
    return []


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, feature bucket) of all features of ``words``."""
    joined = "\x01" + "\x02\x01".join(words) + "\x02"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    number = np.cumsum(codes == OPEN) - 1
    rows, buckets = [], []
    mixed = codes * np.uint64(0x9E3779B97F4A7C15)
    rolled = mixed
    for n in (2, 3, 4):
        rolled = (rolled[:-1] ^ (rolled[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + mixed[n - 1 :]
        inside = number[: len(rolled)] == number[n - 1 :]
        rows.append(number[: len(rolled)][inside])
        buckets.append((rolled[inside] + np.uint64(n)) * np.uint64(0x94D049BB133111EB) >> np.uint64(47))
    starts = np.flatnonzero(codes == OPEN)
    place = (np.arange(len(codes)) - starts[number]).astype(np.uint64)
    whole = np.add.reduceat(mixed * (np.uint64(2) * place + np.uint64(0x632BE59BD9B4E019)), starts)
    rows.append(np.arange(len(words)))
    buckets.append((whole ^ (whole >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(47))
    return np.concatenate(rows), np.concatenate(buckets).astype(np.int64)


def _summed(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(rows, weights=values[:, k], minlength=n) for k in range(values.shape[1])], axis=1)


def chains(emission: np.ndarray, transition: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward messages of every position, and the emission and transition potentials they come from.

    Chains of ``lengths`` lie one after the other in ``emission``.  Scores are logarithms; messages and potentials are scaled.
    """
    total, k = emission.shape
    e = np.exp(emission - emission.max(axis=1, keepdims=True)) if total else emission
    m = np.exp(transition - transition.max())
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    running = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")
    alpha, beta = np.empty((total, k)), np.ones((total, k))
    a = np.full((len(lengths), k), 1.0 / k)
    for t, n in enumerate(running.tolist()):
        at = starts[:n] + t
        a = (a[:n] @ m if t else a[:n]) * e[at]
        a /= a.sum(axis=1, keepdims=True)
        alpha[at] = a
    for t in range(len(running) - 2, -1, -1):
        n = running[t + 1]
        at = starts[:n] + t
        b = (e[at + 1] * beta[at + 1]) @ m.T
        beta[at] = b / b.sum(axis=1, keepdims=True)
    return alpha, beta, e, m


def forward_backward(emission: np.ndarray, transition: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Marginals of every position."""
    alpha, beta, _, _ = chains(emission, transition, lengths)
    both = alpha * beta
    return both / both.sum(axis=1, keepdims=True) if len(both) else both


def expectations(emission: np.ndarray, transition: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of every position and the expected number of transitions between each two labels."""
    alpha, beta, e, m = chains(emission, transition, lengths)
    inner = np.ones(len(emission), dtype=bool)
    inner[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    after = np.flatnonzero(inner)
    joint = alpha[after - 1][:, :, None] * m[None] * (e[after] * beta[after])[:, None, :]
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    both = alpha * beta
    return both / both.sum(axis=1, keepdims=True), joint.sum(axis=0)


@dataclass
class Field:
    """Languages, feature weights and transitions; ``known`` caches the emissions of words in a worker."""

    languages: list[str]
    weights: np.ndarray
    transition: np.ndarray
    known: dict[str, int] = field(default_factory=dict)
    emitted: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {"languages": self.languages, "weights": self.weights, "transition": self.transition, "known": {}, "emitted": None}

    def emissions(self, words: list[str]) -> np.ndarray:
        rows, buckets = features(words)
        return _summed(rows, self.weights[buckets].astype(np.float64), len(words))

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if self.emitted is None or len(self.known) + len(new) > CACHE:
            self.known, self.emitted, new = {}, np.empty((0, len(self.languages))), list(words)
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            self.known.update(zip(part, range(len(self.known), len(self.known) + len(part)), strict=True))
            self.emitted = np.concatenate((self.emitted, self.emissions(part)))

    def marginals(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of the words of all texts, one after the other, and the number of words of each."""
        self._learn(set().union(*texts))
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        find = self.known.__getitem__
        at = np.fromiter((find(w) for t in texts for w in t), dtype=np.int64, count=int(lengths.sum()))
        return forward_backward(self.emitted[at], self.transition, lengths), lengths


def fit(texts: Iterable[tuple[str, str]], rounds: int = 30, span: int = 64, l2: float = 1e-3, seed: int = 7) -> Field | None:
    """From (language, text); None if there is no word."""
    rng = np.random.default_rng(seed)
    spans: list[tuple[str, list[str]]] = []
    for language, text in sorted(texts):
        words, i = words_of(text), 0
        while i < len(words):
            n = int(rng.integers(4, 40))
            spans.append((language, words[i : i + n]))
            i += n
    if not spans:
        return None
    languages = sorted({s[0] for s in spans})
    number = {name: k for k, name in enumerate(languages)}
    order = rng.permutation(len(spans))
    words = [w for i in order for w in spans[i][1]]
    gold = np.array([number[spans[i][0]] for i in order for _ in spans[i][1]])
    lengths = np.array([min(span, len(words) - i) for i in range(0, len(words), span)])
    types: dict[str, int] = {}
    token = np.array([types.setdefault(w, len(types)) for w in words])
    rows, buckets = features(list(types))
    used, bucket = np.unique(buckets, return_inverse=True)
    k, one = len(languages), np.eye(len(languages))[gold]
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    inner = np.ones(len(words), dtype=bool)
    inner[first] = False
    after = np.flatnonzero(inner)
    seen = one[after - 1].T @ one[after]
    weights, transition = np.zeros((len(used), k)), np.zeros((k, k))
    speed, speed_t = np.full(weights.shape, 1e-8), np.full(transition.shape, 1e-8)
    for _ in range(rounds):
        emission = _summed(rows, weights[bucket], len(types))[token]
        p, expected = expectations(emission, transition, lengths)
        step = _summed(bucket, _summed(token, one - p, len(types))[rows], len(used)) / len(words) - l2 * weights / len(used)
        step_t = (seen - expected) / len(words) - l2 * transition
        speed, speed_t = 0.9 * speed + 0.1 * step**2, 0.9 * speed_t + 0.1 * step_t**2
        weights += 0.05 * step / np.sqrt(speed + 1e-12)
        transition += 0.05 * step_t / np.sqrt(speed_t + 1e-12)
    full = np.zeros((BUCKETS, k), dtype=np.float32)
    full[used] = weights
    return Field(languages, full, transition)


def _spans(text: str) -> F.Column:
    """A text of at most ``SAMPLE_CHARS`` characters, of a longer one so many from places all over it, without cut words."""
    size = SAMPLE_CHARS // SLICES
    first = lambda i: (i * (F.length(text) - size) / (SLICES - 1)).cast("int") + 1
    parts = F.transform(F.sequence(F.lit(0), F.lit(SLICES - 1)), lambda i: F.regexp_replace(F.substring(F.col(text), first(i), F.lit(size)), r"^\S*\s|\s\S*$", " "))
    return F.when(F.length(text) <= SAMPLE_CHARS, F.col(text)).otherwise(F.array_join(parts, " "))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Field | None:
    """Fit on ``sample`` texts of each language, those with the smallest hashes of the id."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0)).withColumn("text", _spans("text"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", F.xxhash64("text"))
    chosen = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample)
    return fit((r["lang"], r["text"]) for r in chosen.select("lang", "text").toLocalIterator())


def _grouped(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    first, total = 0, 0
    for i, t in enumerate(texts):
        if total > CHARS:
            yield first, i
            first, total = i, 0
        total += len(t or "")
    yield first, len(texts)


def text_languages(df: DataFrame, model: Field | None, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``."""
    if model is None:
        return df.withColumn("lang_pred", F.lit("und")).withColumn("score", F.lit(0.0))
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts, texts = [], list(batch)
            for i, j in _grouped(texts):
                p, lengths = shared.value.marginals([words_of(t) for t in texts[i:j]])
                sums = np.zeros((len(lengths), p.shape[1]))
                full = lengths > 0
                if full.any():
                    sums[full] = np.add.reduceat(p, (np.cumsum(lengths) - lengths)[full], axis=0)
                names = np.array(shared.value.languages, dtype=object)[sums.argmax(axis=1)]
                parts.append(pd.DataFrame({"lang": np.where(full, names, "und"), "score": np.minimum(sums.max(axis=1) / np.maximum(lengths, 1), 1.0)}))
            yield pd.concat(parts, ignore_index=True)

    found = df.withColumn("lang_pred", of_texts(F.col(text)))
    return found.withColumn("score", F.col("lang_pred.score")).withColumn("lang_pred", F.col("lang_pred.lang"))


def word_languages(df: DataFrame, model: Field, text: str = "text", out: str = "words") -> DataFrame:
    """``df`` with the array ``out`` of (word, lang, score): the likeliest language of each word of the whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<struct<word: string, lang: string, score: double>>")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for t in batch:
                words = words_of(t)
                p, _ = shared.value.marginals([words])
                out.append([{"word": w, "lang": shared.value.languages[k], "score": float(s)} for w, k, s in zip(words, p.argmax(axis=1), p.max(axis=1), strict=True)])
            yield pd.Series(out, dtype=object)

    return df.withColumn(out, of_texts(F.col(text)))


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


@query("op7_language_crf")
def op7_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out()))
    return text_languages(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
