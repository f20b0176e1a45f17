"""SentencePiece encoding and decoding that keep the source span of every piece.

A model file holds pieces with scores, and a compiled character map: a double-array trie over source bytes whose leaves point at
replacements.  Normalisation takes at each place the longest source that the map knows, writes its replacement (or the
character itself), and records for every normalised character the byte of the source text it comes from; white space is
collapsed, marked and prefixed as the model says.  Merging joins the adjacent pair whose piece has the highest score, the leftmost
of equals; characters without a piece become byte pieces.  The lengths of the pieces in normalised characters, summed up,
index the recorded alignment: that gives each piece its (begin, end) in bytes of the original text.  As in the library, the last byte
piece of a character carries its span, the ones before it an empty one.

No piece of such models continues after a word with a mark of white space, so texts are cut before these marks.  Each word is merged
once while it stays in a bounded cache; new short words are merged side by side, one merge of each in a numpy step, long ones with
a heap in n log n.  If a model does have pieces across such a cut, its texts are merged whole.

Nulls: a null text has no pieces.  Rows are independent: repeated rows, further columns and empty tables pass through;
columns named ``ids``, ``begins``, ``ends`` or ``decoded`` are replaced.  Nothing is truncated; a task holds one Arrow batch and the
pieces of one slice of it.
"""

from __future__ import annotations

import heapq
import struct
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache, partial
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordforge.llm.bpe import _grouped
from recordforge.llm.common import table
from recordforge.llm.registry import query

MODEL = "piece_bpe_32k.model"
#: Bytes of text encoded at a time, texts kept whole.
SLICE = 3_000_000
#: Words kept in each of the two generations of the cache.
CACHE = 300_000
#: Words of up to so many characters are merged side by side, longer ones one by one and not kept.
SIZES = (6, 9, 12, 16, 32)
SIDE = 4_000
NONE = np.int32(2**31 - 1)
#: Ids are kept packed: a tuple of numbers takes four times the memory.
ID = np.dtype("<i4")
MARK = "▁"
REPLACEMENT = "�"
# Kinds of pieces and of models in the file format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
BPE = 2


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a serialised protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            octet = data[at]
            at += 1
            value |= (octet & 0x7F) << shift
            shift += 7
            if octet < 0x80:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + size]
            at += size


class CharacterMap:
    """Longest-prefix replacement by the compiled character map of a model."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist() if size else []
        self.targets = blob[4 + size :]

    @staticmethod
    def _children(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest known source at ``at`` and its replacement; length 0 if there is none."""
        units, length, target = self.units, 0, 0
        if not units:
            return 0, b""
        node = self._children(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._children(unit)
            if unit >> 8 & 1:
                length, target = i + 1 - at, units[node] & 0x7FFFFFFF
        return length, self.targets[target : self.targets.index(b"\0", target)] if length else b""


def _octets(codes: np.ndarray) -> np.ndarray:
    return 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)


class Normaliser:
    """Normalised text with the source byte of each of its characters."""

    def __init__(self, blob: bytes = b"", prefix: bool = True, collapse: bool = True, mark: bool = True):
        self.map, self.prefix, self.collapse = CharacterMap(blob), prefix, collapse
        self.space = MARK if mark else " "

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text, and for each of its characters and for its end the byte of ``text`` where its source starts."""
        if not text:
            return "", np.zeros(1, dtype=np.int64)
        if self.map.units or self.collapse:
            return self._by_rules(text.encode("utf-8"))
        # Without rules every character stands for itself.
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum(_octets(codes))
        origin = np.concatenate(([0, 0] if self.prefix else [0], ends))
        return (self.space if self.prefix else "") + text.replace(" ", self.space), origin

    def _next(self, data: bytes, at: int) -> tuple[int, str]:
        """Size of the source at ``at`` and what stands for it: a replacement, or the character itself."""
        size, target = self.map.longest(data, at)
        if not size:
            size = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
            target = data[at : at + size]
        return size, target.decode("utf-8")

    def _by_rules(self, data: bytes) -> tuple[str, np.ndarray]:
        at = 0
        while self.collapse and at < len(data):
            size, new = self._next(data, at)
            if new != " ":
                break
            at += size
        if at == len(data):
            return "", np.zeros(1, dtype=np.int64)
        # The mark before a text stands where its first part that is not a space starts.
        parts, origin = ([" "], [at]) if self.prefix else ([], [])
        blank = self.collapse
        while at < len(data):
            size, new = self._next(data, at)
            if blank:
                new = new.lstrip(" ")
            if new:
                parts.append(new)
                origin += [at] * len(new)
                blank = self.collapse and new[-1] == " "
            at += size
        normal, end = "".join(parts).replace(" ", self.space), len(data)
        if self.collapse and normal != (kept := normal.rstrip(self.space)):
            end = origin[len(kept)]
            normal = kept
            del origin[len(kept) :]
        return normal, np.array([*origin, end], dtype=np.int64)


class Pieces:
    """Vocabulary, normaliser and cache of one model file."""

    def __init__(self, data: bytes):
        pieces: list[tuple[str, float, int]] = []
        spec: dict[int, int | bytes] = {}
        trainer: dict[int, int | bytes] = {}
        for field, value in message(data):
            if field == 1:
                row = dict(message(value))
                pieces.append((row.get(1, b"").decode("utf-8"), struct.unpack("<f", row.get(2, bytes(4)))[0], row.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(message(value))
            elif field == 3:
                spec = dict(message(value))
            elif field == 5 and dict(message(value)).get(2):
                raise ValueError("models with a denormaliser are not supported")
        kinds = np.array([kind for _, _, kind in pieces])
        if trainer.get(3) != BPE or not (kinds == BYTE).sum() == 256 or np.isin(kinds, (USER_DEFINED, UNUSED)).any() or trainer.get(24):
            raise ValueError("only BPE models with byte pieces and without user-defined, unused or suffix-marked ones are supported")
        self.prefix, self.collapse = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        self.normalise = Normaliser(spec.get(2, b""), self.prefix, self.collapse, bool(spec.get(5, 1)))
        self.ids = {piece: i for i, (piece, _, kind) in enumerate(pieces) if kind == NORMAL}
        # Merges of higher scores come first.
        self.order = {piece: -score for piece, score, kind in pieces if kind == NORMAL}
        self.bytes = {int(piece[3:5], 16): i for i, (piece, _, kind) in enumerate(pieces) if kind == BYTE}
        self.controls = {i for i, kind in enumerate(kinds) if kind == CONTROL}
        self.octet = np.full(len(pieces), -1, dtype=np.int16)
        for octet, i in self.bytes.items():
            self.octet[i] = octet
        self.chars = np.array([len(piece) if kind == NORMAL else 0 for piece, _, kind in pieces], dtype=np.int64)
        unknown = trainer.get(44, " ⁇ ".encode())
        self.out = [
            b"" if kind == CONTROL else unknown if kind == UNKNOWN else bytes([self.octet[i]]) if kind == BYTE else piece.replace(MARK, " ").encode("utf-8")
            for i, (piece, _, kind) in enumerate(pieces)
        ]
        crossing = any(MARK in piece.lstrip(MARK) for piece in self.ids)
        self.cuts = not crossing
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _coded(self, parts: Iterable[str]) -> tuple[int, ...]:
        ids, octets = self.ids, self.bytes
        out: list[int] = []
        for part in parts:
            if (i := ids.get(part)) is not None:
                out.append(i)
            else:
                out += [octets[b] for b in part.encode("utf-8")]
        return tuple(out)

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of the pairs of symbols that merge, with the order of the merges (equal scores: equal) and the pieces made."""
        symbol = lambda part: self.ids.get(part, len(self.out) + ord(part) if len(part) == 1 else None)
        place = {score: k for k, score in enumerate(sorted(set(self.order.values())))}
        rows = array("q")
        for piece, made in self.ids.items():
            for i in range(1, len(piece)):
                left, right = symbol(piece[:i]), symbol(piece[i:])
                if left is not None and right is not None:
                    rows.extend((left << 21 | right, place[self.order[piece]], made))
        table = np.array(rows, dtype=np.int64).reshape(-1, 3)
        table = table[np.argsort(table[:, 0])]
        return table[:, 0].copy(), table[:, 1].astype(np.int32), table[:, 2].astype(np.int32)

    @cached_property
    def symbols(self) -> np.ndarray:
        """Symbol of each code point: its piece, or a number past all pieces."""
        symbols = np.arange(0x110000, dtype=np.int32) + len(self.out)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                symbols[ord(piece)] = i
        return symbols

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of symbols the order of their merge, ``NONE`` without one, and their place in ``pairs``."""
        keys = left.astype(np.int64) << 21 | right
        known, order, _ = self.pairs
        at = np.searchsorted(known, keys)
        at[at == len(known)] = 0
        return np.where(known[at] == keys, order[at], NONE), at

    def merge_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words, one after the other, and how many each has: join the adjacent pair whose piece scores highest, the
        leftmost of equals, until none is a piece.  One merge of each word in a step; symbols joined to the one before are
        unlinked, not moved.
        """
        lengths = np.array([len(w) for w in words])
        width = int(lengths.max()) + 1
        codes = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), dtype=np.uint32)
        symbols = self.symbols[codes]
        inside = (np.arange(width)[None, :] < lengths[:, None]).ravel()
        after = np.arange(1, len(symbols) + 1)
        before = np.arange(-1, len(symbols) - 1)
        pair = inside[:-1] & inside[1:]
        order = np.full(len(symbols), NONE, dtype=np.int32)
        some = np.flatnonzero(pair)
        order[some] = self._lookup(symbols[some], symbols[some + 1])[0]
        table, live, made = order.reshape(-1, width), np.arange(len(words)), self.pairs[2]
        while len(live):
            rows = table if len(live) == len(table) else table[live]
            column = rows.argmin(axis=1)
            going = rows[np.arange(len(live)), column] != NONE
            live = live[going]
            at = live * width + column[going]
            gone = after[at]
            symbols[at] = made[self._lookup(symbols[at], symbols[gone])[1]]
            inside[gone], order[gone] = False, NONE
            following = after[gone]
            after[at] = following
            # The place after a word is unlinked too, as the padding of the word; it has no symbol.
            has = inside[np.minimum(following, len(inside) - 1)] & (following < (live + 1) * width)
            before[following[has]] = at[has]
            order[at] = NONE
            order[at[has]] = self._lookup(symbols[at[has]], symbols[following[has]])[0]
            left = before[at]
            has = left >= live * width
            order[left[has]] = self._lookup(symbols[left[has]], symbols[at[has]])[0]
        return symbols[inside], inside.reshape(-1, width).sum(axis=1)

    def _coded_all(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words, packed; symbols without a piece become bytes."""
        symbols, sizes = self.merge_all(words)
        vocabulary, packed, at = len(self.out), symbols.astype(ID).tobytes(), 0
        strange = np.add.reduceat(symbols >= vocabulary, np.cumsum(sizes) - sizes).tolist()
        for size, odd in zip((sizes * ID.itemsize).tolist(), strange, strict=True):
            ids = packed[at : at + size]
            at += size
            if odd:
                each = np.frombuffer(ids, dtype=ID).tolist()
                ids = _packed(chain.from_iterable((i,) if i < vocabulary else map(self.bytes.__getitem__, chr(i - vocabulary).encode("utf-8")) for i in each))
            yield ids

    def merge(self, word: str) -> tuple[int, ...]:
        """Ids of one word of any length, by a heap of the merges."""
        order, n = self.order, len(word)
        ends = list(range(1, n + 1))  # by start: end of the part, 0 once joined to the one before
        before = list(range(-1, n - 1))
        heap = [(score, i, i + 2) for i in range(n - 1) if (score := order.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = ends[i]
            if not middle or middle >= end or ends[middle] != end:
                continue
            ends[i], ends[middle] = end, 0
            if end < n:
                before[end] = i
                if (score := order.get(word[i : ends[end]])) is not None:
                    heapq.heappush(heap, (score, i, ends[end]))
            if (left := before[i]) >= 0 and (score := order.get(word[left:end])) is not None:
                heapq.heappush(heap, (score, left, end))
        parts, i = [], 0
        while i < n:
            parts.append(word[i : ends[i]])
            i = ends[i]
        return self._coded(parts)

    def _learn(self, words: list[str]) -> list[bytes]:
        """Packed ids of ``words``, all different, through the cache."""
        if len(self.young) > CACHE:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        unknown = [w for w in words if w not in young]
        young.update((w, old[w]) for w in unknown if w in old)
        new = sorted((w for w in unknown if w not in young), key=len)
        for size in SIZES:
            group = [w for w in new if len(w) <= size]
            new = new[len(group) :]
            for i in range(0, len(group), SIDE):
                part = group[i : i + SIDE]
                young.update(zip(part, self._coded_all(part), strict=True))
        young.update((w, _packed(self.merge(w))) for w in new)
        ids = list(map(young.__getitem__, words))
        for word in new:
            del young[word]
        return ids

    def _words(self, normal: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """The words of normalised texts, and how many each has."""
        data = b"".join(normal)
        octets = np.frombuffer(data, dtype=np.uint8)
        ends = np.cumsum([len(n) for n in normal], dtype=np.int64)
        start = np.zeros(len(octets) + 1, dtype=bool)
        if self.cuts and len(octets) >= 3:
            mark = np.zeros(len(octets) + 3, dtype=bool)
            np.logical_and.reduce([octets[k : len(octets) - 2 + k] == b for k, b in enumerate(MARK.encode("utf-8"))], out=mark[3:-2])
            start[:-1] = mark[3:] & ~mark[:-3]
        start[ends] = True
        start[0] = True
        offsets = np.flatnonzero(start)
        if not len(octets):
            offsets = np.zeros(1, dtype=np.int64)
        words = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
        return words, np.diff(np.searchsorted(offsets, ends), prepend=0)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces of texts, one text after the other, of each piece the first byte of its source and the byte after the
        last, and how many pieces each text has."""
        normal, origins = zip(*map(self.normalise, texts), strict=True) if texts else ((), ())
        words, counts = self._words([n.encode("utf-8") for n in normal])
        coded = words.dictionary_encode()
        place = coded.indices.to_numpy(zero_copy_only=False)
        known = self._learn(coded.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(known), dtype=ID)
        sizes = np.array(list(map(len, known)), dtype=np.int64) // ID.itemsize
        each = sizes[place]
        first = (np.cumsum(sizes) - sizes)[place]
        ids = flat[np.repeat(first - (np.cumsum(each) - each), each) + np.arange(each.sum())]
        words_end = np.concatenate(([0], np.cumsum(counts)))
        sizes = np.diff(np.concatenate(([0], np.cumsum(each)))[words_end])
        octets, lengths = self.octet[ids], self.chars[ids]
        # The last byte of a character is one that no continuation byte follows; it stands for the whole character.
        following = np.append(octets[1:], np.int16(-1))[: len(ids)]
        lengths[(octets >= 0) & ((following < 0) | ((following & 0xC0) != 0x80))] = 1
        # Each text's alignment has one place more than characters.
        ends = np.cumsum(lengths) + np.repeat(np.arange(len(texts)), sizes)
        origin = np.concatenate([np.zeros(0, dtype=np.int64), *origins])
        return ids, origin[ends - lengths], origin[ends], sizes

    def decode(self, ids: list[int]) -> str:
        """Text of ids; a byte that is no part of a character counts as a replacement character."""
        parts = list(map(self.out.__getitem__, ids))
        if self.prefix or self.collapse:
            # The white space before the text goes: one mark, or all of it where the model collapses white space.
            for k, i in enumerate(ids):
                if i in self.controls:
                    continue
                if not self.chars[i] or not parts[k].startswith(b" "):
                    break
                parts[k] = parts[k][1:]
                if parts[k] or not self.collapse:
                    break
        whole = b"".join(parts)
        try:
            return whole.decode("utf-8")
        except UnicodeDecodeError:
            return _lenient(whole)


def _packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, dtype=ID).tobytes()


def _lenient(data: bytes) -> str:
    """Text of bytes, with one replacement character for each byte that starts no character."""
    parts, at = [], 0
    while at < len(data):
        size = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
        try:
            parts.append(data[at : at + size].decode("utf-8"))
            at += size
        except UnicodeDecodeError:
            parts.append(REPLACEMENT)
            at += 1
    return "".join(parts)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    with open(path, "rb") as file:
        return Pieces(file.read())


def _encode(batches: Iterable[pa.RecordBatch], at: int, keep: list[int], path: str) -> Iterator[pa.RecordBatch]:
    model = pieces(path)
    for batch in batches:
        for i, j in _grouped(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist(), SLICE):
            part = batch.slice(i, j - i)
            *arrays, sizes = model.encode([t or "" for t in part.column(at).to_pylist()])
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            columns = [*(part.column(k) for k in keep), *(pa.ListArray.from_arrays(offsets, pa.array(a.astype(np.int32))) for a in arrays)]
            yield pa.RecordBatch.from_arrays(columns, names=[*(batch.schema.names[k] for k in keep), "ids", "begins", "ends"])


NEW = ("ids", "begins", "ends")


def _coded_schema(df: DataFrame, keep: list[int]) -> list[T.StructField]:
    return [*(df.schema.fields[i] for i in keep), *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in NEW)]


def encode(df: DataFrame, path: str, text: str = "text", drop_text: bool = False) -> DataFrame:
    """``df`` with ``ids``, ``begins`` and ``ends``, array<int>: of each piece its id and its span in bytes of the text."""
    df = df.select(*(c for c in df.columns if c.lower() not in NEW))
    keep = [i for i, c in enumerate(df.columns) if not (drop_text and c == text)]
    return df.mapInArrow(partial(_encode, at=df.columns.index(text), keep=keep, path=path), T.StructType(_coded_schema(df, keep)))


def _decode(batches: Iterable[pa.RecordBatch], at: int, path: str) -> Iterator[pa.RecordBatch]:
    model = pieces(path)
    for batch in batches:
        ids = batch.column(at)
        for i, j in _grouped(np.diff(ids.offsets.to_numpy()).tolist(), SLICE // 2):
            part = batch.slice(i, j - i)
            texts = [model.decode(row or []) for row in part.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])


def decode(df: DataFrame, path: str) -> DataFrame:
    """``df`` with the text of its ``ids`` as ``decoded``."""
    df = df.select(*(c for c in df.columns if c.lower() != "decoded"))
    schema = T.StructType([*df.schema.fields, T.StructField("decoded", T.StringType())])
    return df.mapInArrow(partial(_decode, at=df.columns.index("ids"), path=path), schema)


def both_ways(df: DataFrame, path: str, text: str = "text", drop_text: bool = False) -> DataFrame:
    """``decode`` of ``encode``, in one Python worker."""
    df = df.select(*(c for c in df.columns if c.lower() not in (*NEW, "decoded")))
    keep = [i for i, c in enumerate(df.columns) if not (drop_text and c == text)]
    source, ids = df.columns.index(text), len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decode(_encode(batches, source, keep, path), ids, path)

    return df.mapInArrow(run, T.StructType([*_coded_schema(df, keep), T.StructField("decoded", T.StringType())]))


@query("op13_sentencepiece")
def op13_sentencepiece(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Piece count and digests of ids and decoded text of every document."""
    path = path or public_tokenizers.path(MODEL)
    return both_ways(table(spark, sf_dir, "documents").select("doc_id", "text"), path, drop_text=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
