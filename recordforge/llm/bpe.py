"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Texts become arrays of code points, code points become classes, and a small automaton over the classes says where a piece
starts.  The automaton is not run character by character: every class is a function from states to states, functions compose
associatively, so blocks of characters are composed side by side in numpy, the block functions are scanned by doubling, and
a second sweep turns block starts into piece starts.  A separator class resets the automaton, so one scan covers many texts.
Look-ahead of the pattern (an apostrophe before s, re, ...; white space before white space or the end) is folded into the
classes beforehand.  Pieces are merged by rank through a bounded
cache; new short pieces are merged side by side, one merge of each in a numpy step, and long ones with a heap, so that a text
without spaces costs n log n.

``encode`` keeps the end offset (in bytes) of each token, ``decode`` checks the bytes of the ids against them.

Nulls: a null text has no tokens.  Rows are independent: repeated rows, any other columns and empty tables pass through;
columns named ``ids``, ``ends`` or ``decoded`` are replaced.  Nothing is truncated; memory is bounded by ``CHARS`` plus the longest text.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
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

from recordforge.llm.common import table
from recordforge.llm.registry import query

RANKS = "byte_bpe_50k.tiktoken"
#: Characters scanned at a time, texts kept whole.
CHARS = 1_000_000
BLOCK = 256
CACHE = 150_000
#: Pieces of up to so many bytes are merged side by side, longer ones one by one.
SIZES = (6, 9, 12, 16, 32)
SIDE = 4_000
NONE = np.int32(2**31 - 1)
SEPARATOR = "\udfff"  # a lone surrogate: no Spark string holds one

# Character classes.
LETTER, NUMBER, OTHER, SPACE, BLANK, LAST_BLANK, SHORT, LONG, BETWEEN = range(9)
# States: inside a run of letters, numbers, others or white space; after a space that joins what follows; one or two
# characters before the end of a contraction; between pieces.
IN_L, IN_N, IN_O, IN_W, JOINED, ONE_LEFT, TWO_LEFT, FREE = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and piece start by (class, state)."""
    step = np.zeros((9, 8), dtype=np.uint8)
    start = np.zeros((9, 8), dtype=bool)
    for state in range(8):
        for kind, run in ((LETTER, IN_L), (NUMBER, IN_N), (OTHER, IN_O), (SHORT, ONE_LEFT), (LONG, TWO_LEFT)):
            goes_on = state == JOINED or state == (IN_O if kind in (SHORT, LONG) else run)
            start[kind, state] = not goes_on
            step[kind, state] = (IN_O if kind in (SHORT, LONG) else run) if goes_on else run
        start[SPACE, state], step[SPACE, state] = True, JOINED
        start[LAST_BLANK, state], step[LAST_BLANK, state] = True, FREE
        start[BLANK, state], step[BLANK, state] = state != IN_W, IN_W
        start[BETWEEN, state], step[BETWEEN, state] = True, FREE
    start[LETTER, ONE_LEFT], step[LETTER, ONE_LEFT] = False, FREE
    start[LETTER, TWO_LEFT], step[LETTER, TWO_LEFT] = False, ONE_LEFT
    return step.ravel(), start.ravel()


def _fourfold(step: np.ndarray) -> np.ndarray:
    """Functions of four classes in a row, composed: index ((c1 * 9 + c2) * 9 + c3) * 9 + c4, then the state."""
    one = step.reshape(9, 8)
    many = one
    for _ in range(3):
        many = one[:, many].transpose(1, 0, 2).reshape(-1, 8)
    return np.ascontiguousarray(many).ravel()


STEP, START = _automaton()
STEP4 = _fourfold(STEP)
# The white space of the pattern: the Unicode property (fixed values).
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    for code in range(0x110000):
        category = unicodedata.category(chr(code))[0]
        if category in "LN":
            kinds[code] = LETTER if category == "L" else NUMBER
    kinds[WHITE_SPACE] = BLANK
    kinds[ord(SEPARATOR)] = BETWEEN
    return kinds


def _classes(codes: np.ndarray) -> np.ndarray:
    """Class of each code point, with the look-ahead of the pattern folded in."""
    kinds = _kinds()[codes]
    after = np.append(codes[1:], ord(SEPARATOR))
    blank = kinds == BLANK
    ends = blank & ~(np.append(blank[1:], False) | (np.append(kinds[1:], BETWEEN) == BETWEEN))
    kinds[ends] = np.where(codes[ends] == 0x20, SPACE, LAST_BLANK)
    marks = np.flatnonzero(codes == ord("'"))
    if len(marks):
        one = after[marks]
        two = np.append(codes[2:], [ord(SEPARATOR)] * 2)[marks] if len(codes) > 1 else np.full(len(marks), ord(SEPARATOR))
        is_ = lambda a, b: (one == ord(a)) & (two == ord(b))
        kinds[marks[np.isin(one, [ord(x) for x in "stmd"])]] = SHORT
        kinds[marks[is_("r", "e") | is_("v", "e") | is_("l", "l")]] = LONG
    return kinds


def piece_starts(codes: np.ndarray) -> np.ndarray:
    """Positions where a piece starts, and those of separators."""
    n = len(codes)
    blocks = -(-n // BLOCK)
    kinds = np.full(blocks * BLOCK, BETWEEN, dtype=np.uint8)
    kinds[:n] = _classes(codes)
    columns = np.ascontiguousarray(kinds.reshape(blocks, BLOCK).T)
    # Compose the functions of each block, four characters at a time.
    function = np.repeat(np.arange(8, dtype=np.uint8)[:, None], blocks, axis=1)
    for four in columns.reshape(-1, 4, blocks).astype(np.intp):
        index = ((four[0] * 9 + four[1]) * 9 + four[2]) * 9 + four[3]
        function = STEP4[index * 8 + function]
    columns *= np.uint8(8)
    # Scan the blocks by doubling: afterwards function[:, i] is that of blocks 0 to i.
    reach = 1
    while reach < blocks:
        function[:, reach:] = np.take_along_axis(function[:, reach:], function[:, :-reach], axis=0)
        reach *= 2
    state = np.concatenate(([FREE], function[FREE, :-1])).astype(np.uint8)
    starts = np.empty((BLOCK, blocks), dtype=bool)
    for k, row in enumerate(columns):
        at = row + state
        starts[k] = START[at]
        state = STEP[at]
    return np.flatnonzero(starts.T.ravel()[:n])


class Coder:
    """Ranks, their inverse and the cache of one rank file."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.lengths = np.zeros(max(self.tokens) + 1, dtype=np.int64)
        for rank, token in self.tokens.items():
            self.lengths[rank] = len(token)
        self.cache: dict[str, tuple[int, ...]] = {}
        self.octets = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of the pairs of tokens that merge, and the ranks they merge to."""
        keys, ranks = array("q"), array("i")
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left << 20 | right)
                    ranks.append(rank)
        order = np.argsort(np.array(keys))
        return np.array(keys)[order], np.array(ranks)[order]

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 20 | right
        known, ranks = self.pairs
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, ranks[at], NONE)

    def merge_all(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """``merge`` of many short pieces side by side: one merge of each piece in a step."""
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths.max()) + 1
        octets = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(len(pieces), width)
        ids = self.octets[octets]
        column = np.arange(width)
        ranks = np.full(ids.shape, NONE, dtype=np.int32)
        ranks[:, :-1] = self._pair_ranks(ids[:, :-1], ids[:, 1:])
        ranks[column[None, :] >= lengths[:, None] - 1] = NONE
        out_ids, live = ids.copy(), np.arange(len(pieces))
        while len(live):
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(live)), at]
            over = least == NONE
            if over.any():
                out_ids[live[over]] = ids[over]
                live, ids, ranks, at, least = live[~over], ids[~over], ranks[~over], at[~over], least[~over]
            if not len(live):
                break
            row = np.arange(len(live))
            later = column[None, :-1] > at[:, None]
            ids[:, :-1] = np.where(later, ids[:, 1:], ids[:, :-1])
            ranks[:, :-1] = np.where(later, ranks[:, 1:], ranks[:, :-1])
            lengths[live] -= 1
            ids[row, at] = least
            ranks[row, at] = np.where(at < lengths[live] - 1, self._pair_ranks(least, ids[row, np.minimum(at + 1, width - 1)]), NONE)
            inner = np.flatnonzero(at > 0)
            ranks[inner, at[inner] - 1] = self._pair_ranks(ids[inner, at[inner] - 1], least[inner])
        return [tuple(r[:n]) for r, n in zip(out_ids.tolist(), lengths.tolist(), strict=True)]

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece: merge the adjacent pair of lowest rank, the leftmost of equals, until none has a rank."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        if len(piece) > 64:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        order = [ranks.get(a + b, 1 << 30) for a, b in zip(parts, parts[1:], strict=False)]
        while order and (least := min(order)) < 1 << 30:
            i = order.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del order[i]
            if i:
                order[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 30)
            if i < len(order):
                order[i] = ranks.get(parts[i] + parts[i + 1], 1 << 30)
        return tuple(ranks[p] for p in parts)

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        ranks, n = self.ranks, len(piece)
        ends = list(range(1, n + 1))  # by start: end of the part, 0 once merged away
        before = list(range(-1, n - 1))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, end = heapq.heappop(heap)
            middle = ends[i]
            if not middle or middle >= end or ends[middle] != end:
                continue
            ends[i], ends[middle] = end, 0
            if end < n:
                before[end] = i
                if (new := ranks.get(piece[i : ends[end]])) is not None:
                    heapq.heappush(heap, (new, i, ends[end]))
            if (left := before[i]) >= 0 and (new := ranks.get(piece[left:end])) is not None:
                heapq.heappush(heap, (new, left, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : ends[i]]])
            i = ends[i]
        return tuple(out)

    def _learn(self, pieces: set[str]) -> list[str]:
        """Put the ids of all ``pieces`` into the cache; if it is full, of these alone.  The long new ones are returned."""
        new = [p for p in pieces if p not in self.cache]
        if len(self.cache) + len(new) > CACHE:
            self.cache = {}
            new = list(pieces)
        coded = sorted((p.encode("utf-8") for p in new), key=len)
        for size in SIZES:
            group = [p for p in coded if len(p) <= size]
            coded = coded[len(group) :]
            for i in range(0, len(group), SIDE):
                part = group[i : i + SIDE]
                self.cache.update(zip((p.decode("utf-8") for p in part), self.merge_all(part), strict=True))
        self.cache.update((p.decode("utf-8"), self.merge(p)) for p in coded)
        return [p.decode("utf-8") for p in coded]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        joined = SEPARATOR.join(texts) + SEPARATOR
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        starts = piece_starts(codes)
        cuts = starts.tolist()
        pieces = [joined[i:j] for i, j in zip(cuts, [*cuts[1:], len(joined)], strict=True)]
        long = self._learn(set(pieces) - {SEPARATOR})
        find, first, out = self.cache.__getitem__, 0, []
        for last in np.flatnonzero(codes[starts] == ord(SEPARATOR)).tolist():
            out.append(list(chain.from_iterable(map(find, pieces[first:last]))))
            first = last + 1
        for piece in long:
            del self.cache[piece]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


def _grouped(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` in total, a larger row alone."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if i > first and total + size > most:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int64))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *rows]).astype(np.int32)))


def _encode(batches: Iterable[pa.RecordBatch], at: int, keep: list[int], path: str) -> Iterator[pa.RecordBatch]:
    codes = coder(path)
    for batch in batches:
        for i, j in _grouped(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist(), CHARS):
            part = batch.slice(i, j - i)
            ids = [np.array(x, dtype=np.int32) for x in codes.encode([t or "" for t in part.column(at).to_pylist()])]
            columns = [*(part.column(k) for k in keep), _lists(ids), _lists([np.cumsum(codes.lengths[x]) for x in ids])]
            yield pa.RecordBatch.from_arrays(columns, names=[*(batch.schema.names[k] for k in keep), "ids", "ends"])


def encode(df: DataFrame, path: str, text: str = "text", drop_text: bool = False) -> DataFrame:
    """``df`` with ``ids`` array<int> and ``ends`` array<int>: of each token the byte offset where it ends."""
    df = df.select(*(c for c in df.columns if c.lower() not in ("ids", "ends")))
    keep = [i for i, c in enumerate(df.columns) if not (drop_text and c == text)]
    fields = [df.schema.fields[i] for i in keep]
    schema = T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("ends", T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(partial(_encode, at=df.columns.index(text), keep=keep, path=path), schema)


def _decode(batches: Iterable[pa.RecordBatch], at: tuple[int, int], path: str) -> Iterator[pa.RecordBatch]:
    codes = coder(path)
    for batch in batches:
        ids = batch.column(at[0])
        for i, j in _grouped(np.diff(ids.offsets.to_numpy()).tolist(), CHARS // 2):
            part = batch.slice(i, j - i)
            texts = []
            for row, ends in zip(part.column(at[0]), part.column(at[1]), strict=True):
                row, ends = (np.asarray(x.values if x.is_valid else [], dtype=np.int64) for x in (row, ends))
                if not np.array_equal(np.cumsum(codes.lengths[row]), ends):
                    raise ValueError("token ids and offsets disagree")
                texts.append(codes.decode(row.tolist()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "decoded"])


def decode(df: DataFrame, path: str) -> DataFrame:
    """``df`` with the bytes of its ``ids`` as ``decoded``; an error if they do not end where ``ends`` says."""
    df = df.select(*(c for c in df.columns if c.lower() != "decoded"))
    schema = T.StructType([*df.schema.fields, T.StructField("decoded", T.BinaryType())])
    return df.mapInArrow(partial(_decode, at=(df.columns.index("ids"), df.columns.index("ends")), path=path), schema)


def both_ways(df: DataFrame, path: str, text: str = "text", drop_text: bool = False) -> DataFrame:
    """``decode`` of ``encode``, in one Python worker."""
    df = df.select(*(c for c in df.columns if c.lower() not in ("ids", "ends", "decoded")))
    keep = [i for i, c in enumerate(df.columns) if not (drop_text and c == text)]
    source, at = df.columns.index(text), (len(keep), len(keep) + 1)
    numbers = T.ArrayType(T.IntegerType())
    new = [T.StructField("ids", numbers), T.StructField("ends", numbers), T.StructField("decoded", T.BinaryType())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decode(_encode(batches, source, keep, path), at, path)

    return df.mapInArrow(run, T.StructType([*(df.schema.fields[i] for i in keep), *new]))


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document."""
    path = path or public_tokenizers.path(RANKS)
    return both_ways(table(spark, sf_dir, "documents").select("doc_id", "text"), path, drop_text=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
