"""Repair of conversation structure by a generalised LR parser.

A repaired conversation has the role initials ``(s?(ua)+)?``; as a grammar (``H`` may be empty)::

    C = [ P ]      P = H u a | P u a      H = [ s ]

The parser keeps a graph-structured stack: nodes (LR state, node below) are shared, so all readings that agree on a stack are one
node.  Each row offers every stack top the actions keep (shift of its initial), rerole (shift of another terminal) and delete;
before a row and at the end, terminals may be inserted; reductions cost nothing.  Equal stack tops are merged by minimum (cost,
audit), audit being the initials of the edits so far.  The grammar's stacks are bounded, so a frontier has a handful of tops however
long the conversation is, and what a symbol does to a frontier of given relative costs is computed once.

Audits are compared without being read: two that hold the same number of rows and differ before their last inserts differ at
a place that both have, so an order among the tops of a frontier and the few edits since then decide.

Faults of a row, the first that applies: ``blank`` (nothing but white space; must be deleted), ``duplicate`` (role and text seen
earlier in its conversation; must be deleted), ``truncated`` (the last character that is no white space is not one of ``.!?``;
costs more unless deleted).

Layout: rows are partitioned by conversation, numbered among equal rows, sorted by turn and streamed; a task holds the tops of one
conversation with their audits, and running digests instead of texts.

Nulls: null roles and texts are one space.  Null turns come first and don't count for gaps.  Rows with a null conv_id form one
conversation.  Rows of equal turn are ordered by role and text; repeated rows are duplicates.  A row with an empty role, or with an
initial that the grammar doesn't have, can't be kept as it is.  An empty table gives no conversation.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordforge.llm.common import table
from recordforge.llm.registry import query

GRAMMAR = (("C", ""), ("C", "P"), ("H", ""), ("H", "s"), ("P", "Hua"), ("P", "Pua"))
START = "C"
#: Terminals that rerole and insert may give, with their roles.
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
WHITE = " \t\n\x0b\x0c\r"
FINE, BLANK, DUPLICATE, CUT = "", "blank", "duplicate", "truncated"
GOES_ON = {"su", "ua", "au"}
#: Initials of an audit kept in one string.
CHUNK = 2_000

Item = tuple[int, int]


class Tables:
    """LR(0) automaton of a grammar: shifts and gotos by (state, symbol), and the productions a state can reduce."""

    def __init__(self, grammar: tuple[tuple[str, str], ...] = GRAMMAR, start: str = START):
        self.grammar = grammar
        self.accept = -1
        states: list[frozenset[Item]] = [self._closure({(k, 0) for k, (head, _) in enumerate(grammar) if head == start})]
        self.goto: dict[tuple[int, str], int] = {}
        for state in states:
            number = states.index(state)
            for symbol in sorted({grammar[k][1][dot] for k, dot in state if dot < len(grammar[k][1])}):
                after = self._closure({(k, dot + 1) for k, dot in state if grammar[k][1][dot : dot + 1] == symbol})
                if after not in states:
                    states.append(after)
                self.goto[number, symbol] = states.index(after)
        # The state after a whole sentence holds no item.
        self.goto[0, start] = self.accept
        self.reduce = {n: [grammar[k] for k, dot in sorted(state) if dot == len(grammar[k][1])] for n, state in enumerate(states)}
        self.reduce[self.accept] = []

    def _closure(self, items: set[Item]) -> frozenset[Item]:
        found, todo = set(items), list(items)
        while todo:
            k, dot = todo.pop()
            wanted = self.grammar[k][1][dot : dot + 1]
            for new in {(n, 0) for n, (head, _) in enumerate(self.grammar) if head == wanted} - found:
                found.add(new)
                todo.append(new)
        return frozenset(found)


class Node:
    """A stack: its top state on a stack below, shared by all readings that have it."""

    def __init__(self, state: int, below: Node | None, number: int):
        self.state, self.below, self.number = state, below, number
        self.above: dict[int, Node] = {}


#: (top, relative cost, rank of the audit) of each top of a frontier.
Frontier = tuple[tuple[Node, int, int], ...]
#: Where the reading of a top comes from: (index in the frontier before, terminals inserted before the row, edit, new role or None).
Move = tuple[int, str, str, str | None]


class Parser:
    """Frontiers of the graph-structured stack and the edits that lead from one to the next."""

    def __init__(self) -> None:
        self.tables = Tables()
        self.count = 0
        heads = {head for head, _ in GRAMMAR}
        self.terminals = {symbol for _, body in GRAMMAR for symbol in body} - heads
        self.root = self._node(0, None)
        self.first: Frontier = ((self.root, 0, 0),)
        self.advance = lru_cache(maxsize=50_000)(self._advance)
        self.finish = lru_cache(maxsize=50_000)(self._finish)

    def _node(self, state: int, below: Node | None) -> Node:
        if below is not None and state in below.above:
            return below.above[state]
        node = Node(state, below, self.count)
        self.count += 1
        if below is not None:
            below.above[state] = node
        return node

    def _shift(self, top: Node, symbol: str) -> Node | None:
        state = self.tables.goto.get((top.state, symbol))
        return None if state is None else self._node(state, top)

    def _reductions(self, top: Node) -> Iterator[Node]:
        for head, body in self.tables.reduce[top.state]:
            base = top
            for _ in body:
                base = base.below
            after = self._shift(base, head)
            if after is not None:
                yield after

    def _closed(self, frontier: Frontier) -> dict[Node, tuple[int, int, str, int]]:
        """Every top that reductions and inserts reach: (cost, rank, terminals inserted, index in the frontier)."""
        best: dict[Node, tuple[int, int, str, int]] = {}
        todo = [(top, (cost, rank, "", k)) for k, (top, cost, rank) in enumerate(frontier)]
        while todo:
            top, value = todo.pop()
            # Equal costs and ranks have the same number of inserts.
            if top in best and best[top][:2] <= value[:2]:
                continue
            best[top] = value
            cost, rank, inserted, k = value
            todo += [(after, value) for after in self._reductions(top)]
            todo += [(after, (cost + INSERT, rank, inserted + t, k)) for t in ROLES if (after := self._shift(top, t)) is not None]
        return best

    def _advance(self, frontier: Frontier, initial: str, fault: str) -> tuple[Frontier, tuple[Move, ...], int]:
        """Frontier after a row, the move to each of its tops, and the cost taken off all of them."""
        best: dict[Node, tuple[int, tuple[int, str], Move]] = {}

        def offer(top: Node | None, cost: int, rank: int, move: Move) -> None:
            if top is not None:
                value = (cost, (rank, "I" * len(move[1]) + move[2]), move)
                if top not in best or value[:2] < best[top][:2]:
                    best[top] = value

        extra = TRUNCATED if fault == CUT else 0
        for top, (cost, rank, inserted, k) in self._closed(frontier).items():
            offer(top, cost + DELETE, rank, (k, inserted, "D", None))
            if fault in (FINE, CUT):
                offer(self._shift(top, initial), cost + KEEP + extra, rank, (k, inserted, "K", None))
                for t in ROLES:
                    offer(self._shift(top, t), cost + REROLE + extra, rank, (k, inserted, "R", t))
        tops = sorted(best, key=lambda top: top.number)
        ranks = {key: n for n, key in enumerate(sorted({best[top][1] for top in tops}))}
        least = min(best[top][0] for top in tops)
        return tuple((top, best[top][0] - least, ranks[best[top][1]]) for top in tops), tuple(best[top][2] for top in tops), least

    def _finish(self, frontier: Frontier) -> tuple[int, str, int]:
        """Cost, terminals inserted and index of the cheapest whole sentence."""
        done = [(cost, rank, inserted, k) for top, (cost, rank, inserted, k) in self._closed(frontier).items() if top.state == self.tables.accept]
        cost, _, inserted, k = min(done, key=lambda d: (d[0], d[1], "I" * len(d[2])))
        return cost, inserted, k


class Reading:
    """Audit, role initials and digest of one reading; the audit is shared with the readings it split from."""

    __slots__ = ("before", "audit", "initials", "digest", "any")

    def __init__(self, before: tuple | None, audit: str, initials: str, digest: hashlib._Hash, any_: bool):
        self.before, self.audit, self.initials, self.digest, self.any = before, audit, initials, digest, any_

    def extended(self, inserted: str, edit: str, role: str, text: str) -> Reading:
        before, audit, initials = self.before, self.audit + "I" * len(inserted) + edit, self.initials + inserted
        digest, some = self.digest, self.any
        lines = [f"{ROLES[t]}:" for t in inserted]
        if edit in ("K", "R"):
            lines.append(f"{role}:{text}")
            initials += role[:1]
        if lines:
            digest = digest.copy()
            digest.update((("\n" if some else "") + "\n".join(lines)).encode("utf-8", "surrogatepass"))
            some = True
        if len(audit) > CHUNK:
            before, audit, initials = (before, audit, initials), "", ""
        return Reading(before, audit, initials, digest, some)

    def whole(self) -> tuple[str, str]:
        audits, initials, at = [self.audit], [self.initials], self.before
        while at is not None:
            at, audit, some = at
            audits.append(audit)
            initials.append(some)
        return "".join(reversed(audits)), "".join(reversed(initials))


class Conversation:
    """Counts and readings of one conversation while its rows stream past."""

    def __init__(self, parser: Parser):
        self.parser, self.frontier, self.cost = parser, parser.first, 0
        self.readings = [Reading(None, "", "", hashlib.sha256(), False)]
        self.faults = dict.fromkeys((BLANK, DUPLICATE, CUT), 0)
        self.illegal, self.before = 0, None
        self.turns, self.first, self.last = 0, None, None

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        if turn is not None and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            self.first = turn if self.first is None else self.first
        bare = text.rstrip(WHITE)
        fault = BLANK if not bare else DUPLICATE if seen else FINE if bare[-1] in ".!?" else CUT
        if fault:
            self.faults[fault] += 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in GOES_ON:
            self.illegal += 1
        self.before = initial
        self.frontier, moves, off = self.parser.advance(self.frontier, initial if initial in self.parser.terminals else "", fault)
        self.cost += off
        self.readings = [self.readings[k].extended(inserted, edit, ROLES[t] if t else role, text) for k, inserted, edit, t in moves]

    def row(self) -> tuple:
        cost, inserted, k = self.parser.finish(self.frontier)
        reading = self.readings[k].extended(inserted, "", "", "")
        audit, initials = reading.whole()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return gaps, *self.faults.values(), self.illegal, self.cost + cost, audit, reading.digest.hexdigest(), initials


COLUMNS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, initials string"
_KINDS = (*[pa.int64()] * 7, *[pa.string()] * 3)
#: Characters of audits put into one batch of results.
BATCH = 1_000_000


@lru_cache(maxsize=1)
def parser() -> Parser:
    return Parser()


def _repair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, turn, role, text, seen), sorted -> one row for each conversation."""
    rows: list[tuple] = []
    now, conversation, size = None, None, 0
    names = ["conv_id", *(c.split()[0] for c in COLUMNS.split(", "))]

    def flush() -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names=names)

    for batch in batches:
        for conv_id, turn, role, text, seen in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if (conv_id,) != now:
                if conversation is not None:
                    rows.append((now[0], *conversation.row()))
                    size += 200 + len(rows[-1][7])
                    if size > BATCH:
                        yield flush()
                        rows, size = [], 0
                now, conversation = (conv_id,), Conversation(parser())
            conversation.add(turn, role, text, seen)
    if conversation is not None:
        rows.append((now[0], *conversation.row()))
        yield flush()


def _ordered(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turn, role, text, seen), each conversation in one partition."""
    rows = rows.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), *(F.coalesce(F.col(c), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text")))
    )
    # One shuffle: the window over equal rows of a conversation finds them where the conversation is.
    equal = Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))
    return rows.repartition("conv_id").withColumn("seen", F.row_number().over(equal) > 1)


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Of each conversation its faults, the cheapest repair with the initials of its edits, and the digest of the repaired rows.

    ``initials`` are the role initials after the repair; with ``audit`` they say what became of every row (``repaired_turns``).
    """
    ordered = _ordered(rows, conv_id, turn, role, text).sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "seen")
    return ordered.mapInArrow(_repair, f"conv_id long, {COLUMNS}")


def _apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, part, turn, role, text, seen, audit, initials), sorted: first the repair of a conversation, then its rows."""
    audit, initials, at, place = "", "", 0, 0
    for batch in batches:
        out: list[tuple] = []

        def inserts(conv_id: int | None) -> None:
            nonlocal at, place
            while audit[at : at + 1] == "I":
                out.append((conv_id, place, ROLES[initials[place]], "", "I"))  # noqa: B023
                at, place = at + 1, place + 1

        for conv_id, part, _, role, text, _, new_audit, new_initials in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part == 0:
                audit, initials, at, place = new_audit, new_initials, 0, 0
                inserts(conv_id)
                continue
            edit = audit[at]
            if edit != "D":
                out.append((conv_id, place, role if edit == "K" else ROLES[initials[place]], text, edit))
                place += 1
            at += 1
            inserts(conv_id)
        if out:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["conv_id", "place", "role", "text", "edit"])


def repaired_turns(rows: DataFrame, repairs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, place, role, text, edit): the rows of the repaired conversations, given what ``repair`` returned for ``rows``."""
    after = _ordered(rows, conv_id, turn, role, text).withColumns({"part": F.lit(1), "audit": F.lit(None).cast("string"), "initials": F.lit(None).cast("string")})
    before = repairs.select("conv_id", F.lit(0).alias("part"), *(F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("seen", "boolean"))), "audit", "initials")
    together = before.unionByName(after).repartition("conv_id").sortWithinPartitions("conv_id", "part", F.asc_nulls_first("turn"), "role", "text", "seen")
    columns = ("conv_id", "part", "turn", "role", "text", "seen", "audit", "initials")
    return together.select(*columns).mapInArrow(_apply, "conv_id long, place long, role string, text string, edit string")


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with a part of the rows dropped, emptied, cut, repeated or given the role user, by their hash."""
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", written("role").alias("role"), written("text").alias("text"), F.pmod(F.crc32(F.concat_ws(":", written("conv_id"), written("turn"))), F.lit(20)).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.where(F.col("kind") != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired; one without a row left counts zeros and has the digest of nothing."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair(damaged(rows)).drop("initials").withColumnRenamed("conv_id", "id")
    whole = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left").drop("id")
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return whole.fillna({**nothing, **dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)})
