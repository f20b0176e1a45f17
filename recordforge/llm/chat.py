r"""Chat formatting with a grammar round trip.

Grammar of a rendered conversation::

    conversation = { turn }
    turn         = "### " role ": " body "</turn>\n"
    role         = "System" | "User" | "Assistant" | "Tool" | "role=" escaped        (names of the first four: in lower case)
    body         = text in which every "\" that stands before a control string or before another "\" is an escape

A control string is ``### `` or ``</turn>``.  The parser reads one turn after the other, undoes escapes and rejects a control
string that is not escaped.  Rendering starts with the raw text; the rendered turn is reparsed, and as long as the
recovered role and text are not those of the source, conflicting content is escaped at the next stronger level: first the
control strings with backslashes before them, then every backslash and control string.  The last level always reads back.

A turn is rendered by itself, and its reading does not depend on other turns, so rendering needs no shuffle.  Reading back
streams each conversation, sorted by turn, through one task turn by turn: nothing holds a conversation, however long,
and the digests are updated piece by piece.

Nulls: null texts and roles count as empty; rows with a null conv_id form one conversation; null turns come first.  Rows
of equal turn are ordered by role and text, repeated rows are turns of their own.  An empty table gives no conversation.
Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.llm.common import table
from recordforge.llm.registry import query

NAMES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
ROLES = {name: role for role, name in NAMES.items()}
HEAD, END = "### ", "</turn>\n"
LEARNED = "assistant"

_CONFLICT = re.compile(r"(?=### |</turn>)")
_STRICT = re.compile(r"(?=\\|### |</turn>)")
#: What ends a stretch of plain body text: an escape, a control string.
_STOP = re.compile(r"\\(?=\\|### |</turn>)|### |</turn>\n|</turn>")
_ROLE = re.compile(r"(System|User|Assistant|Tool|role=(?:[^\\:\n]|\\[\\:n])*): ")


class Unreadable(ValueError):
    """Text that the grammar does not derive."""


def _role_out(role: str) -> str:
    return NAMES.get(role) or "role=" + role.replace("\\", "\\\\").replace(":", "\\:").replace("\n", "\\n")


def _role_in(name: str) -> str:
    if name in ROLES:
        return ROLES[name]
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], name.removeprefix("role="))


def read_turn(rendered: str, at: int = 0) -> tuple[str, str, tuple[int, int], int]:
    """Role, text, span of the body and end of the turn that starts at ``at``; ``Unreadable`` if there is none."""
    head = _ROLE.match(rendered, at + len(HEAD)) if rendered.startswith(HEAD, at) else None
    if head is None:
        raise Unreadable("no turn starts here")
    first = i = head.end()
    parts = []
    while True:
        stop = _STOP.search(rendered, i)
        if stop is None:
            raise Unreadable("a turn without an end")
        parts.append(rendered[i : stop.start()])
        if stop[0] == "\\":
            # The escaped string itself is plain text.
            mark = "\\" if rendered[stop.end()] == "\\" else "### " if rendered[stop.end()] == "#" else "</turn>"
            parts.append(mark)
            i = stop.end() + len(mark)
        elif stop[0] == END:
            return _role_in(head[1]), "".join(parts), (first, stop.start()), stop.end()
        else:
            raise Unreadable("a control string inside a text")


def unescape(body: str) -> str:
    """The text of a body."""
    return read_turn(HEAD + "User: " + body + END)[1]


def render_turn(role: str, text: str) -> str:
    """The turn with as little escaping as reads back to the same role and text."""
    for body in (text, _CONFLICT.sub(r"\\", text), _STRICT.sub(r"\\", text)):
        rendered = HEAD + _role_out(role) + ": " + body + END
        try:
            found = read_turn(rendered)
        except Unreadable:
            continue
        if found[:2] == (role, text) and found[3] == len(rendered):
            return rendered
    raise Unreadable("no level of escaping reads back")


def format_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, rendered): each row as a piece of its conversation, whose text is the pieces in order."""

    @F.pandas_udf("string")
    def rendered(roles: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([render_turn(r, t) for r, t in zip(roles, texts, strict=True)], dtype=object)

    rows = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), *(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))))
    return rows.withColumn("rendered", rendered("role", "text"))


def _read_back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by conversation and turn -> one row of digests for each conversation."""
    rows: list[tuple] = []
    now, turns, loss, counts = None, None, None, [0, 0, 0]

    def close() -> None:
        if turns is not None:
            rows.append((now[0], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        rows.clear()
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))

    for batch in batches:
        for conv_id, rendered in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if (conv_id,) != now:
                close()
                now, turns, loss, counts = (conv_id,), hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                if len(rows) >= 5000:
                    yield flush()
            at = 0
            while at < len(rendered):
                role, text, (first, last), at = read_turn(rendered, at)
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                counts[0] += 1
                if role == LEARNED:
                    learned = unescape(rendered[first:last])
                    loss.update(learned.encode("utf-8", "surrogatepass"))
                    counts[1] += len(learned)
            counts[2] += len(rendered)
    close()
    if rows:
        yield flush()


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of what a parser finds in the formatted conversations (rows conv_id, turn, role, text, rendered)."""
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.select("conv_id", "rendered").mapInArrow(_read_back, schema)


def conversations(pieces: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): each conversation as one string, with the code-point spans (start, end) under the loss mask.

    For use where conversations fit into a row; ``read_back`` needs no such bound.
    """
    inside = F.array_sort(F.collect_list(F.struct("turn", "role", "text", "rendered")))
    rows = pieces.groupBy("conv_id").agg(inside.alias("t"))

    @F.pandas_udf("array<struct<start: long, end: long>>")
    def spans(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            at, found = 0, []
            while at < len(text):
                role, _, span, at = read_turn(text, at)
                if role == LEARNED:
                    found.append({"start": span[0], "end": span[1]})
            out.append(found)
        return pd.Series(out, dtype=object)

    return rows.select("conv_id", F.array_join(F.col("t.rendered"), "").alias("formatted")).withColumn("loss", spans("formatted"))


@query(
    "op2_chat_format",
    r"""with turns as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marks as (select *, (length(text) - length(replace(text, '### ', ''))) // 4 + (length(text) - length(replace(text, '</turn>', ''))) // 7 as controls,
  length(text) - length(replace(text, '\', '')) as slashes,
  contains(text, '\\') or contains(text, '\### ') or contains(text, '\</turn>') or ends_with(text, '\') as slash_conflict,
  case when role in ('system', 'user', 'assistant', 'tool') then length(role) else 5 + length(replace(replace(replace(role, '\', '\\'), ':', '\:'), chr(10), '\n')) end as role_chars
  from turns)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(14 + role_chars + length(text) + case when slash_conflict then controls + slashes else controls end)::bigint as formatted_chars
from marks group by conv_id""",
)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one full of control strings, formatted and read back."""
    own = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(format_turns(rows))
