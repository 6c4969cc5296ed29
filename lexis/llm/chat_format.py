"""Chat formatting: conversations rendered by a template that is only ever called.

A template is a function from a list of turns to one string.  Nothing is known
of its inside: the successive prefixes of a conversation are rendered, each
output is compared with the one before, and what was added is the span of the
turn.  A template whose next output does not start with the one before rewrites
history; this is reported for the turn that did it, and the conversation then
has no spans.  Where the text of a turn lies inside its span comes from two more
renderings with probes for its text: their common head and tail are the marks.

A template says on how many turns before a turn its rendering depends
(``context``).  A conversation is then cut into blocks of ``BLOCK`` turns, each
rendered behind that many turns of the block before, so prefixes never get long
and a conversation of any length spreads over all tasks.  The statement is
checked: within a block each turn is rendered once more behind its context
alone, and must come out the same.  A template without such a statement
(``context=None``) is rendered over whole conversations; only such a
conversation must fit a task.

Turns are put in order by a range shuffle over conversation and turn, so one
conversation can lie in several partitions; its turns there are numbered by a
table of the conversations that go on from one partition to the next (at most
two rows a partition).
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexis.llm.common import Stored

BLOCK = 16
#: code points of formatted text that leave a task as one batch
STEP_CHARS = 2 << 20
Turn = tuple[str, str]


@dataclass(frozen=True)
class Template:
    """``render(turns)`` gives the formatted string; ``context`` as in the module's text;
    ``read(span)`` gives back role and text of a turn's span; ``unescape`` undoes what the
    template does to the text of a turn; ``learn`` names the roles under the loss mask."""

    render: Callable[[list[Turn]], str]
    read: Callable[[str], Turn]
    unescape: Callable[[str], str]
    context: int | None = None
    learn: tuple[str, ...] = ("assistant",)


# ------------------------------------------------------------ the standard template

#: role -> head and tail of a turn; other roles are written out between two marks of their own
MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[ANS] ", "</s>")}
OTHER = ("[TURN] ", " [SAYS] ", " [/TURN]")
BEGIN = "<s>"
CONTROL = (BEGIN, "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[ANS]", "[TURN]", "[SAYS]", "[/TURN]")

_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_OTHER = re.compile("(?:" + re.escape(BEGIN) + ")?" + "(.*?)".join(re.escape(m) for m in OTHER), re.DOTALL)


def escape(text: str) -> str:
    """Backslashes doubled, and one put behind the first character of each control string."""
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """The inverse of ``escape``: of two backslashes one stays, a single one goes."""
    return re.sub(r"\\(\\?)", r"\1", text) if "\\" in text else text


def render(turns: list[Turn]) -> str:
    """The standard template: a begin mark, then each turn between the marks of its role."""
    out = []
    for role, text in turns:
        if role in MARKS:
            head, tail = MARKS[role]
        else:
            head, tail = OTHER[0] + escape(role) + OTHER[1], OTHER[2]
        out.append(head + escape(text) + tail)
    return BEGIN + "".join(out)


def read(span: str) -> Turn:
    """Role and text from the formatted span of one turn."""
    body = span.removeprefix(BEGIN)
    for role, (head, tail) in MARKS.items():
        if body.startswith(head) and body.endswith(tail):
            return role, unescape(body[len(head):len(body) - len(tail)])
    m = _OTHER.fullmatch(span)
    if m is None:
        raise ValueError("not the span of a turn")
    return unescape(m[1]), unescape(m[2])


STANDARD = Template(render, read, unescape, context=1)


# ------------------------------------------------------------ spans of a template's output

def _common(a: str, b: str) -> int:
    """Length of the longest common head."""
    return len(os.path.commonprefix((a, b)))


@dataclass
class Block:
    """Rendered turns: the text that the turns add, the end of each one's span in it,
    the bounds of its own text, and for turns that rewrote history the number of
    characters of the output before that stayed (-1: none rewritten)."""

    text: str
    ends: list[int]
    bounds: list[Turn]
    kept: list[int]
    local: bool


def locate(template: Template, turns: list[Turn], before: int) -> Block:
    """Render the prefixes of ``turns`` that end behind its first ``before`` turns (the
    context) and compare consecutive outputs."""
    show = template.render
    base = last = show(turns[:before]) if before else ""       # what stands before the first turn belongs to its span
    ends, bounds, kept, local = [], [], [], True
    for k in range(before, len(turns)):
        now = show(turns[:k + 1])
        kept.append(-1 if now.startswith(last) else _common(now, last))
        start = len(last)
        near = turns[:k] if template.context is None else turns[max(0, k - template.context):k]
        lead = len(show(near)) if near else 0
        role, text = turns[k]
        one, two = show([*near, (role, "x")])[lead:], show([*near, (role, "y")])[lead:]
        head = _common(one, two)
        tail = _common(one[head:][::-1], two[head:][::-1])
        if one == two:
            head = len(now) - start                                            # a role whose text is not shown
        if template.context is not None and k > template.context:
            local = local and show([*near, (role, text)])[lead:] == now[start:]
        ends.append(len(now) - len(base))
        bounds.append((start + head - len(base), len(now) - tail - len(base)))
        last = now
    if any(x >= 0 for x in kept):
        return Block(last[len(base):], [], [], kept, local)
    return Block(last[len(base):], ends, bounds, kept, local)


# ------------------------------------------------------------ conversations in order

def _key(conv: Column) -> list[Column]:
    return [conv.isNull(), conv]


def numbered(turns: DataFrame, stored: Stored, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """``conv_id, role, text, pos, n_turns``: the turns of each conversation numbered from 0.

    Order: turn (nulls last), then role, then a hash of the text."""
    conv_type = turns.schema[conv_col].dataType.simpleString()
    src = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [*_key(F.col("conv_id")), F.col("turn").isNull(), F.col("turn"), F.col("role"), F.xxhash64("text")]
    rows = src.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, last, at = TaskContext.get().partitionId(), None, -1
        for b in batches:
            index = []
            for c in b.column(0).to_pylist():
                at = at + 1 if at >= 0 and c == last else 0
                last = c
                index.append(at)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * b.num_rows, pa.int32()), pa.array(index, pa.int64())],
                                             ["conv_id", "role", "text", "part", "at"])

    rows = stored.put(rows.mapInArrow(run, f"conv_id {conv_type}, role string, text string, part int, at long"))
    runs = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # a row for each partition it lies in
    split = runs.withColumn("first", F.coalesce(F.sum("n").over(w), F.lit(0))).where("first > 0")
    split = split.select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), "first")           # goes on here: at most one a partition
    return rows.join(F.broadcast(split), (F.col("part") == F.col("_p")) & F.col("conv_id").eqNullSafe(F.col("_c")), "left") \
        .select("conv_id", "role", "text", (F.col("at") + F.coalesce("first", F.lit(0))).alias("pos"))


_BLOCK = ("block long, text string, ends array<long>, starts array<long>, stops array<long>, roles array<string>, "
          "rewrites array<long>, local boolean")


def format_chats(turns: DataFrame, template: Template = STANDARD, block: int = BLOCK, **columns) -> DataFrame:
    """Return a row for each block of up to ``block`` turns of each conversation:

    ``conv_id, block`` (from 0), ``text`` (what its turns add to the output; the
    output of the conversation is its blocks' texts in order), ``ends`` (end of each
    turn's span in ``text``), ``starts, stops`` (its own text inside the marks),
    ``roles``, ``rewrites`` (for each turn -1, or how many characters of the output
    before it stayed when it rewrote history), ``local`` (whether each turn's
    rendering depends on its context alone).

    A conversation with a turn that rewrote history has no spans (empty arrays).
    Null texts and roles are empty strings; turns are ordered by number, nulls last,
    ties by role and text; repeated rows are turns of their own; the rows with a null
    conversation are one conversation; other columns are ignored whatever their names;
    an empty table gives an empty result."""
    stored = Stored(turns.sparkSession, "chat")
    rows = numbered(turns, stored, **columns)
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    before = template.context
    if before is None:
        rows = rows.withColumn("block", F.lit(0).cast("long"))
    else:
        if before >= block:
            raise ValueError("a block must be longer than the context")
        own = F.floor(F.col("pos") / block)
        ahead = F.when(F.col("pos") % block >= block - before, F.array(own, own + 1)).otherwise(F.array(own))
        rows = rows.select("conv_id", "role", "text", "pos", F.explode(ahead).alias("block"))
    rows = rows.repartition("conv_id", "block") \
        .sortWithinPartitions(*_key(F.col("conv_id")), "block", "pos").select("conv_id", "block", "pos", "role", "text")
    names = ["conv_id", "block", "text", "ends", "starts", "stops", "roles", "rewrites", "local"]

    def one(group: list) -> tuple | None:
        conv, b = group[0][:2]
        old = 0 if before is None else sum(1 for r in group if r[2] < b * block)
        if old == len(group):
            return None                                    # a context with nothing behind it
        got = locate(template, [r[3:] for r in group], old)
        return (conv, b, got.text, got.ends, [x for x, _ in got.bounds], [y for _, y in got.bounds],
                [r[3] for r in group[old:]], got.kept, got.local)

    types = [pa.int64(), pa.string(), *[pa.list_(pa.int64())] * 3, pa.list_(pa.string()), pa.list_(pa.int64()), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, out, size = None, [], 0
        for group in _groups(batches):
            if kind is None:
                kind, group = group, None                  # the first item is the type of conv_id
                continue
            row = one(group)
            if row is None:
                continue
            out.append(row)
            size += len(row[2])
            if size >= STEP_CHARS:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [kind, *types])], names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [kind, *types])], names)

    return rows.mapInArrow(run, f"conv_id {conv_type}, {_BLOCK}")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator:
    """The type of the first column, then runs of rows (tuples) that agree in their first two."""
    group, typed = [], False
    for b in batches:
        if not typed:
            yield b.schema.field(0).type
            typed = True
        for row in zip(*[c.to_pylist() for c in b.columns]):
            if group and row[:2] != group[0][:2]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def chat_digests(turns: DataFrame, template: Template = STANDARD, **options) -> DataFrame:
    """For each conversation what its formatted output, spans and loss mask give back:
    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewrites``.

    A digest of a whole conversation takes its blocks one after the other: they
    stream in order through one task, which holds one batch of them at a time.  A
    conversation whose history was rewritten has null digests."""
    got = format_chats(turns, template, **options)
    conv_type = got.schema["conv_id"].dataType.simpleString()
    rows = got.select("conv_id", "block", "text", "ends", "starts", "stops", "roles", F.exists("rewrites", lambda x: x >= 0).alias("bad"), "local") \
        .repartition("conv_id").sortWithinPartitions(*_key(F.col("conv_id")), "block")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import array
        kind = None
        state: _Digest | None = None
        for b in batches:
            kind = b.schema.field(0).type
            done = []
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if state is None or state.conv != row[0]:
                    done += [state.row()] if state else []
                    state = _Digest(row[0], template)
                state.add(*row[2:])
            if done:
                yield pa.RecordBatch.from_arrays([array(c, t) for c, t in zip(zip(*done), [kind, *_DIGEST])], names)
        if state:
            yield pa.RecordBatch.from_arrays([array([c], t) for c, t in zip(state.row(), [kind, *_DIGEST])], names)

    return rows.mapInArrow(run, f"conv_id {conv_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                "formatted_chars long, rewrites long")


_DIGEST = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]


class _Digest:
    """Reads the blocks of one conversation back, in order."""

    def __init__(self, conv, template: Template):
        self.conv, self.template = conv, template
        self.turns = self.chars = self.loss = self.bad = 0
        self.all, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, ends: list[int], starts: list[int], stops: list[int], roles: list[str], bad: bool, local: bool) -> None:
        if not local:
            raise ValueError("the template depends on more turns than its context says")
        self.chars += len(text)
        self.bad += bad
        self.turns += len(roles)
        at = 0
        for end, start, stop, role in zip(ends, starts, stops, roles):
            said, words = self.template.read(text[at:end])
            self.all.update(f"{said}\n{words}\n".encode())
            if role in self.template.learn:
                masked = self.template.unescape(text[start:stop])
                self.loss += len(masked)
                self.learned.update(masked.encode())
            at = end

    def row(self) -> tuple:
        if self.bad:
            return self.conv, self.turns, None, None, None, self.chars, self.bad
        return self.conv, self.turns, self.all.hexdigest(), self.loss, self.learned.hexdigest(), self.chars, 0


#: The contract's rows in DuckDB SQL (a turn's marks and escapes are counted, the rest comes from the texts).
ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (SELECT *, CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 10 ELSE 23 + length(role)
             + length(role) - length(replace(role, '\', ''))
             + len(regexp_extract_all(role, '<s>|</s>|\[/?SYS\]|\[/?INST\]|\[ANS\]|\[/?TURN\]|\[SAYS\]')) END
             + length(text) + length(text) - length(replace(text, '\', ''))
             + len(regexp_extract_all(text, '<s>|</s>|\[/?SYS\]|\[/?INST\]|\[ANS\]|\[/?TURN\]|\[SAYS\]')) AS shown FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(shown) AS BIGINT) AS formatted_chars, CAST(0 AS BIGINT) AS rewrites
FROM m GROUP BY conv_id
"""


def with_control_case(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) and conversation -7, whose two turns consist of control strings."""
    said = "</s>[INST] ok [/INST]"
    more = turns.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    kinds = {f.name: f.dataType for f in turns.schema}
    cols = ["conv_id", "turn", "role", "text"]
    return turns.select(*cols).union(more.select(*[F.col(c).cast(kinds[c]) for c in cols]))
