"""Chat formatting in budgeted windows.

Turns of a conversation arrive in order. Prefix sums of their token counts choose spans of
whole turns that fit a window; every later window starts with the system turn and a
limited stretch of earlier turns again, and those repeated turns are outside the loss.

Template, one turn: <|start|>role<|text|>, a line end, the text, a line end, <|end|> and a line
end; a repeated turn opens with <|again|> instead. Inside roles and texts a backslash is
doubled, and control strings (of this template and of common others) get a backslash after
their first character.

A turn's size is the number of tokens of what is written for it, marks, role and escapes
included. Every turn ends with white space, across which the vocabulary never joins, so the
tokens of a window are the sum of its turns' sizes, and never more than the budget. A turn
too long for a window beside the system turn is cut into pieces, in windows of their own; all
but its first piece open with <|more|>. A system turn of more than half the budget isn't
repeated, and a turn whose role alone takes more than half of the room isn't cut.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from sigil.llm.tokens import tokenizer

BUDGET = 2048
HISTORY = 512

_CONTROL = re.compile(r"\\|<\||<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|(start|again|more)\|>(.*?)<\|text\|>\n(.*?)\n<\|end\|>\n", re.DOTALL)
_END = "\n<|end|>\n"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Turn(NamedTuple):
    """A turn, or a piece of one; size is the larger one of its sizes as a new and as a repeated turn."""

    role: str
    text: str
    size: int
    mark: str = "start"


class Window(NamedTuple):
    again: list[Turn]
    new: list[Turn]


def head(mark: str, role: str) -> str:
    return f"<|{mark}|>{escape(role)}<|text|>\n"


class Sizes:
    """Counts tokens of what is written for turns."""

    def __init__(self, count: Callable[[list[str]], list[int]]) -> None:
        self.count = count
        self.frames: dict[str, int] = {}

    def frame(self, role: str) -> int:
        """Tokens of all that a turn of this role has besides its text, under the dearest mark."""
        if role not in self.frames:
            if len(self.frames) > 1000:  # roles may be anything
                self.frames.clear()
            self.frames[role] = max(self.count([head(m, role) + _END for m in ("start", "again", "more")]))
        return self.frames[role]

    def turns(self, rows: list[tuple[str, str]]) -> Iterator[Turn]:
        for (role, text), n in zip(rows, self.count([escape(t) for _, t in rows]), strict=True):
            yield Turn(role, text, n + self.frame(role))

    def pieces(self, turn: Turn, budget: int) -> Iterator[Turn]:
        """The turn in pieces of at most budget tokens, cut after white space where there is some in a piece's last
        half. With a role of more than half the budget, which each piece would repeat, the turn stays whole.
        """
        room, at, mark = budget - self.frame(turn.role), 0, "start"
        if 2 * room < budget:
            yield turn
            return
        while at < len(turn.text):
            size = min(len(turn.text) - at, max(4 * room, 1))
            while (n := self.count([escape(turn.text[at : at + size])])[0]) > room and size > 1:
                size = max(1, min(size - 1, int(size * room / n)))
            if at + size < len(turn.text):
                space = max(turn.text.rfind(c, at + size // 2, at + size) for c in " \n\t")
                if space >= 0:
                    size = space + 1 - at
                    n = self.count([escape(turn.text[at : at + size])])[0]
            yield Turn(turn.role, turn.text[at : at + size], n + self.frame(turn.role), mark)
            at, mark = at + size, "more"


def windows(turns: Iterable[Turn], budget: int = BUDGET, history: int = HISTORY, sizes: Sizes | None = None) -> Iterator[Window]:
    """Spans of whole turns, in order, each turn new in exactly one of them, within the budget.

    With sizes, a turn that doesn't fit a window beside the system turn becomes pieces; without,
    it gets a window of its own. Memory: the turns of one window and of its history.
    """
    system: Turn | None = None
    past: list[Turn] = []
    sums = [0]  # prefix sums of past
    again: list[Turn] = []
    first = 0  # index in past of the window's first new turn
    room = budget
    for turn in turns:
        kept = system.size if system else 0
        for part in sizes.pieces(turn, budget - kept) if sizes and turn.size > budget - kept else (turn,):
            if len(past) > first and sums[-1] - sums[first] + part.size > room:
                yield Window(again, past[first:])
                most = min(history, budget - kept - part.size)
                begin = bisect_left(sums, sums[-1] - max(most, 0))
                again = ([system] if system else []) + [t for t in past[begin:] if t is not system]
                past, first = past[begin:], len(past) - begin
                sums = list(itertools.accumulate((t.size for t in past), initial=0))
                room = budget - sum(t.size for t in again)
            past.append(part)
            sums.append(sums[-1] + part.size)
        if system is None and turn.role == "system" and 2 * turn.size <= budget:
            system = turn
    if len(past) > first:
        yield Window(again, past[first:])


def render(window: Window) -> tuple[str, list[tuple[int, int]]]:
    """The window's text, and the spans of it (code points) that the loss covers: new assistant texts."""
    out, spans, at = [], [], 0
    for mark, turn in [*(("again", t) for t in window.again), *((t.mark, t) for t in window.new)]:
        begin, body = head(mark, turn.role), escape(turn.text)
        if mark != "again" and turn.role == "assistant":
            spans.append((at + len(begin), at + len(begin) + len(body)))
        out += [begin, body, _END]
        at += len(begin) + len(body) + len(_END)
    return "".join(out), spans


def token_sizes() -> Sizes:
    encode = tokenizer()
    return Sizes(lambda texts: [len(ids) for ids in encode.many(texts)])


def _rows(batches: Iterable[pa.RecordBatch], sizes: Sizes) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            said = [(r or "", t or "") for r, t in zip(part.column("role").to_pylist(), part.column("text").to_pylist(), strict=True)]
            yield from zip(part.column("conv_id").to_pylist(), sizes.turns(said), strict=True)


def format_chats(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window (from 0), n_again, n_new, text, loss (spans).

    turns has conv_id, turn, role, text; others are ignored. Turns are ordered by turn,
    nulls first; equal turn numbers by role, then text; repeated rows are separate turns.
    Null roles and texts are empty; rows without conv_id form one conversation. An empty
    table gives an empty table. A conversation streams through one task in order, since its
    windows depend on one another; a task holds one window at a time, not a conversation.
    No window has more than budget tokens: a longer turn is cut into pieces, of which only
    the first counts as the start of a turn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size, sizes = 0, token_sizes()
        for conv, rows in itertools.groupby(_rows(batches, sizes), key=lambda r: r[0]):
            for number, window in enumerate(windows((turn for _, turn in rows), budget, history, sizes)):
                text, loss = render(window)
                out.append((conv, number, len(window.again), len(window.new), text, loss))
                size += len(text)
                if size > 4_000_000:
                    yield _batch(out, kind)
                    out, size = [], 0
        if out:
            yield _batch(out, kind)

    rows = turns.select(turns["conv_id"], turns["turn"], turns["role"], turns["text"])
    kind = pa.int64() if dict(rows.dtypes)["conv_id"] in ("bigint", "int") else pa.string()
    rows = rows.withColumn("conv_id", rows["conv_id"].cast("long" if kind == pa.int64() else "string"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, f"conv_id {'long' if kind == pa.int64() else 'string'}, window int, n_again int, n_new int, text string, loss array<struct<start: long, end: long>>")


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    conv, number, again, new, text, loss = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(conv, kind),
            pa.array(number, pa.int32()),
            pa.array(again, pa.int32()),
            pa.array(new, pa.int32()),
            pa.array(text, pa.string()),
            pa.array([[{"start": s, "end": e} for s, e in spans] for spans in loss], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ],
        names=["conv_id", "window", "n_again", "n_new", "text", "loss"],
    )


def parse(text: str) -> Iterator[tuple[str, str, str]]:
    """(mark, role, text) of every turn of a window's text."""
    for m in _TURN.finditer(text):
        yield m[1], unescape(m[2]), unescape(m[3])


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from the formatted text and its loss spans alone: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    formatted is what format_chats returned, in its own partitions and order.
    """

    def windows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss")), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, rows in itertools.groupby(windows_of(batches), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = loss_chars = chars = 0
            for _, text, spans in rows:
                chars += len(text)
                for mark, role, said in parse(text):
                    if mark == "start":
                        turns.update(f"{'\n' * (n > 0)}{role}\n{said}".encode())
                        n += 1
                    elif mark == "more":
                        turns.update(said.encode())
                for span in spans:
                    said = unescape(text[span["start"] : span["end"]])
                    loss_chars += len(said)
                    loss.update(said.encode())
            turns.update(b"\n" * (n > 0))
            out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(out) == 5000:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema)

    kind = pa.int64() if dict(formatted.dtypes)["conv_id"] == "bigint" else pa.string()
    schema = pa.schema([("conv_id", kind), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    return formatted.mapInArrow(run, f"conv_id {dict(formatted.dtypes)['conv_id']}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
