"""Chat formatting (operator 10): a finite-state machine over roles.

A declarative ``ChatTemplate`` names the marks around a turn, the roles under
the loss mask, and the machine's transitions.  Formatting a conversation gives
text segments, each with its loss flag; the marks never carry loss.

Escaping is reversible and keeps every control string out of the texts: each
backslash is doubled, and a backslash follows each character that begins a
control string.  Reading halves every run of backslashes, dropping an odd one.

``format_segments`` gives the formatted text as rows, and ``read_segments`` reads
such rows as a stream, so no conversation has to fit a string, a cell or a
worker; ``format_chat`` is for conversations that do fit one cell.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches


@dataclass(frozen=True)
class ChatTemplate:
    """Marks, loss roles and transitions (state, role) -> state.  A turn's text
    is ``open role body text close``; a conversation has to end in ``final``."""

    open: str = "<turn>"
    body: str = "<text>"
    close: str = "</turn>\n"
    loss_roles: frozenset = frozenset({"assistant"})
    start: str = "start"
    final: frozenset = frozenset({"answered"})
    moves: tuple = field(default=(
        ("start", "system", "briefed"), ("start", "user", "asked"), ("briefed", "user", "asked"),
        ("asked", "assistant", "answered"), ("answered", "user", "asked")))

    def __post_init__(self):
        marks = (self.open, self.body, self.close)
        if not all(marks) or any("\\" in m for m in marks) or len(set(marks)) < 3:
            raise ValueError("marks must differ, be non-empty and hold no backslash")

    @cached_property
    def starters(self) -> list[str]:
        return sorted({m[0] for m in (self.open, self.body, self.close)})

    def escape(self, text: str) -> str:
        text = text.replace("\\", "\\\\")
        for c in self.starters:
            text = text.replace(c, c + "\\")
        return text

    @staticmethod
    def unescape(text: str) -> str:
        return "\\".join(part.replace("\\", "") for part in text.split("\\\\"))

    def step(self, state: str | None, role: str) -> str | None:
        """The next state; None (and from then on None) if the role is not allowed."""
        return next((to for at, r, to in self.moves if at == state and r == role), None)

    def segments(self, role: str, text: str) -> Iterator[tuple[str, bool]]:
        loss = role in self.loss_roles
        yield f"{self.open}{self.escape(role)}{self.body}", False
        yield self.escape(text), loss
        yield self.close, False

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of each turn of a formatted conversation."""
        at, out = 0, []
        while at < len(formatted):
            if not formatted.startswith(self.open, at):
                raise ValueError("text between turns")
            body = formatted.find(self.body, at + len(self.open))
            close = formatted.find(self.close, body + len(self.body)) if body >= 0 else -1
            if close < 0:
                raise ValueError("the last turn is not whole")
            out.append((self.unescape(formatted[at + len(self.open):body]),
                        self.unescape(formatted[body + len(self.body):close])))
            at = close + len(self.close)
        return out


FORMATTED = ("conv_id long, valid boolean, end_state string, bad_turn long, n_segments long, formatted string, "
             "loss_spans array<struct<start:long,end:long>>")
_ARROW = pa.schema([("conv_id", pa.int64()), ("valid", pa.bool_()), ("end_state", pa.string()),
                    ("bad_turn", pa.int64()), ("n_segments", pa.int64()), ("formatted", pa.string()),
                    ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
SEGMENTS = "conv_id long, position long, piece string, loss boolean, state string"
_SEGMENTS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("piece", pa.string()),
                       ("loss", pa.bool_()), ("state", pa.string())])
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, valid boolean, end_state string, bad_turn long")
_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                      ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                      ("valid", pa.bool_()), ("end_state", pa.string()), ("bad_turn", pa.int64())])
#: Characters of an output batch, beyond its last row.
BATCH_CHARS = 1 << 20


def _sorted(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    sel = rows.select(F.col(f"`{conv_col}`").cast("long").alias("c"), F.col(f"`{turn_col}`").cast("long").alias("t"),
                      F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("r"),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("x"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return sel.repartition(n, "c").sortWithinPartitions("c", "t", "r", "x").select("c", "r", "x")


def _rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of the batches, some hundred Python objects at a time."""
    for b in parts:
        for at in range(0, b.num_rows, 256):
            cut = b.slice(at, 256)
            yield from zip(*(c.to_pylist() for c in cut.columns), strict=True)


def walk(turns: Iterator[tuple], template: ChatTemplate) -> Iterator[tuple]:
    """(conv, position, piece, loss, state after the turn) of sorted turns
    (conv, role, text), one turn in memory at a time."""
    for conv, group in itertools.groupby(turns, key=lambda t: t[0]):
        state, at = template.start, 0
        for _, role, text in group:
            state = template.step(state, role)
            for piece, loss in template.segments(role, text):
                yield conv, at, piece, loss, state
                at += 1


def format_segments(rows: DataFrame, template: ChatTemplate = ChatTemplate(), conv_col: str = "conv_id",
                    turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The formatted conversations as rows (conv_id, position, piece, loss,
    state): the pieces in the order of ``position``, counted from 0, are the
    text, ``loss`` is the piece's loss flag, and ``state`` the machine's state
    after the piece's turn (NULL from the first turn on that is not allowed).

    Order of turns, NULLs and repeated rows as in ``format_chat``.  The rows of
    a conversation come one after another in one partition; a task holds one
    turn at a time, however long the conversation.
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(_SEGMENTS, walk(_rows(parts), template), 4096, lambda r: len(r[2]), BATCH_CHARS)

    return _sorted(rows, conv_col, turn_col, role_col, text_col).mapInArrow(run, SEGMENTS)


def format_chat(rows: DataFrame, template: ChatTemplate = ChatTemplate(), conv_col: str = "conv_id",
                turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: the formatted text, the code-point spans under
    the loss mask (one per loss segment, empty ones too), and the machine's
    verdict: ``valid``, its last state (NULL after a turn that is not allowed)
    and the number of the first such turn, counted from 0.

    Turns are put in the order (turn, role, text), NULL turns first; repeated
    rows are repeated turns.  NULL roles and texts count as empty; a role the
    machine does not know is formatted and makes the conversation invalid.
    Rows with a NULL conv_id form one conversation.  Extra columns are ignored;
    an empty table gives an empty one.  A conversation is one cell here and has
    to fit a worker; ``format_segments`` has no such bound.
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def convs() -> Iterator[tuple]:
            for conv, group in itertools.groupby(walk(_rows(parts), template), key=lambda s: s[0]):
                state, bad, out, spans, at = None, None, [], [], 0
                for _, k, piece, loss, state in group:
                    bad = k // 3 if state is None and bad is None else bad
                    if loss:
                        spans.append({"start": at, "end": at + len(piece)})
                    out.append(piece)
                    at += len(piece)
                yield conv, bad is None and state in template.final, state, bad, len(out), "".join(out), spans
        yield from batches(_ARROW, convs(), 256, lambda r: len(r[5]), BATCH_CHARS)

    return _sorted(rows, conv_col, turn_col, role_col, text_col).mapInArrow(run, FORMATTED)


def segments(formatted: DataFrame) -> DataFrame:
    """The loss segments of ``format_chat`` as rows (conv_id, segment, text)."""
    return formatted.select("conv_id", "formatted", F.posexplode("loss_spans").alias("segment", "s")).select(
        "conv_id", "segment", F.expr("substring(formatted, cast(s.start + 1 as int), cast(s.end - s.start as int))")
        .alias("text"))


class _Reading:
    """Digests of one conversation, fed its segments in order."""

    def __init__(self, conv: int | None, template: ChatTemplate):
        self.conv, self.template, self.turn = conv, template, []
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.chars = self.loss_chars = 0
        self.state = self.bad = None

    def add(self, position: int, piece: str, loss: bool, state: str | None) -> None:
        if position != self.n:
            raise ValueError("the segments of a conversation do not follow one another")
        if state is None and self.bad is None:
            self.bad = position // 3
        self.n, self.chars, self.state = self.n + 1, self.chars + len(piece), state
        if loss:
            text = self.template.unescape(piece)
            self.loss_chars += len(text)
            self.loss.update(_utf8(text))
        self.turn.append(piece)
        if len(self.turn) == 3:
            (role, text), = self.template.parse("".join(self.turn))
            self.turns.update(_utf8(f"{role}\n{text}\n"))
            self.turn = []

    def row(self) -> tuple:
        if self.turn:
            raise ValueError("the last turn of a conversation is not whole")
        return (self.conv, self.n // 3, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.bad is None and self.state in self.template.final, self.state, self.bad)


def digests(pieces: Iterator[tuple], template: ChatTemplate) -> Iterator[tuple]:
    """A row of ``DIGESTS`` per conversation of a stream of segments."""
    for conv, group in itertools.groupby(pieces, key=lambda s: s[0]):
        now = _Reading(conv, template)
        for s in group:
            now.add(*s[1:])
        yield now.row()


def read_segments(segments: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conversation, read from the rows of ``format_segments``: the
    turns parsed from the formatted pieces and the texts under the loss mask as
    digests, their lengths, and the machine's verdict as in ``format_chat``.

    A task reads its partition as a stream and holds one turn at a time.  The
    segments must come as ``format_segments`` gives them (stored ones have to
    be partitioned by conv_id and sorted by position again); a segment out of
    its place fails the query.
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(_DIGESTS, digests(_rows(parts), template), 256)

    return segments.select("conv_id", "position", "piece", "loss", "state").mapInArrow(run, DIGESTS)


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")
