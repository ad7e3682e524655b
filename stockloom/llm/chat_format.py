"""Chat formatting whose text a deterministic parser reads back to the same turns.

Grammar: a text is a run of turns; a turn is its role's opening mark, literal text and its
closing mark. Any control string inside literal text is an error to the parser, and it
takes one backslash out of each escaped control string, which is a control string with
backslashes after its first character. So a turn is rendered as it is, read back and
compared with its source. If they differ, its control strings get a backslash; if they
still differ, so do those strings that only look escaped. Then every turn reads back.

Turns of a conversation are put in order by a shuffle on its id and streamed, so memory is
bounded by a batch and the largest text, not by a conversation. A conversation longer than
PIECE code points comes as several numbered rows, cut between turns.

Defined cases: a null text or role is empty. Turns are ordered by turn, role, text, null
turns first; repeated rows are repeated turns. Rows without conv_id are one conversation
without id. A role without marks of its own is written out within generic marks, and
escaped there like a text. Columns other than the four are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Code points after which a conversation goes on in a further row.
PIECE = 1_000_000

# Opening and closing mark of each role.
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
}
# Marks of any other role: before its name, between name and text, after the text.
OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]")

# The role whose text a model learns from.
LEARNED = "assistant"


class Turn(NamedTuple):
    """A turn read from formatted text; ``start`` and ``end`` enclose its escaped text."""

    role: str
    text: str
    start: int
    end: int


class Malformed(ValueError):
    """The text does not follow the grammar."""


class Template:
    """Marks, escapes and the parser that belongs to them."""

    def __init__(self, marks: dict[str, tuple[str, str]], other: tuple[str, str, str]) -> None:
        strings = sorted({s for pair in marks.values() for s in pair} | set(other))
        if len(strings) != 2 * len(marks) + 3 or any(len(s) < 2 or "\\" in s for s in strings):
            raise ValueError("marks must differ, have two characters or more and no backslash")
        if any(a != b and a in b for a in strings for b in strings):
            raise ValueError("no mark may lie inside another")
        if any(a.startswith(b[k:]) for a in strings for b in strings for k in range(1, len(b))):
            raise ValueError("no mark may begin with the end of one")
        self.marks, self.other = marks, other
        self.roles = {opening: role for role, (opening, _) in marks.items()}

        def places(form: str) -> re.Pattern:
            """Where a string goes on after its first character, as ``form`` describes."""
            forms = (f"(?<={re.escape(m[0])}){form.format(re.escape(m[1:]))}" for m in strings)
            return re.compile("|".join(forms))

        self.plain = re.compile("|".join(map(re.escape, strings)))
        self.exact = places("(?={})")
        self.lookalike = places(r"(?=\\*{})")
        self.escaped = places(r"\\(?=\\*{})")

    def escape(self, text: str, level: int) -> str:
        """``text`` itself, with control strings escaped, or with lookalikes escaped too."""
        if level == 0:
            return text
        return (self.exact if level == 1 else self.lookalike).sub(r"\\", text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub("", text) if "\\" in text else text

    def render(self, role: str, text: str, level: int) -> str:
        if role in self.marks:
            opening, closing = self.marks[role]
            return opening + self.escape(text, level) + closing
        before, between, after = self.other
        return before + self.escape(role, level) + between + self.escape(text, level) + after

    def parse(self, formatted: str) -> Iterator[Turn]:
        """The turns of formatted text; Malformed where it does not follow the grammar."""
        place, tokens = 0, self.plain.finditer(formatted)

        def mark(wanted: str | None, at: int | None) -> re.Match:
            token = next(tokens, None)
            if token is None or (wanted is not None and token[0] != wanted):
                raise Malformed(f"{wanted or 'a mark'} expected after {place}")
            if at is not None and token.start() != at:
                raise Malformed(f"text between turns at {at}")
            return token

        while place < len(formatted):
            opening = mark(None, place)
            if opening[0] in self.roles:
                role = self.roles[opening[0]]
                start, closing = opening.end(), mark(self.marks[role][1], None)
            elif opening[0] == self.other[0]:
                between = mark(self.other[1], None)
                role = self.unescape(formatted[opening.end() : between.start()])
                if role in self.marks:
                    raise Malformed(f"{role!r} has marks of its own")
                start, closing = between.end(), mark(self.other[2], None)
            else:
                raise Malformed(f"no turn opens with {opening[0]}")
            end = closing.start()
            yield Turn(role, self.unescape(formatted[start:end]), start, end)
            place = closing.end()

    def settled(self, role: str, text: str) -> str:
        """The turn rendered at the first level at which it reads back as it was."""
        for level in range(3):
            formatted = self.render(role, text, level)
            try:
                if [(t.role, t.text) for t in self.parse(formatted)] == [(role, text)]:
                    return formatted
            except Malformed:
                continue
        raise Malformed("the grammar cannot hold this turn")  # pragma: no cover


TEMPLATE = Template(MARKS, OTHER)

FORMATTED = "conv_id bigint, piece int, formatted string, n_turns bigint, loss array<array<bigint>>"


def _pieces(batches: Iterator[pa.RecordBatch], template: Template) -> Iterator[tuple]:
    """(conv_id, piece, formatted, turns, spans) of ordered turns, checked as a whole."""

    def close() -> tuple:
        formatted = "".join(parts)
        found = list(template.parse(formatted))
        if [(t.role, t.text) for t in found] != turns:  # pragma: no cover
            raise Malformed(f"conversation {current} does not read back")
        return current, piece, formatted, len(turns), [
            [t.start, t.end] for t in found if t.role == LEARNED
        ]

    current, piece, size = None, 0, 0
    parts: list[str] = []
    turns: list[tuple[str, str]] = []
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("conv_id", "role", "text"))
        for conv_id, role, text in zip(*columns, strict=True):
            if parts and (conv_id != current or size >= PIECE):
                yield close()
                piece = piece + 1 if conv_id == current else 0
                parts, turns, size = [], [], 0
            current = conv_id
            parts.append(template.settled(role, text))
            turns.append((role, text))
            size += len(parts[-1])
    if parts:
        yield close()


def formatted(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """(conv_id, piece, formatted, n_turns, loss): every conversation as formatted text.

    ``conversations`` has conv_id, turn, role and text. ``loss`` lists start and end, in
    code points, of the texts to learn from, as they stand in ``formatted``. Rows of one
    conversation follow each other in the order of their pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in FORMATTED.split(", ")]
        kinds = [
            pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.list_(pa.list_(pa.int64()))
        ]
        rows, held = [], 0
        for row in _pieces(batches, template):
            rows.append(row)
            held += len(row[2])
            if held >= PIECE:
                columns = zip(*rows, strict=True)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)
                rows, held = [], 0
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    plain = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint"
)


class _Digest:
    """Counts and hashes of one conversation, fed piece by piece."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.turns, self.learned, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, spans: list[list[int]], template: Template) -> None:
        self.chars += len(formatted)
        for turn in template.parse(formatted):
            self.turns += 1
            self.all.update(f"{turn.role}\n{turn.text}\n".encode())
        for start, end in spans:
            text = template.unescape(formatted[start:end])
            self.learned += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.all.hexdigest(), self.learned,
            self.loss.hexdigest(), self.chars,
        )


def digests(pieces: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Counts and hashes of what ``formatted`` rows hold, read from their text and spans.

    The pieces of a conversation must follow each other, as ``formatted`` leaves them.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        open_one: _Digest | None = None
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "piece", "formatted", "loss"))
            for conv_id, piece, text, spans in zip(*columns, strict=True):
                if piece == 0:
                    if open_one is not None:
                        yield open_one.row()
                    open_one = _Digest(conv_id)
                open_one.add(text, spans, template)
        if open_one is not None:
            yield open_one.row()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in DIGESTS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        rows = []
        for row in found(batches):
            rows.append(row)
            if len(rows) >= 10_000:
                columns = zip(*rows, strict=True)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)
                rows = []
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return pieces.mapInArrow(run, DIGESTS)
