"""Chat formatting: turns become one text with a loss mask, by a declarative template.

A template gives each role its mark before and after a text, whether text and end mark count
for the loss, and which role may follow which.  A finite-state machine over the roles reads
a conversation's turns in order, notes the turns that it has no transition for, and emits
segments (text, loss).  Control strings inside texts get a backslash, so a text can neither
end its turn nor begin another, and reading back restores it.

On Spark, rows are sorted by conversation and turn and pass through the machine as a stream.
A formatted conversation is cut into pieces at turns once it passes ``PIECE_CHARS``, so no
task holds a long one whole; all usual ones are one piece.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm.common import Rows, in_turn_order
from lakeshore.sources.tables import read_table

#: Code points of a piece after which the next turn begins another one.
PIECE_CHARS = 1 << 20

#: Before the first turn, and after the last.
BEGIN = END = None


@dataclass(frozen=True)
class Part:
    """How one role's turns are written."""

    head: str
    tail: str = "</turn>\n"
    loss: bool = False
    tail_loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, and the machine's transitions: role before (``BEGIN`` at first) to the
    roles that may follow (``END`` is the end).  Roles without marks are written with
    ``other``, their name between it and ``name_end``."""

    parts: dict[str, Part]
    follows: dict[str | None, tuple[str | None, ...]]
    controls: tuple[str, ...]
    other: Part = Part("### Other <role>")
    name_end: str = "</role>"
    escaping: re.Pattern = field(init=False)
    unescaping: re.Pattern = field(init=False)
    turn: re.Pattern = field(init=False)

    def __post_init__(self) -> None:
        marks = "|".join(re.escape(c) for c in ("\\", *self.controls))
        put = object.__setattr__
        put(self, "escaping", re.compile(f"({marks})"))
        put(self, "unescaping", re.compile(rf"\\({marks})"))
        body = r"((?:[^\\]|\\.)*?)"
        known = "|".join(f"(?P<r{i}>{re.escape(p.head)})" for i, p in enumerate(self.parts.values()))
        tails = "|".join(sorted({re.escape(p.tail) for p in (*self.parts.values(), self.other)}, key=len, reverse=True))
        head = f"(?:{known}|{re.escape(self.other.head)}{body}{re.escape(self.name_end)})"
        put(self, "turn", re.compile(f"{head}{body}(?:{tails})", re.S))

    def escape(self, text: str) -> str:
        return self.escaping.sub(r"\\\1", text)

    def unescape(self, text: str) -> str:
        return self.unescaping.sub(r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, loss) of one turn, in order."""
        part = self.parts.get(role, self.other)
        head = part.head if role in self.parts else f"{part.head}{self.escape(role)}{self.name_end}"
        return [(head, False), (self.escape(text), part.loss), (part.tail, part.tail_loss)]

    def allowed(self, before: str | None, role: str | None) -> bool:
        """Whether the machine has a transition from a role, or the begin, to the next or the end."""
        return role in self.follows.get(before, ())


PLAIN = Template(
    parts={
        "system": Part("### System: "),
        "user": Part("### User: "),
        "assistant": Part("### Assistant: ", loss=True),
    },
    follows={BEGIN: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", END)},
    controls=("###", "</turn>", "</role>"),
)

FORMATTED = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("text", pa.string()),
                       ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                       ("illegal_turns", pa.int64())])
FORMATTED_DDL = "conv_id long, piece long, text string, spans array<struct<start:long,length:long>>, illegal_turns long"


def format_conversations(turns: DataFrame, template: Template = PLAIN, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Formatted pieces of ``turns`` (conv_id, turn, role, text), a conversation's in order
    and in one partition: ``text``, ``spans`` (code points under the loss mask, from the
    piece's start, in order; neighbours are one span, empty ones are left out) and
    ``illegal_turns`` (steps that the machine has no transition for; a piece counts its own,
    and the last one an end after a role that may not be the last).

    Rows go by turn (null first), then role and text; repeated rows are repeated turns.
    Null roles and texts are empty.  Null conv_id are one conversation.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = in_turn_order(rows, "conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(FORMATTED)
        begun, here, before, piece, texts, spans, length, illegal = False, None, BEGIN, 0, [], [], 0, 0

        def close() -> None:
            nonlocal texts, spans, length, illegal, piece
            out.add(here, piece, "".join(texts), spans, illegal, size=length)
            texts, spans, length, illegal, piece = [], [], 0, 0, piece + 1

        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if not begun or conv != here:
                    if begun:
                        illegal += not template.allowed(before, END)
                        close()
                    begun, here, before, piece = True, conv, BEGIN, 0
                elif length >= piece_chars:
                    close()
                    yield from out.batches()
                illegal += not template.allowed(before, role)
                before = role
                for segment, loss in template.segments(role, text):
                    if loss and segment:
                        if spans and spans[-1][0] + spans[-1][1] == length:
                            spans[-1] = (spans[-1][0], spans[-1][1] + len(segment))
                        else:
                            spans.append((length, len(segment)))
                    texts.append(segment)
                    length += len(segment)
            yield from out.batches()
        if begun:
            illegal += not template.allowed(before, END)
            close()
        yield from out.batches(last=True)

    return ordered.mapInArrow(run, FORMATTED_DDL)


def stored_order(formatted: DataFrame) -> DataFrame:
    """A stored table of pieces in the order that :func:`read_back` takes."""
    return in_turn_order(formatted, "conv_id", "piece")


def read_turns(text: str, template: Template = PLAIN) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a piece; a text that the template did not write is an error."""
    names, at = list(template.parts), 0
    while at < len(text):
        found = template.turn.match(text, at)
        if found is None:
            raise ValueError(f"no turn at {at}")
        *_, name, body = found.groups()
        role = template.unescape(name) if name is not None else next(names[i] for i in range(len(names)) if found[f"r{i}"] is not None)
        yield role, template.unescape(body)
        at = found.end()


def read_back(formatted: DataFrame, template: Template = PLAIN) -> DataFrame:
    """Counts and digests of each conversation, from its pieces alone (in the order of
    :func:`format_conversations` or :func:`stored_order`): ``n_turns``, ``turns_sha256``
    (role, newline, text, newline of every turn), ``loss_chars`` and ``loss_sha256`` (the
    text under the loss mask, unescaped), ``formatted_chars``, ``illegal_turns``."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("illegal_turns", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        begun, here, turns, loss, counts = False, None, None, None, [0, 0, 0, 0]

        def close() -> None:
            n, chars, size, illegal = counts
            out.add(here, n, turns.hexdigest(), chars, loss.hexdigest(), size, illegal)

        for batch in batches:
            for conv, piece, text, spans, illegal in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not begun or piece == 0:
                    if begun:
                        close()
                    begun, here, turns, loss, counts = True, conv, hashlib.sha256(), hashlib.sha256(), [0, 0, 0, 0]
                for role, body in read_turns(text, template):
                    turns.update(f"{role}\n{body}\n".encode())
                    counts[0] += 1
                for span in spans:
                    learned = template.unescape(text[span["start"]: span["start"] + span["length"]])
                    loss.update(learned.encode())
                    counts[1] += len(learned)
                counts[2] += len(text)
                counts[3] += illegal
            yield from out.batches()
        if begun:
            close()
        yield from out.batches(last=True)

    return formatted.select(*FORMATTED.names).mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, illegal_turns long")


#: The conversation that the query adds, whose texts hold the template's control strings.
ADDED_ID = -7
ADDED_TEXT = r"\### Assistant: </turn> ok"


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and the added one, formatted and read back."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(F.lit(ADDED_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ADDED_TEXT).alias("text"))
    return read_back(format_conversations(turns.unionByName(added)))
