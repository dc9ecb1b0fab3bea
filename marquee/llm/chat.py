"""Conversations as training text, from typed content parts.

A turn's content is a list of parts: text, images, audio and documents. A visitor walks over
the parts and leaves text and numbered placeholders, and notes for every attachment what it
refers to, where its placeholder stands and how many tokens it will take when a model's own
embeddings stand in for it.

A turn is written as ``### role: text</turn>`` and a line break. Control strings in a role or
text get a backslash, and so do backslashes, so what was written can be read back exactly.
A conversation passes through its task turn by turn: nothing but the segment being written is
held, however long it is.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.text import in_batches

HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
KINDS = ("image", "audio", "document")

#: What must not stand in a text as it is, and in a role the colon too, which ends it.
_CONTROL = re.compile(r"\\|###|</turn>|<\|")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|<\||:")
#: What a reader stops at: an escaped control string, the end of a turn, of a role, or a placeholder.
_STOP = re.compile(r"\\(\\|###|</turn>|<\||:)|(</turn>\n)|(: )|<\|(image|audio|document)_(\d+)\|>")

#: A conversation of more characters goes on in a further row, cut between two turns.
SEGMENT_CHARS = 4 << 20

PARTS = "array<struct<type:string,text:string,ref:string,width:bigint,height:bigint,seconds:double,pages:bigint>>"

_ATTACHMENT = pa.struct([("ordinal", pa.int64()), ("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()),
                         ("tokens", pa.int64())])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_SPARK_SEGMENT = (
    "segment int, first_char bigint, formatted string, loss array<struct<start:bigint,end:bigint>>, "
    "attachments array<struct<ordinal:bigint,kind:string,ref:string,at:bigint,tokens:bigint>>")


@dataclass(frozen=True)
class Rates:
    """Tokens of an attachment: one per square of ``patch`` pixels, per part of a second, ``page`` per page."""

    patch: int = 28
    per_second: float = 25.0
    page: int = 512


@dataclass
class Flattener:
    """Visits the parts of one turn and gathers its escaped text and its attachments.

    Texts that follow each other are one text before they are escaped, so that no control
    string can be put together from two of them. ``first`` is the number of the first
    attachment. Every attachment takes one token at least, also one whose size is not given.
    """

    rates: Rates
    first: int = 0
    chars: int = 0
    pieces: list[str] = field(default_factory=list)
    attachments: list[tuple[int, str, str | None, int, int]] = field(default_factory=list)
    _open: list[str] = field(default_factory=list)

    def visit(self, part: dict | None) -> None:
        """A part of no known type is a document if it refers to something, else a text."""
        if part is None:
            return
        kind = part.get("type")
        if kind not in ("text", *KINDS):
            kind = "document" if part.get("ref") is not None else "text"
        getattr(self, f"visit_{kind}")(part)

    def visit_text(self, part: dict) -> None:
        self._open.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        sides = [math.ceil((part.get(side) or 0) / self.rates.patch) for side in ("width", "height")]
        self._hold("image", part, sides[0] * sides[1])

    def visit_audio(self, part: dict) -> None:
        seconds = part.get("seconds") or 0.0
        self._hold("audio", part, math.ceil(seconds * self.rates.per_second) if math.isfinite(seconds) else 0)

    def visit_document(self, part: dict) -> None:
        self._hold("document", part, (part.get("pages") or 0) * self.rates.page)

    def _hold(self, kind: str, part: dict, tokens: int) -> None:
        self.close()
        ordinal = self.first + len(self.attachments)
        self.attachments.append((ordinal, kind, part.get("ref"), self.chars, max(1, tokens)))
        self._add(placeholder(kind, ordinal))

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.chars += len(piece)

    def close(self) -> str:
        """The text so far."""
        if self._open:
            self._add(escape("".join(self._open)))
            self._open = []
        return "".join(self.pieces)


def placeholder(kind: str, ordinal: int) -> str:
    return f"<|{kind}_{ordinal}|>"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def escape_role(role: str) -> str:
    return _ROLE_CONTROL.sub(lambda m: "\\" + m[0], role)


def unescape(written: str) -> str:
    """What ``escape`` was given; placeholders stay as they are."""
    return _STOP.sub(lambda m: m[1] or m[0], written)


def written_turns(formatted: str) -> Iterator[tuple[str, int, int]]:
    """Role, and where the written text starts and ends, of every turn of a formatted text."""
    at, role, start = 0, None, len(HEAD)
    if not formatted:
        return
    for m in _STOP.finditer(formatted):
        if m[3] and role is None:
            if not formatted.startswith(HEAD, at):
                raise ValueError(f"no turn starts at character {at}")
            role, start = unescape(formatted[at + len(HEAD) : m.start()]), m.end()
        elif m[2]:
            if role is None:
                raise ValueError(f"a turn without a role ends at character {m.end()}")
            yield role, start, m.start()
            at, role = m.end(), None
    if role is not None or at != len(formatted):
        raise ValueError(f"the turn at character {at} does not end")


def read_parts(written: str, attachments: Iterable[dict]) -> list[dict]:
    """The parts of one turn as they were given, from its written text and the conversation's attachments."""
    by_ordinal = {a["ordinal"]: a for a in attachments}
    parts, at = [], 0
    for m in _STOP.finditer(written):
        if not m[4]:
            continue
        if m.start() > at:
            parts.append({"type": "text", "text": unescape(written[at : m.start()])})
        parts.append({"type": m[4], "ref": by_ordinal[int(m[5])]["ref"]})
        at = m.end()
    if at < len(written):
        parts.append({"type": "text", "text": unescape(written[at:])})
    return parts


def format_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         content_col: str = "text", loss_roles: tuple[str, ...] = ("assistant",),
                         rates: Rates = Rates(), segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """Every conversation as one formatted text, or as several rows if it is very long.

    Returns ``conv_col``, ``segment`` (from 0), ``first_char`` (of the segment in the
    conversation), ``formatted``, ``loss`` (spans of the segment that a model learns from: the
    texts of ``loss_roles``) and ``attachments``. Places are code points; spans and ``at``
    count within the segment. Attachments are numbered through the conversation.

    ``content_col`` is a text, or a list of parts (``PARTS``; further or fewer fields do no
    harm). Turns go by ``turn_col``, null first, then by role and content, so rows that
    repeat are turns of their own and ties have one order. A null role or content is empty;
    rows without a conversation are one conversation, of null. No rows give no rows. Further
    columns are left behind. The rows of a conversation lie in one partition, in order.
    """
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.col(content_col).alias("content"))
    kind = rows.schema["conv"].dataType.simpleString()
    sorted_turns = rows.repartition("conv").sortWithinPartitions(
        "conv", F.col("turn").asc_nulls_first(), "role", "content").select("conv", "role", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema([("conv", batch.schema.field("conv").type), *_SEGMENT_FIELDS])
                written = _Writer(loss_roles, rates, segment_chars)
            # Row by row: a batch may hold very long texts.
            rows = zip(*(batch.column(c) for c in ("conv", "role", "content")))
            yield from in_batches((s for r in rows for s in written.turn(*(x.as_py() for x in r))), schema, _weight)
        if schema is not None:
            yield from in_batches(iter(written.end()), schema, _weight)

    return sorted_turns.mapInArrow(run, f"conv {kind}, {_SPARK_SEGMENT}").withColumnRenamed("conv", conv_col)


_SEGMENT_FIELDS = [("segment", pa.int32()), ("first_char", pa.int64()), ("formatted", pa.string()),
                   ("loss", pa.list_(_SPAN)), ("attachments", pa.list_(_ATTACHMENT))]


def _weight(row: tuple) -> int:
    return 200 + len(row[3])


class _Writer:
    """Turns in order, segments out. Holds the segment being written."""

    def __init__(self, loss_roles: tuple[str, ...], rates: Rates, segment_chars: int):
        self.loss_roles, self.rates, self.most = loss_roles, rates, segment_chars
        self.conv: object = None
        self.open = False
        self.segment = self.first_char = self.ordinal = 0
        self._clear()

    def _clear(self) -> None:
        self.pieces: list[str] = []
        self.chars = 0
        self.loss: list[tuple[int, int]] = []
        self.attachments: list[tuple] = []

    def turn(self, conv: object, role: str, content: str | list[dict] | None) -> Iterator[tuple]:
        if self.open and conv != self.conv:
            yield from self.end()
        elif self.chars >= self.most:
            yield self._row()
        self.conv, self.open = conv, True
        flat = Flattener(self.rates, self.ordinal)
        for part in [{"type": "text", "text": content}] if isinstance(content, str) else content or []:
            flat.visit(part)
        text = flat.close()
        head = f"{HEAD}{escape_role(role)}{MIDDLE}"
        start = self.chars + len(head)
        if role in self.loss_roles:
            self.loss.append((start, start + len(text)))
        self.attachments += [(n, kind, ref, start + at, tokens) for n, kind, ref, at, tokens in flat.attachments]
        self.ordinal += len(flat.attachments)
        self.pieces += [head, text, END]
        self.chars = start + len(text) + len(END)

    def _row(self) -> tuple:
        row = (self.conv, self.segment, self.first_char, "".join(self.pieces),
               [dict(zip(("start", "end"), s)) for s in self.loss],
               [dict(zip(("ordinal", "kind", "ref", "at", "tokens"), a)) for a in self.attachments])
        self.segment += 1
        self.first_char += self.chars
        self._clear()
        return row

    def end(self) -> Iterator[tuple]:
        if self.open:
            yield self._row()
        self.open, self.segment, self.first_char, self.ordinal = False, 0, 0, 0


def read_back(segments: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What is in formatted conversations, read from their rows as ``format_conversations`` returns them.

    ``conv_col``, ``n_turns``, ``turns_sha256`` (of role, line break, text and line break of
    every turn), ``loss_chars`` and ``loss_sha256`` (of all text under the loss mask),
    ``formatted_chars``, ``n_attachments`` and ``expanded_tokens``, what these will take.
    Digests are made as the turns go by.
    """
    kind = segments.schema[conv_col].dataType.simpleString()
    schema = (f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
              "formatted_chars bigint, n_attachments bigint, expanded_tokens bigint")
    rows = segments.select(F.col(conv_col).alias("conv"), "formatted", "loss", F.transform(
        "attachments", lambda a: a["tokens"]).alias("tokens"))
    return rows.mapInArrow(_reader(), schema).withColumnRenamed("conv", conv_col)


def _reader() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    fields = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
              ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_attachments", pa.int64()),
              ("expanded_tokens", pa.int64())]

    def results(rows: Iterator[tuple], seen: list) -> Iterator[tuple]:
        for conv, formatted, loss, tokens in rows:
            if seen and seen[0] != conv:
                yield seen[0], *seen[1].row()
                seen.clear()
            if not seen:
                seen += [conv, _Digest()]
            seen[1].add(formatted, loss, tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, seen = None, []
        for batch in batches:
            schema = schema or pa.schema([("conv", batch.schema.field("conv").type), *fields])
            rows = (tuple(x.as_py() for x in r) for r in zip(*batch.columns))
            yield from in_batches(results(rows, seen), schema, lambda row: 400)
        if seen:
            yield from in_batches(iter([(seen[0], *seen[1].row())]), schema, lambda row: 400)

    return run


class _Digest:
    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.attachments = self.tokens = 0

    def add(self, formatted: str, loss: list[dict], tokens: list[int]) -> None:
        for role, start, end in written_turns(formatted):
            self.turns.update(f"{role}\n{unescape(formatted[start:end])}\n".encode("utf-8", "surrogatepass"))
            self.n_turns += 1
        for span in loss:
            text = unescape(formatted[span["start"] : span["end"]])
            self.loss.update(text.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(text)
        self.chars += len(formatted)
        self.attachments += len(tokens)
        self.tokens += sum(tokens)

    def row(self) -> tuple:
        return (self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.attachments, self.tokens)
