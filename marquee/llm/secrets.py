"""Secrets in text: fixed forms, and strings that a tokenizer finds no words in.

A vocabulary learned from text spends few tokens on what looks like text. A string that
costs about a token for every two characters is random, as keys and passwords are. Digests
of well-known lengths, UUIDs, and names put together from words are left out before.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.text import map_texts, slices

KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGNED = 12
MIN_ACCESS = 18

#: Runs that may be a random string: long, with a digit and a letter.
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}")
#: Digests by their length in hexadecimal digits (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512) and UUIDs.
_DIGEST = re.compile(r"(?i)(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})\Z")
_UUID = re.compile(r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}\Z")
#: Digests and UUIDs within a run.
_KNOWN = re.compile(r"(?i)(?<![0-9a-z])(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|"
                    r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})(?![0-9a-z])")
#: What names such as read_utf8_line2 or parseHttpHeader consist of.
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+|[_/+-]+|=+")
_BETWEEN = re.compile(r"[^_/+-]+")
MIN_RUN = 20

#: Characters per token under which a run counts as random.
MAX_CHARS_PER_TOKEN = 2.0

FIELDS = {"kinds": pa.list_(pa.int32()), "starts": pa.list_(pa.int64()), "ends": pa.list_(pa.int64())}

_ENCODINGS: dict[tuple[str, str], tiktoken.Encoding] = {}


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The vocabulary of a file of ranks, once per worker."""
    if (path, pattern) not in _ENCODINGS:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        _ENCODINGS[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                                      special_tokens={})
    return _ENCODINGS[path, pattern]


def fixed_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind and end of what has a fixed form."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def is_name(run: str, ranks: tiktoken.Encoding) -> bool:
    """Whether a run is put together from words, each with a short number at most.

    A word has two letters or more and costs one token, and one more for every six letters.
    """
    first = True
    for part in _PART.findall(run):
        if part[0] in "_/+-":
            continue
        if part.isdigit():
            if first or len(part) > 4:
                return False
        elif len(part) < 2 or len(ranks.encode_ordinary(part)) > 1 + len(part) // 6:
            return False
        first = False
    return not first


def random_stretch(run: str, ranks: tiktoken.Encoding, most: float) -> tuple[int, int] | None:
    """The stretch of parts between / _ + and - that costs most tokens over its length's worth, if it is random."""
    best, top, at, score = None, 0.0, 0, 0.0
    for m in _BETWEEN.finditer(run):
        part = m.group()
        if score <= 0:
            at, score = m.start(), 0.0
        word = part.isdigit() and len(part) <= 4 or is_name(part, ranks)
        score += -len(part) if word else most * len(ranks.encode_ordinary(part)) - len(part)
        if score > top:
            best, top = (at, m.end()), score
    if best is None or best[1] - best[0] < MIN_RUN:
        return None
    part = run[best[0]:best[1]]
    if not re.search("[0-9]", part) or not re.search("[A-Za-z]", part) or len(part) >= most * len(ranks.encode_ordinary(part)):
        return None
    return best


def random_spans(text: str, ranks: tiktoken.Encoding, most: float = MAX_CHARS_PER_TOKEN) -> list[tuple[int, int, int]]:
    """Start, kind and end of the runs that cost more tokens than words would.

    A run that does so as a whole is one span. Of others, such as the path of a URL with a
    key at its end, each stretch between digests and UUIDs that does so is one.
    """
    found = []
    for m in _RUN.finditer(text):
        run = m.group()
        if _DIGEST.match(run) or _UUID.match(run):
            continue
        if len(run) < most * len(ranks.encode_ordinary(run)):
            if not is_name(run, ranks):
                found.append((m.start(), 3, m.end()))
            continue
        todo, at = [], 0
        for known in _KNOWN.finditer(run):
            todo.append((at, known.start()))
            at = known.end()
        todo.append((at, len(run)))
        while todo:
            start, end = todo.pop()
            if end - start >= MIN_RUN and (part := random_stretch(run[start:end], ranks, most)):
                found.append((m.start() + start + part[0], 3, m.start() + start + part[1]))
                todo += [(start, start + part[0]), (start + part[1], end)]
    return sorted(found)


def spans(text: str, ranks: tiktoken.Encoding) -> list[tuple[int, int, int]]:
    """All spans of a text by start, then kind. Those of one kind don't overlap; of different kinds they may."""
    found = fixed_spans(text)
    return sorted({*found, *random_spans(text, ranks)})


def scan(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The spans of every row as three arrays of one length: kind (a place in ``KINDS``), start and end.

    Places count code points and ends are exclusive. ``path`` names a file of token ranks
    that every executor can read. A null or empty text has no span. Rows are scanned each.
    """
    def each(texts: list[str]) -> list[list]:
        ranks = encoding(path, pattern)
        found = [spans(t, ranks) for t in texts]
        return [[[s[k] for s in f] for f in found] for k in (1, 0, 2)]

    return map_texts(df, id_col, text_col, each, FIELDS)


def masked(text: str, ranks: tiktoken.Encoding, mask: str) -> str:
    """A text with the mask in place of every span; spans that touch or overlap become one."""
    parts, at = [], 0
    last = -1
    for start, _, end in spans(text, ranks):
        if start > last:
            parts += [text[at:start], mask]
        last = max(last, end)
        at = last
    return "".join([*parts, text[at:]]) if parts else text


def mask_secrets(df: DataFrame, path: str, pattern: str, text_col: str = "text",
                 mask: str = "<secret>") -> DataFrame:
    """``df`` with the secrets of ``text_col`` masked. Rows and other columns stay; a null text stays null.

    A text goes to Python once, apart from the rest of its row, and comes back masked.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = encoding(path, pattern)
        for batch in batches:
            for part in slices(batch, 1 << 19):
                at = part.schema.get_field_index("text")
                texts = [t and masked(t, ranks, mask) for t in part.column(at).to_pylist()]
                yield part.set_column(at, "text", pa.array(texts, pa.string()))

    others = [F.col(f"`{c}`") for c in df.columns if c != text_col]
    row = F.struct(*others or [F.lit(0)]).alias("row")
    keyed = df.select(row, F.col(f"`{text_col}`").alias("text"))
    done = keyed.mapInArrow(run, f"row {keyed.schema['row'].dataType.simpleString()}, text string")
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in df.columns])


def label(kinds: str, starts: str, ends: str, among: tuple[int, ...] = tuple(range(len(KINDS)))) -> Column:
    """Spans as text: kind:start:end of those of the kinds asked for, in order, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    zipped = F.filter(F.arrays_zip(F.col(kinds).alias("kind"), F.col(starts).alias("start"), F.col(ends).alias("end")),
                      lambda s: s["kind"].isin(*among))
    return F.array_join(F.transform(zipped, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
