"""Byte pair encoding and decoding as streaming transducers.

A vocabulary file of the ``tokenizers`` kind is read as plain JSON; what is done with it is
done here. Texts are cut into pieces by the file's pattern, and each piece is encoded by
itself. A short piece is encoded at once. A long one passes through a window: the merge list
says how far to the right of a place any merge can look (``lookahead``), so a token that ends
further than that from the end of the window is final and leaves, and memory stays the same
however long the piece is.
"""

from __future__ import annotations

import codecs
import json
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.text import id_and_text, in_batches, slices, spark_type

END = "</w>"

#: Entries that a worker keeps of words it has encoded, of their pieces and of token pairs it has tried.
KEPT_WORDS = 60_000
KEPT_PIECES = 200_000
KEPT_PAIRS = 100_000
#: Times as many words and pieces where a worker does nothing else; that is some 120 MB.
ALONE = 3
KEPT_LENGTH = 48


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


def split_token(token: str) -> tuple[str, bool]:
    """A token's characters and whether it ends a word."""
    return (token[: -len(END)], True) if token.endswith(END) and token != END else (token, False)


def lookahead(merges: list[tuple[str, str]]) -> int:
    """How many symbols after a place can decide whether a token ends there.

    Take a piece and any continuation of it, and apply the merges rank by rank to both. At
    first both agree on all boundaries up to the end of the piece. A merge (u, v) can only
    take one more token from what they agree on if u is the last token there and v begins
    just behind. For that to happen again, at a later rank, v must begin with the u of the
    time before. So the loss is at most the longest sum of |u| over chains of merges of
    rising rank in which each u starts the next v, read off its left edge. Going through the
    ranks from last to first gives it in one pass.
    """
    parts = {u + v: (u, v) for u, v in merges}
    reach: dict[str, int] = {}
    most = 0
    for u, v in reversed(merges):
        loss = len(split_token(u)[0]) + reach.get(u, 0)
        most = max(most, loss)
        edge = v
        while True:
            if reach.get(edge, 0) < loss:
                reach[edge] = loss
            if edge not in parts:
                break
            edge = parts[edge][0]
    return most


class Vocabulary:
    """Tokens, merges and pattern of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model = said["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {pair: n for n, pair in enumerate(self.merges)}
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.tokens = {n: t for t, n in {**self.ids, **self.special}.items()}
        pattern = said["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        self.parts = {a + b: (a, b) for a, b in self.merges}
        self.made = {a + b: n for n, (a, b) in enumerate(self.merges)}
        self.ranks = {self.ids[a] << 32 | self.ids[b]: n for n, (a, b) in enumerate(self.merges)}
        self._edges: dict[int, tuple[list, list]] = {}
        dead = self._unreachable()
        #: Tokens by their characters: each leads to the token that ends there, or none, and to what may follow.
        self.tree: dict[str, list] = {}
        for token, number in self.ids.items():
            if token and not split_token(token)[1] and token not in dead:
                node = [None, self.tree]
                for char in token:
                    if node[1] is None:
                        node[1] = {}
                    node = node[1].setdefault(char, [None, None])
                node[0] = number
        self.final = {split_token(t)[0]: n for t, n in self.ids.items() if split_token(t)[1] and t not in dead}
        self.longest = max(len(split_token(t)[0]) for t in self.ids)
        self.lookahead = lookahead(self.merges)
        self.alphabet = byte_alphabet()
        self.to_alphabet = {chr(b): c for b, c in self.alphabet.items()}

    def edges(self, token: int) -> tuple[list, list]:
        """The tokens at a token's left and right edge while it is put together, each with the rank that ends it."""
        if token not in self._edges:
            edges: tuple[list, list] = ([], [])
            for side, edge in enumerate(edges):
                at, ended = self.tokens[token], len(self.merges)
                while True:
                    edge.append((self.ids[at], ended))
                    if at not in self.parts:
                        break
                    ended = self.made[at]
                    at = self.parts[at][side]
            self._edges[token] = edges
        return self._edges[token]

    def apart(self, first: int, second: int, before: int | None = None) -> bool:
        """Whether no merge, or none of a rank under ``before``, joins two tokens across where they meet.

        A merge joins what is at the right edge of one and at the left edge of the other if
        both are there at its rank. Among equals the left one goes first.
        """
        for left, left_ends in self.edges(first)[1]:
            for right, right_ends in self.edges(second)[0]:
                rank = self.ranks.get(left << 32 | right)
                if rank is not None and rank < left_ends and rank <= right_ends and (before is None or rank < before):
                    return False
        return True

    def _unreachable(self) -> set[str]:
        """Tokens that the merges never give for their own text."""
        dead: set[str] = set()
        for rank, (a, b) in enumerate(self.merges):
            if a in dead or b in dead or not self.apart(self.ids[a], self.ids[b], rank):
                dead.add(a + b)
        return dead


def merged(symbols: list[str], rank: dict[tuple[str, str], int]) -> list[str]:
    """The tokens of a piece by the definition: the best-ranked pair, leftmost first, until none is left."""
    symbols = list(symbols)
    while len(symbols) > 1:
        pairs = [rank.get(p, len(rank)) for p in zip(symbols, symbols[1:])]
        best = min(pairs)
        if best == len(rank):
            break
        at = pairs.index(best)
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols


class Encoder:
    """Texts to token ids, packed as little-endian 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary, times: int = 1):
        self.vocabulary = v = vocabulary
        self.window = 4 * v.lookahead
        self._pairs: dict[int, bool] = {}
        self._words = _Kept(self.stretch, times * KEPT_WORDS)
        self._pieces = _Kept(lambda symbols: _packed(self.piece(symbols)), times * KEPT_PIECES)
        self._special = regex.compile("|".join(map(regex.escape, v.special)) or r"(?!)")
        self._byte = str.maketrans(v.to_alphabet)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text."""
        if "<" in text and self._special.search(text):
            return b"".join(self._with_special(text))
        return self._plain(text)

    def _with_special(self, text: str) -> Iterator[bytes]:
        at = 0
        for found in self._special.finditer(text):
            yield self._plain(text[at : found.start()])
            yield _packed([self.vocabulary.special[found.group()]])
            at = found.end()
        yield self._plain(text[at:])

    def _plain(self, text: str) -> bytes:
        """Between blanks pieces don't touch, so every stretch is encoded, and remembered, by itself."""
        words = self._words
        return b"".join([words[w] for w in text.replace("\n", " ").split(" ")])

    def stretch(self, text: str) -> bytes:
        """The ids of a stretch of text, whatever it holds."""
        pieces = self._pieces
        if text.isascii() and text.isprintable():
            return b"".join([pieces[p] for p in self.vocabulary.pattern.findall(text.lower())])
        found = self.vocabulary.pattern.findall(_lowered(unicodedata.normalize("NFC", text)))
        return b"".join([pieces[p.encode("utf-8").decode("latin-1").translate(self._byte)] for p in found])

    def piece(self, symbols: str) -> Iterable[int]:
        """The tokens of one piece, final ones leaving as the window moves on."""
        if len(symbols) <= self.window:
            return self._tokens(symbols, True)
        return self._streamed(symbols)

    def _streamed(self, symbols: str) -> Iterator[int]:
        at = 0
        while len(symbols) - at > self.window:
            end = at + self.window - self.vocabulary.lookahead
            for token in self._tokens(symbols[at : at + self.window], False):
                after = at + len(self.vocabulary.tokens[token])
                if after > end:
                    break
                yield token
                at = after
        yield from self._tokens(symbols[at:], True)

    def _tokens(self, symbols: str, ends: bool) -> list[int]:
        """Tokens by longest match; where two that meet would not stay apart, the shorter ones are tried.

        A row of tokens is what the merges give exactly if each two neighbours are what the
        merges make of their text. Each place is reached by one such row at most, so one that
        led nowhere isn't tried again.
        """
        final, longest, root = self.vocabulary.final, self.vocabulary.longest, self.vocabulary.tree
        pairs, n = self._pairs, len(symbols)
        last = n - 1 if ends else n
        tokens: list[int] = []
        stack: list[list] = []
        tried: set[int] = set()
        at = 0
        fits = None
        while at < n:
            if fits is None:
                if ends and n - at <= longest:
                    token = final.get(symbols[at:])
                    if token is not None and (not tokens or self._stay_apart(tokens[-1] << 32 | token)):
                        tokens.append(token)
                        break
                fits = []
                following, place = root, at
                for char in symbols[at : min(last, at + longest)]:
                    node = following.get(char)
                    if node is None:
                        break
                    token, following = node
                    place += 1
                    if token is not None:
                        fits.append((place, token))
                    if following is None:
                        break
            found = None
            while fits:
                stop, token = fits.pop()
                if stop in tried:
                    continue
                if not tokens:
                    found = token
                    break
                pair = tokens[-1] << 32 | token
                apart = pairs.get(pair)
                if apart is None:
                    apart = self._stay_apart(pair)
                if apart:
                    found = token
                    break
            if found is None:
                at, fits = stack.pop()
                tokens.pop()
                continue
            stack.append((at, fits))
            tokens.append(found)
            tried.add(stop)
            at, fits = stop, None
        return tokens

    def _stay_apart(self, pair: int) -> bool:
        apart = self._pairs.get(pair)
        if apart is None:
            if len(self._pairs) >= KEPT_PAIRS:
                self._pairs.clear()
            apart = self._pairs[pair] = self.vocabulary.apart(pair >> 32, pair & 0xFFFFFFFF)
        return apart


class _Kept(dict):
    """What was worked out for the texts that came last, ``most`` of them; long ones are not kept.

    A full table takes the place of the older one. What is missed is looked for there, so
    words that come again and again stay.
    """

    def __init__(self, work: Callable[[str], bytes], most: int):
        super().__init__()
        self._work, self._half = work, most // 2
        self._older: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        found = self._older.get(text)
        if found is None:
            found = self._work(text)
            if len(text) > KEPT_LENGTH:
                return found
        if len(self) >= self._half:
            self._older = dict(self)
            self.clear()
        self[text] = found
        return found


def _lowered(text: str) -> str:
    """Lower case of each character by itself, without regard to its neighbours."""
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


def _packed(ids: Iterable[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def unpacked(ids: bytes) -> array:
    out = array("I")
    out.frombytes(ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out


class Decoder:
    """Token ids to text, a chunk at a time.

    ``join=" "`` gives the tokens as the vocabulary spells them, one blank between two; it is
    what a file without a decoder asks for. ``join=None`` gives plain text: the state is the
    unfinished UTF-8 character and whether a word has just ended; bytes that are no
    character become U+FFFD. Unknown ids add nothing.
    """

    def __init__(self, vocabulary: Vocabulary, join: str | None = " "):
        self._tokens, self._special, self._join = vocabulary.tokens, set(vocabulary.special.values()), join
        self._bytes = {c: b for b, c in vocabulary.alphabet.items()}
        self._started = self._ended = False
        self._text = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        known = [self._tokens[i] for i in ids if i in self._tokens] if self._join is None else \
            list(filter(None, map(self._tokens.get, ids)))
        if self._join is None:
            return "".join(map(self._plain, known))
        if not known:
            return ""
        lead = self._join if self._started else ""
        self._started = True
        return lead + self._join.join(known)

    def _plain(self, token: str) -> str:
        lead = " " if self._ended else ""
        chars, self._ended = (token, True) if token in self._special else split_token(token)
        data = token.encode() if token in self._special else bytes(self._bytes[c] for c in chars)
        return lead + self._text.decode(data, final=self._ended)

    def finish(self) -> str:
        """What is left, and a fresh start."""
        left = self._text.decode(b"", final=True)
        self._text.reset()
        self._started = self._ended = False
        return left


#: Ids decoded at a time, and bytes of rows that are held as Python objects at a time.
CHUNK = 1 << 16
IN_BYTES = 1 << 20

_LOADED: dict[str, Vocabulary] = {}
_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _loaded(path: str, times: int = 1) -> tuple[Vocabulary, Encoder]:
    """The vocabulary of a file and an encoder that keeps so many times the usual, once per worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    if (path, times) not in _ENCODERS:
        _ENCODERS[path, times] = Encoder(_LOADED[path], times)
    return _LOADED[path], _ENCODERS[path, times]


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The token ids of every text: ``id_col`` and ``ids``, packed as little-endian 32-bit integers.

    ``path`` names a vocabulary file that every executor can read. A null text counts as an
    empty one and has no ids. Rows that repeat are encoded each. Rows stay in their partition.
    """
    rows = id_and_text(df, id_col, text_col)

    def each(part: pa.RecordBatch) -> Iterator[tuple]:
        encoder = _loaded(path)[1]
        return ((i, encoder.encode(t)) for i, t in zip(part["id"].to_pylist(), part["text"].to_pylist()))

    return _mapped(rows, each, {"ids": pa.binary()}).withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids",
           join: str | None = " ") -> DataFrame:
    """``df``'s id and ids with ``decoded``, the text of the ids; see ``Decoder`` for ``join``. Null ids are none."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))

    def each(part: pa.RecordBatch) -> Iterator[tuple]:
        decoder = Decoder(_loaded(path)[0], join)
        return ((i, x, decoded(decoder, x)) for i, x in zip(part["id"].to_pylist(), part["ids"].to_pylist()))

    return _mapped(rows, each, {"ids": pa.binary(), "decoded": pa.string()}).withColumnsRenamed(
        {"id": id_col, "ids": ids_col})


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
               join: str | None = " ") -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``id_col``, ``ids`` and ``decoded``."""
    rows = id_and_text(df, id_col, text_col)

    def each(part: pa.RecordBatch) -> Iterator[tuple]:
        vocabulary, encoder = _loaded(path, ALONE)
        decoder = Decoder(vocabulary, join)
        for i, text in zip(part["id"].to_pylist(), part["text"].to_pylist()):
            ids = encoder.encode(text)
            yield i, ids, decoded(decoder, ids)

    return _mapped(rows, each, {"ids": pa.binary(), "decoded": pa.string()}).withColumnRenamed("id", id_col)


def decoded(decoder: Decoder, ids: bytes) -> str:
    """The text of packed ids, decoded a chunk at a time."""
    size = 4 * CHUNK
    parts = [decoder.feed(unpacked(ids[at : at + size])) for at in range(0, len(ids), size)]
    return "".join([*parts, decoder.finish()])


def _mapped(rows: DataFrame, each: Callable[[pa.RecordBatch], Iterator[tuple]],
            fields: dict[str, pa.DataType]) -> DataFrame:
    """Rows of id and ``fields`` from each piece of a batch, handed back a few megabytes at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([batch.schema.field("id"), *(pa.field(n, k) for n, k in fields.items())])
            for part in slices(batch, IN_BYTES):
                yield from in_batches(each(part), schema, lambda row: sum(map(len, row[1:])))

    kinds = ", ".join(f"{name} {spark_type(kind)}" for name, kind in fields.items())
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {kinds}")
