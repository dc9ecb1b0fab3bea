"""Quality rules on how much of a text repeats itself.

Words of a batch of texts become 64-bit numbers, and windows of several lengths rolling
hashes of those, all in numpy. A window whose hash comes twice in one text is a duplicated
n-gram; the characters that such n-grams and repeated lines cover, as a share of all, are
held against a limit for each length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.text import SPACES, map_texts, slices, spark_type

SYMBOLS = "#*$%&|<>"
BASE_WINDOW = 8

#: Largest share of a text's characters in duplicated n-grams, by n. The first of equal n-grams counts too, so
#: these are twice what is usual for the repeats alone.
NGRAM_LIMITS = {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20}
#: Most symbols per word; tables and markup have far more, prose far fewer.
SYMBOL_LIMIT = 0.2
#: Largest share of a text's lines, and of its characters, in lines equal to an earlier one.
LINE_LIMIT = 0.30
LINE_CHARS_LIMIT = 0.20
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

FIELDS = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(), "n_lines": pa.int64(), "dup_line_chars": pa.int64(),
    "dup_ngram_chars": pa.list_(pa.int64()),
}

_IS_SPACE = np.isin(np.arange(256), np.frombuffer(SPACES.encode(), np.uint8))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a number spread over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated(values: np.ndarray) -> np.ndarray:
    """Which values come at least twice."""
    order = np.sort(values)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(twice, values), len(twice) - 1)
    return twice[at] == values


#: Bytes of text that are counted at a time. A byte may take some 110 bytes of memory, where words have one letter.
SLICE = 1 << 19


class _Rolling:
    """Hashes of all windows of a row of numbers; a length is put together from shorter ones."""

    def __init__(self, values: np.ndarray):
        self._of = {1: values}

    def of(self, n: int) -> np.ndarray:
        if n not in self._of:
            a, b = n // 2, n - n // 2
            left, right = self.of(a), self.of(b)
            count = max(0, len(self._of[1]) - n + 1)
            self._of[n] = left[:count] * _BASE ** np.uint64(b) + right[a : a + count]
        return self._of[n]


def measure(texts: list[str], lengths: tuple[int, ...] = tuple(NGRAM_LIMITS)) -> list[list]:
    """Counts for each text, one list per field of ``FIELDS``."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    joined = b"\n".join(encoded) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    bounds = np.cumsum([len(e) + 1 for e in encoded])
    space = _IS_SPACE[data]
    edges = np.diff(np.concatenate(([True], space)).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = points[ends] - points[starts]
    words = joined.split()
    doc = np.searchsorted(bounds, starts, side="right")
    count = np.bincount(doc, minlength=len(texts))
    last = np.cumsum(count)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    rolling = _Rolling(mixed(hashed + mixed(doc.astype(np.uint64) + np.uint64(1))))

    def covered(n: int, among: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The words in duplicated windows of n, and where those windows start."""
        hashes = rolling.of(n)
        at = np.arange(len(hashes)) if among is None else among[among < len(hashes)]
        at = at[at + n <= last[doc[at]]] if len(at) else at
        at = at[repeated(hashes[at])]
        steps = np.zeros(len(words) + 1, np.int64)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + n, -1)
        return np.cumsum(steps[:-1]) > 0, at

    def per_doc(values: np.ndarray) -> list[int]:
        return np.bincount(doc, weights=values, minlength=len(texts)).astype(np.int64).tolist()

    # A longer window that repeats holds a shorter one that does, so only those starts are looked at again.
    among, shares, repeat = None, {}, None
    for n in sorted({*lengths, BASE_WINDOW}):
        inside, among = covered(n, among)
        shares[n] = per_doc(chars * inside)
        if n == BASE_WINDOW:
            repeat = per_doc(inside)
    lines = [_lines(t) for t in texts]
    symbols = [sum(map(t.count, SYMBOLS)) for t in texts]
    return [
        count.tolist(), per_doc(chars), symbols, [x[1] for x in lines], repeat, [x[0] for x in lines],
        [x[2] for x in lines], [list(x) for x in zip(*(shares[n] for n in lengths))] if lengths else [[] for _ in texts],
    ]


def _lines(text: str) -> tuple[int, int, int]:
    """Lines with a word; of those the ones equal to an earlier one, and the characters of their words."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    if len(set(lines)) == len(lines):
        return len(lines), 0, 0
    seen: set[str] = set()
    again = [line for line in lines if line in seen or seen.add(line)]
    return len(lines), len(again), sum(len(line) - sum(map(line.count, SPACES)) for line in again)


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            limits: dict[int, float] = NGRAM_LIMITS) -> DataFrame:
    """The counts of ``FIELDS`` for each row, ``base_failed``, and ``kept``, the verdict.

    Kept is a text that doesn't fail the base rule, whose repeated lines and n-grams stay
    within their limits and that has few symbols. A null or empty text has no words and
    fails. Each row is judged by itself, repeated ones too; nothing is shuffled.
    """
    lengths = tuple(sorted(limits))
    rows = map_texts(df, id_col, text_col, lambda texts: measure(texts, lengths), FIELDS, slice_chars=SLICE)
    failed = base_failed(*map(F.col, ("n_words", "n_repeat_words")))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & ~over_limits(limits))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def over_limits(limits: dict[int, float]) -> Column:
    over = (F.col("n_dup_lines") > LINE_LIMIT * F.col("n_lines")) \
        | (F.col("dup_line_chars") > LINE_CHARS_LIMIT * F.col("word_chars")) \
        | (F.col("n_symbols") > SYMBOL_LIMIT * F.col("n_words"))
    for at, n in enumerate(sorted(limits)):
        over = over | (F.col("dup_ngram_chars")[at] > limits[n] * F.col("word_chars"))
    return over


def kept_documents(df: DataFrame, text_col: str = "text", limits: dict[int, float] = NGRAM_LIMITS) -> DataFrame:
    """``df``'s rows that the rules keep, whole and unchanged; see ``quality`` for null and empty texts.

    A text goes to Python once, within its row.
    """
    lengths = tuple(sorted(limits))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    keyed = df.select(row)
    at = df.columns.index(text_col)
    fields = ", ".join(f"{name} {spark_type(kind)}" for name, kind in FIELDS.items())

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE):
                made = measure([t or "" for t in part.column("row").field(at).to_pylist()], lengths)
                columns = [part.column("row"), *(pa.array(c, type=k) for c, k in zip(made, FIELDS.values()))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", *FIELDS])

    rows = keyed.mapInArrow(measured, f"row {keyed.schema['row'].dataType.simpleString()}, {fields}")
    kept = rows.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")) & ~over_limits(limits))
    return kept.select("row.*")
