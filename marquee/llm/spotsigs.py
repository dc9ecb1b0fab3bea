"""SpotSigs: fingerprints from what follows common words.

Where a text has one of a list of common words, the next content words after it make a
chain, and the chain with its anchor a signature. Prose is full of such spots and menus and
tables are not. The set of a text's signatures is its fingerprint; two are as alike as their
Jaccard likeness. Sets whose sizes are too far apart can't be alike, so sizes are looked at
before members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.quality import mixed
from marquee.llm.text import SPACES, in_batches, map_texts, slices
from marquee.session import shared_dir

# Common words of English, German, French and Spanish.
COMMON = frozenset(
    "a an and are as at be but by can do for from had has have he her his i if in into is it its not of on or she so that the "
    "their then there they this to was we were which who will with would you "
    "als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im ist mit nach "
    "nicht noch nur oder sich sie sind um und von vor war werden wie wir zu zum zur über "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour que "
    "qui sa se ses son sont sur un une vous à "
    "al como con del el ella en entre era es esta este la las lo los más me muy no o para pero por porque que se sin sobre "
    "su sus también una y ya".split())

#: Content words in a chain.
CHAIN = 3
#: Words whose reading a worker remembers.
KEPT_WORDS = 600_000
#: Parts that rows are dealt to, for each shuffle partition.
PARTS = 8

_EDGES = SPACES + "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»¿¡“”„…–—"
_SKIP, _START = np.uint64(0), np.uint64(0x5EED)
_COMMON_BIT = np.uint64(1 << 63)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """A word as it stands to a number; common words have the top bit, what has no letter or digit is 0."""

    def __missing__(self, word: bytes) -> int:
        plain = word.decode("utf-8", "replace").lower().strip(_EDGES)
        number = (xxhash.xxh3_64_intdigest(plain) & 0x7FFFFFFFFFFFFFFF | 1) if plain else 0
        number |= 1 << 63 if plain in COMMON else 0
        if len(self) > KEPT_WORDS:
            self.clear()
        self[word] = number
        return number


_WORDS = _Words()


def signatures(texts: list[str], chain: int = CHAIN) -> list[np.ndarray]:
    """The sorted distinct signatures of each text, 32 bits each.

    The start of a text counts as an anchor, so that one without common words has a
    signature too; words without any content make one all together. Only a text without
    words has none. Chains that the end of the text cuts short count as they are.
    """
    split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    sizes = np.array([len(w) + 1 for w in split], np.int64)
    flat: list[int] = []
    for words in split:
        flat.append(0)
        flat += [_WORDS[w] for w in words]
    numbers = np.array(flat, np.uint64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    first = np.cumsum(sizes) - sizes
    anchor = (numbers & _COMMON_BIT) != 0
    content = (numbers != _SKIP) & ~anchor
    anchor[first] = True
    numbers[first] = _START
    at = np.flatnonzero(content)
    ends = np.searchsorted(at, np.cumsum(sizes))
    spots = np.flatnonzero(anchor)
    following = np.searchsorted(at, spots)
    hashed = mixed(numbers[spots])
    left = ends[doc[spots]] - following
    for step in range(chain):
        there = left > step
        word = np.zeros(len(spots), np.uint64)
        word[there] = numbers[at[following[there] + step]]
        hashed = mixed(hashed * _STEP + word)
    held = left > 0
    spots, hashed = spots[held], (hashed[held] >> np.uint64(32)).astype(np.uint32)
    cuts = np.searchsorted(doc[spots], np.arange(len(texts) + 1))
    out = []
    for n, words in enumerate(split):
        own = np.unique(hashed[cuts[n] : cuts[n + 1]])
        if not len(own) and words:
            own = np.array([xxhash.xxh32_intdigest(b" ".join(words))], np.uint32)
        out.append(own)
    return out


def as_text(found: np.ndarray) -> str:
    """Signatures as one string, eight hexadecimal digits each."""
    return found.astype(">u4").tobytes().hex()


def size_partition(size: int, least: float) -> int:
    """Sets that are at least ``least`` alike are in the same or in neighbouring partitions."""
    return int(math.log(max(1, size)) / -math.log(least))


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard likeness of two sorted sets; 0 where their sizes alone keep it under ``least``. Two empty sets are equal."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    small, large = sorted((len(a), len(b)))
    if 0 < least < 1 and abs(size_partition(small, least) - size_partition(large, least)) > 1 or small < least * large:
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    shared = int((b[at] == a).sum())
    found = shared / (len(a) + len(b) - shared)
    return found if found >= least else 0.0


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = CHAIN) -> DataFrame:
    """``id_col``, ``signatures`` and ``fingerprint`` of each row, null texts as empty ones."""
    def each(texts: list[str]) -> list[list]:
        found = signatures(texts, chain)
        return [[f.astype(np.int64) for f in found], [as_text(f) for f in found]]

    return map_texts(df, id_col, text_col, each, {"signatures": pa.list_(pa.int64()), "fingerprint": pa.string()})


def _part(doc: Column, bounds: list[int]) -> Column:
    """How many bounds are above an id, found in two steps of about the root of their number."""
    if not bounds:
        return F.lit(0)
    size = max(1, math.isqrt(len(bounds)))
    falling = sorted(bounds, reverse=True)
    chunks = [falling[i : i + size] for i in range(0, len(falling), size)]
    outer = F.size(F.filter(F.array(*[F.lit(c[-1]) for c in chunks]), lambda b: b > doc))
    inner = F.element_at(F.array(*[F.array(*map(F.lit, c)) for c in [*chunks, [falling[-1]]]]), outer + 1)
    return outer * size + F.when(outer < len(chunks), F.size(F.filter(inner, lambda b: b > doc))).otherwise(F.lit(0))


def dealt_in_order(rows: DataFrame) -> DataFrame:
    """``id``, ``text``, ``part`` and ``guest``: rows in falling order of id within each part, then the row that follows.

    Ids are cut into ranges, and the first row of a range is sent to the range before as well,
    as its guest. So every row meets its next one, with one shuffle of the texts. What comes
    to the driver is the bounds and the largest id of each range.
    """
    spark = rows.sparkSession
    count = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [n / count for n in range(1, count)]
    bounds, = rows.agg(F.percentile_approx("id", cuts, 10 * count)).first()
    part = _part(F.col("id"), sorted(set(bounds or [])))
    heads = {r["part"]: r["top"] for r in rows.groupBy(part.alias("part")).agg(F.max("id").alias("top")).collect()}
    order = sorted(heads)
    before = {at: order[n - 1] for n, at in enumerate(order)}
    highest = max(order, default=0) + 1
    tops = F.array(*[F.lit(heads.get(n)).cast("bigint") for n in range(highest)])
    earlier = F.array(*[F.lit(before.get(n, 0)) for n in range(highest)])
    here = F.struct(F.col("part"), F.lit(0).alias("guest"))
    there = F.struct(F.element_at(earlier, F.col("part") + 1).alias("part"), F.lit(1).alias("guest"))
    placed = rows.withColumn("part", part)
    first = F.element_at(tops, F.col("part") + 1) == F.col("id")
    return (
        placed.withColumn("to", F.explode(F.when(first, F.array(here, there)).otherwise(F.array(here))))
        .select("id", "text", "to.part", "to.guest")
        .repartition("part")
        .sortWithinPartitions("part", "guest", F.desc("id"), F.desc("text"))
    )


_OUT = "id bigint, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_text(text: str, following: str) -> str:
    """A text with the later half of its characters replaced by as many of another's, or all that has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(rows: Iterator[tuple[int, str, str]]) -> Iterator[list[tuple]]:
    """Rows of ``_OUT`` from id, text and next text, some at a time."""
    held: list[tuple[int, str, str]] = []
    size = 0

    def made() -> list[tuple]:
        edited = [edited_text(t, n) for _, t, n in held]
        own, other, after = (signatures(x) for x in ([t for _, t, _ in held], edited, [n for *_, n in held]))
        return [(i, len(t), e, as_text(a), as_text(b), likeness(a, b), likeness(a, c))
                for (i, t, _), e, a, b, c in zip(held, edited, own, other, after)]

    for row in rows:
        held.append(row)
        size += len(row[1]) + len(row[2])
        if size > 4 << 20:
            yield made()
            held, size = [], 0
    if held:
        yield made()


def _schema(kind: pa.DataType) -> pa.Schema:
    kinds = [kind, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    return pa.schema([pa.field(f.split()[0], k) for f, k in zip(_OUT.split(", "), kinds)])


def with_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row against its own edited text and against the next row, in falling order of id.

    ``id_col``, ``n_chars``, ``edited`` (the later half replaced by the start of the next
    text; after the last row comes the first), ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next``. A null text is an empty one. Rows that share an id
    follow each other by text. Rows without an id have no next one: nothing replaces their
    half, and they are like it only if both are empty.
    """
    shared_dir(df.sparkSession)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, str]]:
        last = None
        for batch in batches:
            for piece in slices(batch, 4 << 20):
                for part, guest, doc, text in zip(*(piece.column(c).to_pylist() for c in ("part", "guest", "id", "text"))):
                    if last is not None and last[0] == part and not last[1]:
                        yield last[2], last[3], text
                    last = part, guest, doc, text

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[None, str, str]]:
        for batch in batches:
            yield from ((None, text, "") for text in batch.column("text").to_pylist())

    def run(read):
        def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = (row for some in _compared(read(batches)) for row in some)
            yield from in_batches(found, _schema(pa.int64()), lambda r: len(r[2]) + len(r[3]) + len(r[4]) + 64)

        return out

    ordered = dealt_in_order(rows.where("id IS NOT NULL")).mapInArrow(run(pairs), _OUT)
    single = rows.where("id IS NULL").mapInArrow(run(alone), _OUT)
    return ordered.unionAll(single).withColumnRenamed("id", id_col)
