"""Near duplicates by SimHash, found with covering hash tables.

A fingerprint is masked once per table and texts with equal masked fingerprints meet. The
masks come from a linear code: bit i of the fingerprint has a vector m(i) of r + 1 bits, and
the table of a vector v > 0 keeps the bits with <m(i), v> = 1. Whatever r bits two
fingerprints differ in, some v is at right angles to all their vectors, so in that table
none of them is kept and the two meet. No pair within the radius is missed.

A fingerprint is a point, however many rows have it. A bucket gives a forest of links, never all
its pairs. A bucket of very many points is dealt out once more by a second family of masks
over its other bits; after that 16 bits are free in the mean and 22 at most, so whatever the
data a group is small enough for one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.text import map_texts
from marquee.operators.joins import lookup_join
from marquee.session import shared_dir

BITS = 64
SEED = 42

#: Words of a shingle, and the bits that linked fingerprints may differ in.
WORDS = 4
RADIUS = 4

#: Bytes of text that are hashed at a time. A byte may take some 200 bytes of memory, where words have one letter.
SLICE = 1 << 19

#: Points in a bucket above which it is dealt out by the second masks. It changes the plan, not the links.
LARGE_BUCKET = 1_000

#: Eight bits spread over the eight bytes of a word, to count 64 bits at once.
_SPREAD = np.array([sum((b >> k & 1) << 8 * k for k in range(8)) for b in range(256)], np.uint64)


def masks(radius: int, turn: int = 0) -> list[int]:
    """The masks of all tables, as unsigned 64-bit numbers. ``turn`` gives another family."""
    size = 1 << radius + 1
    vectors = [((i // 31 * 10 + i * i) if turn else i) % (size - 1) + 1 for i in range(BITS)]
    return [sum(((m & v).bit_count() & 1) << i for i, m in enumerate(vectors)) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingle_hashes(words: list[bytes], n: int) -> np.ndarray:
    """XXH64 of every shingle of n words joined by one space; of fewer words, the whole row of them is one."""
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    stops = (ends[n - 1 :] - 1).tolist() or [len(joined)]
    found = [digest(joined[a:b], SEED) for a, b in zip(starts, stops)]
    return np.fromiter(found, np.uint64, len(found))


def majority_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """The fingerprint of each set of hashes: a bit is 1 if it is in over half of them."""
    sizes = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(hashes), np.uint64)
    held = np.flatnonzero(sizes)
    if not len(held):
        return out
    first = np.concatenate(([0], np.cumsum(sizes[held])[:-1]))
    runs = -(-sizes[held] // 255)  # a byte counts to 255
    run_first = np.concatenate(([0], np.cumsum(runs)[:-1]))
    at = np.repeat(first - 255 * run_first, runs) + 255 * np.arange(runs.sum())
    spread = _SPREAD[np.concatenate(hashes).astype("<u8").view(np.uint8).reshape(-1, 8)]
    counts = np.add.reduceat(spread, at, axis=0).astype("<u8").view(np.uint8).astype(np.int64)
    total = np.add.reduceat(counts, run_first, axis=0)
    bits = (2 * total > sizes[held, None]).astype(np.uint8)
    out[held] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``id_col`` and ``fingerprint``, as a signed 64-bit number, of each row.

    A-Z count as lower case; words are what stands between spaces and control characters. A
    text without words, also a null one, has zero. Rows that repeat are kept each.
    """
    def each(texts: list[str]) -> list[list]:
        found = [shingle_hashes(t.encode("utf-8", "surrogatepass").lower().split(), words) for t in texts]
        return [majority_bits(found).view(np.int64).tolist()]

    return map_texts(df, id_col, text_col, each, {"fingerprint": pa.int64()}, slice_chars=SLICE)


def links(points: DataFrame, radius: int = RADIUS, large: int = LARGE_BUCKET) -> DataFrame:
    """Links (a, b), a < b, that connect all fingerprints in ``point`` that differ in ``radius`` bits or fewer.

    Of points linked in a ring some links are left out; which points hang together is the
    same. Should two buckets' numbers fall together, their bucket only gets larger.
    """
    family, second = (F.array(*[F.lit(_signed(m)) for m in masks(radius, turn)]) for turn in (0, 1))
    met = points.select("point", F.posexplode(family).alias("table", "mask")).select(
        "point", F.xxhash64("table", F.col("point").bitwiseAND(F.col("mask"))).alias("bucket"))
    sizes = met.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    some = F.array(F.lit(None).cast("bigint"))
    dealt = (
        lookup_join(met, sizes, "bucket")
        .withColumn("mask", F.explode(F.when(F.col("size") > large, second).otherwise(some)))
        .select("point", F.when(F.col("mask").isNull(), F.col("bucket")).otherwise(
            F.xxhash64("bucket", "mask", F.col("point").bitwiseAND(F.col("mask")))).alias("bucket"))
    )
    gathered = dealt.repartition("bucket").sortWithinPartitions("bucket")

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The forest of each bucket, from rows sorted by bucket."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "point"))
            held.append(rows)
            if rows[0][0] == rows[0][-1] and held[0][0][0] == rows[0][0]:
                continue  # one bucket so far
            buckets, found = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(buckets, buckets[-1]))
            yield _pairs(buckets[:cut], found[:cut], radius)
            held = [(buckets[cut:], found[cut:])]
        if held:
            yield _pairs(*(np.concatenate(x) for x in zip(*held)), radius)

    return gathered.mapInArrow(forests, "a bigint, b bigint").distinct()


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))


def _pairs(buckets: np.ndarray, points: np.ndarray, radius: int) -> pa.RecordBatch:
    starts = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1]))) if len(buckets) else np.zeros(0, int)
    sizes = np.diff(np.concatenate((starts, [len(buckets)])))
    two = starts[sizes == 2]
    near = two[_apart(points[two], points[two + 1]) <= radius]
    found = [(points[near], points[near + 1])]
    for at, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        found.append(forest(points[at : at + size], radius))
    a, b = (np.concatenate(x) for x in zip(*found))
    a, b = np.minimum(a, b), np.maximum(a, b)
    apart = a != b
    return pa.RecordBatch.from_arrays([pa.array(a[apart]), pa.array(b[apart])], names=["a", "b"])


def forest(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is linked within one bucket: each point is compared with those not reached yet."""
    left = points
    a, b = [], []
    while len(left):
        reached, left = [left[:1]], left[1:]
        while reached and len(left):
            at = reached.pop()
            near = _apart(left, at) <= radius
            if near.any():
                hit = left[near]
                a.append(np.repeat(at, len(hit)))
                b.append(hit)
                reached += np.split(hit, len(hit))
                left = left[~near]
    none = np.zeros(0, points.dtype)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it hangs together with, for every node of the links (a, b) but roots.

    Stars are drawn to the smallest neighbour, in turn from larger and from smaller nodes,
    until nothing changes. The centre of a large star has very many rows, so it is joined in
    a way that can be split. Every round is checkpointed, so that a lost executor costs one
    round, and what comes back to the driver is two numbers.
    """
    shared_dir(edges.sparkSession)
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    state = _state(now)
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = lookup_join(both, least, "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = lookup_join(large, least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(
            F.col("v")).alias("u"), F.col("m").alias("v"))
        now = small.distinct().checkpoint()
        before, state = state, _state(now)
        if before == state:
            return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS,
           large: int = LARGE_BUCKET) -> DataFrame:
    """``id_col``, ``fingerprint`` and ``component_id``, the smallest id that a row is linked with over any way.

    Fingerprints are linked, not ids: rows that share an id are each in the component of
    their own fingerprint. Rows without an id take part, and have no component only where
    nothing in it has an id. No rows give no rows; further columns are left behind.
    """
    shared_dir(df.sparkSession)
    made = fingerprints(df, id_col, text_col, words).withColumnRenamed(id_col, "id").checkpoint()
    points = made.groupBy(F.col("fingerprint").alias("point")).agg(F.min("id").alias("first")).checkpoint()
    roots = components(links(points.select("point"), radius, large))
    rooted = points.join(roots, F.col("point") == F.col("node"), "left").select(
        F.col("point").alias("fingerprint"), "first", F.coalesce("root", "point").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_point = lookup_join(rooted.drop("first"), smallest, "root").drop("root")
    return lookup_join(made, of_point, "fingerprint").select(F.col("id").alias(id_col), "fingerprint", "component_id")


def one_of_each_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                      radius: int = RADIUS) -> DataFrame:
    """Of each component the row of the smallest id, whole and unchanged.

    Of rows with that id in the component it is the one whose digest over all columns is
    smallest, in every run; rows of one id whose texts are unlike are in components of their
    own and all stay. A row without an id stays only where the component has no other.
    """
    told = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))
    keyed = df.select(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), told.alias("told")).alias("key"),
                      F.col(text_col).alias("text"))
    found = groups(keyed, "key", "text", words, radius)
    stay = found.where(F.col("key") == F.col("component_id")).select(F.col("key.told").alias("_told")).distinct()
    # Rows of one digest are equal in every column, so any one of them is the one.
    return lookup_join(df.withColumn("_told", told), stay, "_told").dropDuplicates(["_told"]).drop("_told")
