"""The prefix trie of conversations, by peeling turns off their ends.

A node is a distinct sequence of first turns. Peeling starts at the deepest nodes: what ends
there is merged with what was carried up from below, the last turn is stripped, and what is
left is grouped again, one level up. Sums over subtrees come out of the same sweep.

Turns that no conversation leaves or ends between are stripped at once: a run of nodes with
the same members is one step, so the number of rounds is that of the forks on a path and not
that of the turns of the longest conversation. Which nodes form a run is seen from the number
of members of each node along a conversation.

A node is known by a digest over its turns, chained from turn to turn, so texts are read once
and never shuffled. Every grouping is combined before its shuffle, so a start that a third of
all conversations share is no burden to one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.text import WORD, in_batches
from marquee.operators.joins import lookup_join
from marquee.session import new_folder, shared_dir

#: Every conversation gets the start of the first one of its block of so many, at most this many turns less one.
BLOCK = 20
START_TURNS = 4

#: Ids that are joined to one text before all ids of a node are brought together.
CHUNK_IDS = 4_096

_ROOT = bytes(16)


def turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """``conv``, ``pos`` (from 1), ``digest`` of role and text, and ``words`` of the text, of every turn.

    Turns go by ``turn_col``, null first. Of equal ones the digest decides, which is the same
    in every run. A null role or text is empty. Rows without a conversation take no part.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    told = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return (
        df.where(F.col(conv_col).isNotNull())
        .select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), told.alias("digest"),
                F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"))
        .select("conv", F.row_number().over(order).cast("bigint").alias("pos"), "digest", "words")
    )


def start_turns(conv: Column) -> Column:
    return F.crc32(conv.cast("string")) % START_TURNS


def with_common_starts(rows: DataFrame) -> DataFrame:
    """Turns of conversations that begin as the first one of their block does.

    The first h turns come from the conversation whose number is the block's, as many as it
    has; then come the conversation's own after its first h. h is a checksum of the number.
    Returns the rows of ``turns`` with ``part``: -1 for a row that stands for the
    conversation itself, 0 for turns that were lent, 1 for its own. Turns are numbered once
    and kept in the shared folder, without their texts.
    """
    shared_dir(rows.sparkSession)
    rows = rows.checkpoint()
    convs = rows.select("conv").distinct().withColumn("h", start_turns(F.col("conv"))).withColumn(
        "base", F.col("conv") - F.col("conv") % BLOCK)
    lent = rows.where((F.col("conv") % BLOCK == 0) & (F.col("pos") < START_TURNS)).withColumnRenamed("conv", "base")
    lent = convs.join(lent, "base").where("pos <= h").select("conv", F.lit(0).alias("part"), "pos", "digest", "words")
    own = rows.where(F.col("pos") > start_turns(F.col("conv"))).select(
        "conv", F.lit(1).alias("part"), "pos", "digest", "words")
    return _themselves(convs).unionByName(lent).unionByName(own)


def as_they_are(rows: DataFrame) -> DataFrame:
    """Turns as ``trie`` takes them, of conversations that stay as they are."""
    return _themselves(rows.select("conv").distinct()).unionByName(rows.select(
        "conv", F.lit(1).alias("part"), "pos", "digest", "words"))


def _themselves(convs: DataFrame) -> DataFrame:
    return convs.select("conv", F.lit(-1).alias("part"), F.lit(0).cast("bigint").alias("pos"), F.lit("").alias("digest"),
                        F.lit(0).cast("bigint").alias("words"))


def chained(rows: DataFrame) -> DataFrame:
    """Every conversation at every depth: ``conv``, ``depth``, ``key`` of the node, ``words``, ``path_words``, ``ends``.

    ``path_words`` are the words of all turns so far; ``ends`` says that there are no more. A
    conversation passes through its task turn by turn.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "part", "pos").select(
        "conv", "part", "digest", "words")
    return ordered.mapInArrow(
        _chain, f"conv {kind}, depth bigint, key binary, words bigint, path_words bigint, ends boolean")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list = []  # the row that waits for the next one, which tells whether it is the last
    schema = None

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for conv, part, digest, words in zip(*(c.to_pylist() for c in batch.columns)):
            if held:
                yield (*held, part < 0)
            if part < 0:
                held[:] = conv, 0, _ROOT, 0, 0
            else:
                _, depth, key, _, path = held
                held[:] = conv, depth + 1, hashlib.md5(key + bytes.fromhex(digest)).digest(), words, path + words

    for batch in batches:
        schema = schema or pa.schema([
            ("conv", batch.schema.field("conv").type), ("depth", pa.int64()), ("key", pa.binary()),
            ("words", pa.int64()), ("path_words", pa.int64()), ("ends", pa.bool_())])
        yield from in_batches(rows(batch), schema, lambda row: 64)
    if held:
        yield from in_batches(iter([(*held, True)]), schema, lambda row: 64)


def discovered(chain: DataFrame) -> DataFrame:
    """One row per node: its members, its parent, and the run of nodes with the same members that it is in.

    ``key``, ``depth``, ``conv_id``, ``parent_conv_id``, ``n_convs``, ``words``,
    ``path_words``, ``level`` (runs above it), ``run`` and ``parent_run``. A conversation
    that is the smallest member of a node tells all of this of it.
    """
    members = chain.groupBy("key").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"))
    path = Window.partitionBy("conv").orderBy("depth")
    so_far = path.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    forks = F.coalesce(F.lag("n_convs").over(path) != F.col("n_convs"), F.lit(True))
    return (
        lookup_join(chain, members, "key")
        .withColumn("forks", forks)
        .withColumn("parent_conv_id", F.lag("conv_id").over(path))
        .withColumn("level", F.count_if("forks").over(so_far) - 1)
        .withColumn("run", F.last(F.when(F.col("forks"), F.col("key")), ignorenulls=True).over(so_far))
        .withColumn("above", F.lag("run").over(path))
        .withColumn("parent_run", F.last(F.when(F.col("forks"), F.col("above")), ignorenulls=True).over(so_far))
        .where("conv = conv_id")
        .select("key", "depth", "conv_id", "parent_conv_id", "n_convs", "words", "path_words", "level", "run",
                "parent_run")
    )


def peeled(nodes: DataFrame) -> DataFrame:
    """Sums over the subtree of each run's top: ``run``, ``saved``, ``leaves``, ``children``, and where the run lies.

    From the deepest level up: the runs of a level are merged with what their children left,
    and leave their own sums to the run above. Every level is written to the shared folder,
    so a lost executor costs one level.
    """
    spark = nodes.sparkSession
    runs = nodes.groupBy("run", "level").agg(
        F.max("parent_run").alias("parent_run"), F.max("depth").alias("bottom"),
        F.min(F.col("path_words") - F.col("words")).alias("words_before"),
        ((F.max("n_convs") - 1) * (F.max("path_words") - F.min(F.col("path_words") - F.col("words")))).alias("saved"))
    none = F.lit(0).cast("bigint")
    waiting, done = new_folder(spark, "trie-runs"), new_folder(spark, "trie-levels")
    runs.withColumns({"leaves": none, "children": none}).write.partitionBy("level").parquet(waiting)
    waits = spark.read.schema(f"run binary, parent_run binary, bottom bigint, words_before bigint, saved bigint, "
                              f"leaves bigint, children bigint, level bigint").parquet(waiting)
    deepest, = waits.agg(F.max("level")).first()
    merged = _merged(waits.where("false").drop("level"))
    if deepest is None:
        return merged
    carried = waits.where("false").drop("level")
    for level in range(deepest, -1, -1):
        _merged(waits.where(F.col("level") == level).drop("level").unionByName(carried)).write.parquet(
            f"{done}/level={level}")
        stripped = spark.read.schema(merged.schema).parquet(f"{done}/level={level}")
        carried = stripped.select(
            F.col("parent_run").alias("run"), F.lit(None).cast("binary").alias("parent_run"),
            *[F.lit(None).cast("bigint").alias(c) for c in ("bottom", "words_before")], "saved", "leaves",
            F.lit(1).cast("bigint").alias("children"))
    return spark.read.schema(merged.schema).parquet(done)


def _merged(state: DataFrame) -> DataFrame:
    merged = state.groupBy("run").agg(
        *[F.max(c).alias(c) for c in ("parent_run", "bottom", "words_before")],
        *[F.sum(c).alias(c) for c in ("saved", "leaves", "children")])
    return merged.withColumn("leaves", F.when(F.col("children") == 0, F.lit(1).cast("bigint")).otherwise(F.col("leaves")))


def end_digests(ended: DataFrame) -> DataFrame:
    """``key`` and the digest of all ids that end there, in order, from rows of ``key`` and ``conv``.

    Ids are joined in chunks where they lie by ranges, so a node where very many end is cut
    up; the digest is then taken over the few chunks.
    """
    ranged = ended.select("key", "conv").repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
    chunks = ranged.mapInArrow(_joined, "key binary, first bigint, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(
        _digested, "key binary, ends_sha256 string")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    key, ids = None, []

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        nonlocal key, ids
        for now, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and (now != key or len(ids) == CHUNK_IDS):
                yield key, ids[0], ",".join(map(str, ids))
                ids = []
            key = now
            ids.append(conv)

    for batch in batches:
        yield from in_batches(rows(batch), schema, lambda row: 32 + len(row[2]))
    if ids:
        yield from in_batches(iter([(key, ids[0], ",".join(map(str, ids)))]), schema, lambda row: 32)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    key, digest = None, None

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        nonlocal key, digest
        for now, ids in zip(*(c.to_pylist() for c in batch.select(["key", "ids"]).columns)):
            if digest and now == key:
                digest.update(b"," + ids.encode())
                continue
            if digest:
                yield key, digest.hexdigest()
            key, digest = now, hashlib.sha256(ids.encode())

    for batch in batches:
        yield from in_batches(rows(batch), schema, lambda row: 96)
    if digest:
        yield from in_batches(iter([(key, digest.hexdigest())]), schema, lambda row: 96)


def trie(rows: DataFrame) -> DataFrame:
    """One row per node of the trie of the conversations in ``rows`` (``as_they_are``, ``with_common_starts``).

    ``conv_id``, the smallest member; ``depth``; ``parent_conv_id``, null for the root;
    ``n_convs``, members; ``n_children``; ``n_leaves``, nodes without children in its
    subtree, itself included; ``saved_tokens``, words that need not be read again if every
    node of its subtree is read once; ``ends_sha256``, of the members that end there. Ids
    are whole numbers. Without conversations there is no node, not even a root.
    """
    shared_dir(rows.sparkSession)
    chain = chained(rows).checkpoint()
    nodes = discovered(chain).checkpoint()
    sums = peeled(nodes)
    placed = lookup_join(nodes.drop("parent_run", "level"), sums.drop("parent_run", "level"), "run")
    above = F.col("path_words") - F.col("words") - F.col("words_before")
    told = placed.select(
        "key", "conv_id", "depth", "parent_conv_id", "n_convs",
        F.when(F.col("depth") < F.col("bottom"), F.lit(1).cast("bigint")).otherwise(F.col("children")).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") - (F.col("n_convs") - 1) * above).alias("saved_tokens"))
    digests = end_digests(chain.where("ends"))
    none = hashlib.sha256(b"").hexdigest()
    return told.join(digests, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
