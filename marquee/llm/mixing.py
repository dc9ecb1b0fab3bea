"""Mix sources to target weights by a low-discrepancy schedule.

The mix is a row of equal slots. Slot i looks at the i-th van der Corput point and takes the
source whose stretch of the cumulative targets holds it, so after any number of slots each
source has had its share to within a few. Each source is laid out as a stream: its documents
in the order of a digest of their id, twice over, cut into blocks of a slot's length. The
k-th slot of a source takes its k-th block.

All of it is DataFrame expressions. Streams are laid out from sums per source and digest
prefix, so no task ever holds a source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.text import WORD
from marquee.operators.joins import lookup_join
from marquee.operators.running import running_total
from marquee.session import shared_dir

#: Weights of the sources in code point order, repeating; the share of all words that the mix takes; and how often
#: a source may be read.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2

#: There are 2 ** SLOTS slots, or the largest power of two that is not above the number of words.
SLOTS = 20
#: Digest digits that a stream is cut by, and slots that are ranked together.
PREFIX = 3
CHUNK = 256


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def source_key(source: Column) -> Column:
    """A source as text that sorts by code point, no source last."""
    return F.coalesce(F.concat(F.lit("a"), source.cast("string")), F.lit("b"))


def order_key(doc: Column) -> Column:
    """The place of a document in its source's stream: as good as random, and the same in every run."""
    return F.md5(F.coalesce(doc.cast("string"), F.lit("")))


def keyed(df: DataFrame, id_col: str, text_col: str, source_col: str, *keep: Column) -> DataFrame:
    return df.select(*keep, source_key(F.col(source_col)).alias("source_key"),
                     order_key(F.col(id_col)).alias("order_key"), word_count(F.col(text_col)).alias("size"))


def prefix() -> Column:
    return F.substring("order_key", 1, PREFIX)


def prefix_sums(rows: DataFrame) -> DataFrame:
    """Words per source and digest prefix: a few thousand rows per source."""
    return rows.groupBy("source_key", prefix().alias("prefix")).agg(F.sum("size").alias("words"))


def targets(sums: DataFrame) -> DataFrame:
    """One row per source: its words, its weight by rank, and the words the mix is to take of it.

    Sources get shares by weight; one whose share would exceed ``PASSES`` times its words
    gets that, and what it leaves goes to the others by weight. A round that does so is one
    sum over the sources; rounds end once no further source is over.
    """
    totals = sums.groupBy("source_key").agg(F.sum("words").alias("source_size")).withColumn("one", F.lit(1))
    ranked = running_total(totals, ["source_key"], "one", "source_rank")
    weights = F.array(*map(F.lit, WEIGHTS))
    weighted = ranked.withColumn("weight", F.element_at(weights, (
        (F.col("source_rank") - 1) % len(WEIGHTS) + 1).cast("int"))).drop("one").checkpoint()
    share = _fair_share(weighted)
    return weighted.withColumn("target", _capped(F.lit(share))).withColumn(
        "aim", F.floor(F.col("target") + 0.5).cast("bigint")).select(
        "source_key", "source_rank", "source_size", "target", "aim")


def _capped(share: Column) -> Column:
    return F.least(share * F.col("weight"), F.lit(float(PASSES)) * F.col("source_size"))


def _fair_share(weighted: DataFrame) -> float:
    """Words per unit of weight for the sources that are not read to their end."""
    size, = weighted.agg(F.sum("source_size")).first()
    wanted, share, closed = SHARE * (size or 0), 0.0, -1
    while True:
        over = F.lit(share) * F.col("weight") > PASSES * F.col("source_size")
        count, full, weight = weighted.agg(
            F.count_if(over), F.sum(F.when(over, PASSES * F.col("source_size"))),
            F.sum(F.when(~over, F.col("weight")))).first()
        if count == closed or not weight:
            return share
        share, closed = (wanted - (full or 0)) / weight, count


def slots(goals: DataFrame) -> DataFrame:
    """``goals`` with ``n_slots`` and ``first``: a source has the points from first on, of 2 ** k evenly spaced ones.

    Also ``words_per_slot``. The last block of a source ends at its aim, be it before or after
    the end of its slot; a source that aims at less than a slot has one slot, which may be
    another source's too.
    """
    aimed, = goals.agg(F.coalesce(F.sum("aim"), F.lit(0))).first()
    count = 1 << min(SLOTS, int(math.log2(aimed))) if aimed else 0
    per_slot = aimed / count if count else 1.0
    summed = running_total(goals, ["source_rank"], "aim", "until")
    last = F.ceil(F.col("until") * F.lit(count / aimed if aimed else 0.0)).cast("bigint")
    first = F.ceil((F.col("until") - F.col("aim")) * F.lit(count / aimed if aimed else 0.0)).cast("bigint")
    some = F.greatest(last - first, F.when(F.col("aim") > 0, F.lit(1)).otherwise(F.lit(0))).cast("bigint")
    dealt = summed.withColumn("n_slots", some).withColumn(
        "first", F.least(first, F.lit(max(0, count - 1)).cast("bigint"))).drop("until")
    return dealt.withColumn("words_per_slot", F.lit(per_slot)).withColumn("slot_count", F.lit(count)).checkpoint()


def block_start(block: Column) -> Column:
    return F.ceil(block * F.col("words_per_slot")).cast("bigint")


def schedule(dealt: DataFrame) -> DataFrame:
    """Every slot with its source and block: ``slot``, ``source_rank``, ``block``.

    The point of slot i is i with its bits turned round, so the slots of a source are its
    stretch of points turned back. Their rank is counted in chunks of slots first, then
    within a chunk.
    """
    pieces = dealt.where("n_slots > 0").withColumn("piece", F.explode(F.expr(
        f"sequence(first div {CHUNK}, (first + n_slots - 1) div {CHUNK})")))
    points = pieces.withColumn("point", F.explode(F.sequence(
        F.greatest(F.col("first"), F.col("piece") * CHUNK),
        F.least(F.col("first") + F.col("n_slots"), (F.col("piece") + 1) * CHUNK) - 1)))
    bits = F.log2("slot_count").cast("int")
    turned = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("bigint")
    drawn = points.select("source_rank", F.when(bits == 0, F.lit(0).cast("bigint")).otherwise(turned).alias("slot")
                          ).withColumn("chunk", F.expr(f"slot div {CHUNK}"))
    before = Window.partitionBy("source_rank").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = drawn.groupBy("source_rank", "chunk").agg(F.count("*").alias("n")).select(
        "source_rank", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("source_rank", "chunk").orderBy("slot")
    return drawn.join(chunks, ["source_rank", "chunk"]).select(
        "slot", "source_rank", (F.col("earlier") + F.row_number().over(within) - 1).alias("block"))


def laid_out(rows: DataFrame, sums: DataFrame, dealt: DataFrame) -> DataFrame:
    """``rows`` with where they start in their source's stream, and what ``dealt`` says of the source.

    Rows of equal id and size may change places with each other, which changes no number.
    """
    before = Window.partitionBy("source_key").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    offsets = lookup_join(offsets, dealt, "source_key")
    told = [c for c in rows.columns if c not in ("id", "source_key", "order_key", "size")]
    inside = Window.partitionBy("source_key", "prefix").orderBy("order_key", "size", *told).rowsBetween(
        Window.unboundedPreceding, -1)
    return (
        rows.withColumn("prefix", prefix())
        .withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, ["source_key", "prefix"])
        .withColumn("start", F.col("offset") + F.col("within"))
        .drop("offset", "within", "prefix")
    )


def pieces(placed: DataFrame, dealt: DataFrame) -> DataFrame:
    """The mix: for every slot the pieces of documents in it.

    ``slot``, ``source_rank``, ``block``, ``start`` (with the rank it names the document row),
    ``pass_no``, ``from_word`` and ``words``.
    """
    passes = placed.where("size > 0 AND n_slots > 0").withColumn(
        "pass_no", F.explode(F.array(*map(F.lit, range(PASSES))))).withColumn(
        "at", F.col("start") + F.col("pass_no") * F.col("source_size")).where("at < aim")
    first = F.least(F.col("n_slots") - 1, F.greatest(F.lit(0), F.floor(F.col("at") / F.col("words_per_slot")) - 1))
    last = F.least(F.col("n_slots") - 1, F.floor((F.col("at") + F.col("size")) / F.col("words_per_slot")) + 1)
    cut = passes.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("at"), block_start(F.col("block")))
    block_end = F.when(F.col("block") < F.col("n_slots") - 1, block_start(F.col("block") + 1)).otherwise(F.col("aim"))
    end = F.least(F.col("at") + F.col("size"), block_end, F.col("aim"))
    cut = cut.select("source_rank", "block", "start", "pass_no", (begin - F.col("at")).alias("from_word"),
                     (end - begin).alias("words")).where("words > 0")
    return cut.join(schedule(dealt), ["source_rank", "block"])


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row's ``id_col``, ``size``, ``source_size``, ``target`` of its source, and ``taken``, the words it gives.

    A null or empty text has size 0 and gives nothing. Rows that repeat are rows of their own.
    Null ids are as one id. Rows without a source are a source, the last one. Without any
    words all targets are 0.
    """
    placed, dealt = plan(df, id_col, text_col, source_col)
    got = pieces(placed, dealt).groupBy("source_rank", "start").agg(F.sum("words").alias("taken"))
    key = [placed["source_rank"] == got["source_rank"], placed["start"] == got["start"], placed["size"] > 0]
    return placed.join(got, key, "left").select(
        placed["id"].alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def plan(df: DataFrame, id_col: str, text_col: str, source_col: str, *keep: Column) -> tuple[DataFrame, DataFrame]:
    """The rows in their streams, and one row per source. Only counted words are kept of the texts.

    Columns to ``keep`` tell rows of one id and size apart in their order.
    """
    shared_dir(df.sparkSession)
    rows = keyed(df, id_col, text_col, source_col, F.col(id_col).alias("id"), *keep).checkpoint()
    sums = prefix_sums(rows)
    dealt = slots(targets(sums))
    return laid_out(rows, sums, dealt).checkpoint(), dealt


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """``df``'s columns, each row as often as the mix takes it, in the order of the slots.

    A copy lies where its first slot does; the partitions are stretches of slots, in order.
    Where the mix ends within a document, its last copy has the text up to the end of the last
    word taken. Texts are joined to the finished mix: of rows that are equal in every column
    one text serves all.
    """
    spark = df.sparkSession
    told = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))
    placed, dealt = plan(df, id_col, text_col, source_col, told.alias("told"))
    copies = pieces(placed, dealt).groupBy("source_rank", "start", "pass_no").agg(
        F.sum("words").alias("taken"), F.min("slot").alias("slot"))
    rows = placed.where("size > 0").select("source_rank", "start", "size", "told", "slot_count")
    taken = copies.join(rows, ["source_rank", "start"]).select(
        F.col("told").alias("_told"), F.struct("slot", "slot_count", "taken", "size").alias("_copy"))
    texts = df.withColumn("_told", told).dropDuplicates(["_told"])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = F.floor(F.col("_copy.slot") * parts / F.col("_copy.slot_count")).cast("int")
    text = F.col(f"`{text_col}`")
    words = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    cut = F.when(F.col("_copy.taken") == F.col("_copy.size"), text).otherwise(
        F.array_join(F.slice(words, 1, F.col("_copy.taken").cast("int")), ""))
    in_order = texts.join(taken, "_told").repartitionById(parts, part).sortWithinPartitions("_copy.slot", "_told")
    return in_order.select(*[cut.alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns])
