"""People who share titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import hashed_long
from marquee.functions.scalars import ACTING_CATEGORIES
from marquee.operators.credits import acting_credits
from marquee.operators.joins import lookup_join

#: People of a cast that meet in one task at most. It changes the plan, not the pairs.
CAST_BLOCK = 1_000
#: Rows that a set of collaborators is spread over.
SET_PARTS = 16


def shared_title_counts(credits: DataFrame, acting: tuple[str, ...] = ACTING_CATEGORIES,
                        block: int = CAST_BLOCK) -> DataFrame:
    """Unordered pairs of different people with the number of titles they share.

    Repeated credits go first. A cast of more than ``block`` people is cut into
    blocks, and each pair of blocks is a join key of its own, so one very large
    title becomes many even tasks. Every pair is made once, smaller id first, and
    is counted before the shuffle on the pair. Both sides of the self-join are the
    same rows on purpose: Spark shuffles them once.
    """
    cast = acting_credits(credits, acting).dropna().distinct()
    large = (
        cast.groupBy("title_id").agg(F.count("*").alias("_n")).where(F.col("_n") > block)
        .select("title_id", F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    )
    blocks = F.coalesce("_blocks", F.lit(1))
    block = F.when(F.col("_blocks").isNotNull(), F.pmod(F.xxhash64("person_id"), F.col("_blocks"))).otherwise(F.lit(0))
    placed = (
        lookup_join(cast, large, "title_id", "left")
        .select("title_id", "person_id", blocks.alias("_blocks"), block.cast("int").alias("_block"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .select("title_id", "person_id", "_block", F.least("_block", "_other").alias("_lo"),
                F.greatest("_block", "_other").alias("_hi"))
    )
    a, b = placed.alias("a"), placed.alias("b")
    same_key = [F.col(f"a.{key}") == F.col(f"b.{key}") for key in ("title_id", "_lo", "_hi")]
    across = F.col("a._block") < F.col("b._block")
    within = (F.col("a._lo") == F.col("b._hi")) & (F.col("a.person_id") < F.col("b.person_id"))
    first, second = F.col("a.person_id"), F.col("b.person_id")
    return (
        a.join(b, [*same_key, across | within])
        .groupBy(F.least(first, second).alias("first_id"), F.greatest(first, second).alias("second_id"))
        .agg(F.count("*").alias("shared_titles"))
    )


def collaborator_strength(shared: DataFrame) -> DataFrame:
    """Each pair in both directions, with the number of shared titles."""
    both = F.array(
        F.struct(F.col("first_id").alias("person_id"), F.col("second_id").alias("other_id")),
        F.struct(F.col("second_id").alias("person_id"), F.col("first_id").alias("other_id")),
    )
    return shared.select(F.explode(both).alias("_pair"), "shared_titles").select("_pair.*", "shared_titles")


def collaborator_pairs(shared: DataFrame) -> DataFrame:
    return collaborator_strength(shared).select("person_id", "other_id")


def collaborator_sets(pairs: DataFrame, parts: int = SET_PARTS) -> DataFrame:
    """The sorted collaborators of each person, in parts.

    Every set is spread by a hash of the other person over the same number of parts, so a row
    is one of ``parts`` of its person, and which part somebody is in never depends on who else
    is there. A part without anybody has no row; the parts together are the set. ``parts`` is
    chosen once, for the largest set that is to be held, and bounds a row to that over
    ``parts``.
    """
    part = (hashed_long(F.col("other_id")) % parts).cast("bigint")
    return (
        pairs.withColumn("part", part)
        .groupBy("person_id", "part")
        .agg(F.array_sort(F.collect_list("other_id")).alias("others"))
    )
