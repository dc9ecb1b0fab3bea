"""Credits, rated titles and the page of each person."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import is_acting
from marquee.functions.scalars import ACTING_CATEGORIES
from marquee.operators.joins import lookup_join

TOP_TITLES = 3


def acting_credits(credits: DataFrame, acting: tuple[str, ...] = ACTING_CATEGORIES) -> DataFrame:
    return credits.where(is_acting(F.col("category"), acting)).select("title_id", "person_id")


def rated_titles(titles: DataFrame, ratings: DataFrame) -> DataFrame:
    """Titles that have a name and a rating other than zero."""
    named = titles.where(F.col("original_title") != "").select("title_id", "original_title")
    rated = ratings.where(F.col("mean") != 0).select("title_id", F.col("mean").alias("rating"))
    return named.join(rated, "title_id")


def credited_rated_titles(credits: DataFrame, titles: DataFrame, ratings: DataFrame,
                          acting: tuple[str, ...] = ACTING_CATEGORIES) -> DataFrame:
    """One row per acting credit of a rated title.

    Titles and ratings are joined first: both have one row per title, so only the
    last join can be skewed, and that one Spark can split.
    """
    joined = lookup_join(acting_credits(credits, acting), rated_titles(titles, ratings), "title_id")
    return joined.select("title_id", "person_id", "original_title", "rating")


def person_title_best(credits: DataFrame, titles: DataFrame, ratings: DataFrame,
                      acting: tuple[str, ...] = ACTING_CATEGORIES) -> DataFrame:
    """The best rating per person and title name.

    Repeated credits fold into the partial maximum on the side of the join, so
    they need no shuffle of their own.
    """
    return (
        credited_rated_titles(credits, titles, ratings, acting)
        .groupBy("person_id", "original_title")
        .agg(F.max("rating").alias("rating"))
    )


def top_titles(best: DataFrame, k: int = TOP_TITLES) -> DataFrame:
    """The k best titles per person, ties by name. Each task keeps k rows per person before the shuffle."""
    order = Window.partitionBy("person_id").orderBy(F.desc("rating"), "original_title")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def title_totals(best: DataFrame) -> DataFrame:
    """Number of rated title names per person.

    Counting ``rating``, which is never null here, keeps the columns of ``best``
    as they are, so a plan that also ranks ``best`` shuffles it once for both.
    """
    return best.groupBy("person_id").agg(F.count("rating").alias("total"))


def top_columns(ranked: DataFrame, k: int = TOP_TITLES) -> DataFrame:
    """Ranked titles turned into columns top1, top2, ... of one row per person."""
    return ranked.groupBy("person_id").agg(*[
        F.max(F.when(F.col("rank") == n, F.col("original_title"))).alias(f"top{n}")
        for n in range(1, k + 1)
    ])


def title_summary(best: DataFrame, k: int = TOP_TITLES) -> DataFrame:
    """Total and best titles per person. Both sides come from one shuffle of ``best``."""
    return title_totals(best).join(top_columns(top_titles(best, k), k), "person_id")


def person_pages(people: DataFrame, summary: DataFrame) -> DataFrame:
    """Details and summary on one row; a person without rated titles has total 0."""
    joined = people.join(summary, "person_id", "full")
    return joined.withColumn("total", F.coalesce("total", F.lit(0).cast("bigint")))
