"""Fold new votes into stored mean ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vote_totals(votes: DataFrame) -> DataFrame:
    """Sum and number of votes per title."""
    return votes.groupBy("title_id").agg(
        F.sum("rating").alias("vote_sum"), F.count("*").alias("vote_count"))


def merge_ratings(ratings: DataFrame, totals: DataFrame) -> DataFrame:
    """Stored means with the new votes added.

    A title without new votes keeps its values, votes for a title that has no
    stored rating are left out, and a title with no votes at all has no mean.
    """
    joined = ratings.join(totals, "title_id", "left")
    votes = F.col("votes") + F.coalesce("vote_count", F.lit(0))
    total = F.coalesce("mean", F.lit(0.0)) * F.col("votes") + F.coalesce("vote_sum", F.lit(0))
    return joined.select(
        "title_id",
        F.when(F.col("vote_count").isNull(), F.when(F.col("votes") != 0, F.col("mean")))
        .otherwise(F.try_divide(total, votes)).alias("mean"),
        votes.alias("votes"),
    )
