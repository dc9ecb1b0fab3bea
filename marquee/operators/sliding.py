"""Sliding windows by adding what comes in and subtracting what goes out.

Votes are summed in panes that no window edge cuts. A pane enters at the first window that holds
it and leaves after the last one, so it is two changes, however many windows it lies in. The
running sum of a title's changes is its total in each window, and that stays as it is between
two changes. The work grows with the panes; only who asks for every window by itself gets one
row for each.

Tables only: a change counts on all later windows of its title. A stream puts its windows
together from panes instead, see ``trends.window_means``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from marquee.operators.trends import MEAN_SLIDE, MEAN_WINDOW, common_seconds, seconds


def window_changes(votes: DataFrame, length: str = MEAN_WINDOW, slide: str = MEAN_SLIDE) -> DataFrame:
    """``title_id``, ``at``, ``vote_change`` and ``count_change``: by how much a title's window differs from the one before.

    ``at`` is the start of the window in seconds. At most two rows per pane, fewer where one
    pane leaves as another enters. Ratings with fractions are summed as decimals, since
    doubles would not come back to what they were when a pane leaves.
    """
    part, long, step = common_seconds(length, slide), seconds(length), seconds(slide)
    rating = F.col("rating")
    if isinstance(votes.schema["rating"].dataType, DoubleType | FloatType):
        rating = rating.cast("decimal(24,9)")
    panes = votes.groupBy(F.window("ts", f"{part} seconds").alias("_pane"), "title_id").agg(
        F.coalesce(F.sum(rating), F.lit(0)).alias("_sum"), F.count("*").alias("_n"))
    start = F.unix_seconds("_pane.start")
    first = _up(start + (part - long), step)
    after = start - F.pmod(start, F.lit(step)) + step
    total, n = F.col("_sum"), F.col("_n")
    change = F.array(*[F.struct(at.alias("at"), votes.alias("vote_change"), count.alias("count_change"))
                       for at, votes, count in ((first, total, n), (after, -total, -n))])
    return (
        panes.where(first < after).select("title_id", F.inline(change))
        .groupBy("title_id", "at").agg(F.sum("vote_change").alias("vote_change"), F.sum("count_change").alias("count_change"))
    )


def _up(at: Column, step: int) -> Column:
    return at + F.pmod(-at, F.lit(step))


def window_runs(votes: DataFrame, length: str = MEAN_WINDOW, slide: str = MEAN_SLIDE) -> DataFrame:
    """Runs of windows over which a title's votes stay the same.

    ``title_id``, ``first_start`` and ``last_start``, the starts of the first and last window
    of the run, ``vote_sum``, ``n_votes`` and ``mean_vote``. Windows without a vote of the
    title are in no run. One shuffle by title for the running sum; what a title holds there
    is bounded by the panes of the time covered, not by its votes.
    """
    order = Window.partitionBy("title_id").orderBy("at")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = window_changes(votes, length, slide).select(
        "title_id", "at", F.lead("at").over(order).alias("_until"),
        F.sum("vote_change").over(so_far).alias("vote_sum"), F.sum("count_change").over(so_far).alias("n_votes"))
    return totals.where("n_votes > 0").select(
        "title_id", F.timestamp_seconds("at").alias("first_start"),
        F.timestamp_seconds(F.col("_until") - seconds(slide)).alias("last_start"), "vote_sum", "n_votes",
        (F.col("vote_sum") / F.col("n_votes")).cast("double").alias("mean_vote"))


def window_means(votes: DataFrame, length: str = MEAN_WINDOW, slide: str = MEAN_SLIDE) -> DataFrame:
    """Mean vote per title in each sliding window, as ``trends.window_means`` gives it for a table."""
    step = F.make_dt_interval(secs=F.lit(seconds(slide)))
    return (
        window_runs(votes, length, slide)
        .withColumn("window_start", F.explode(F.sequence("first_start", "last_start", step)))
        .select("window_start", (F.col("window_start") + F.make_dt_interval(secs=F.lit(seconds(length)))).alias("window_end"),
                "title_id", "mean_vote", "n_votes")
    )
