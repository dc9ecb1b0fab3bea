"""Votes by time: minutes, lots, windows and trends.

Each function is a plain DataFrame transform and works on a table and on a
stream alike, except where it says otherwise. Windows are aligned to the epoch.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import minute_text, utc_text

LOT = "10 minutes"
MEAN_WINDOW = "10 minutes"
MEAN_SLIDE = "1 minute"
TREND_PERIOD = "15 minutes"
LOT_NAME_FORMAT = "yyyy-MM-dd HH-mm"
_SECONDS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}


def logged_votes(votes: DataFrame, lot: str = LOT) -> DataFrame:
    """Votes with their minute and the name of their lot, which is the start of its period."""
    return votes.select(
        "title_id", "rating", minute_text(F.col("ts")).alias("minute"),
        utc_text(F.window("ts", lot).start, LOT_NAME_FORMAT).alias("lot"),
    )


def window_means(votes: DataFrame, length: str = MEAN_WINDOW, slide: str = MEAN_SLIDE,
                 panes: bool = True) -> DataFrame:
    """Mean vote per title in each sliding window.

    Votes are first summed in pieces that no window edge cuts, and the windows are
    put together from these, so a vote is not copied into every window it is in; on
    a stream a vote that comes late counts in all of its windows or in none. Without
    ``panes`` every vote is copied, which spares a stream the second state where
    hardly any title has two votes in a piece.
    """
    if panes:
        votes = votes.groupBy(F.window("ts", f"{common_seconds(length, slide)} seconds").alias("_time"), "title_id").agg(
            F.sum("rating").alias("_rating"), F.count("*").alias("_votes"))
    else:
        votes = votes.select(F.col("ts").alias("_time"), "title_id", F.col("rating").alias("_rating"),
                             F.lit(1).cast("bigint").alias("_votes"))
    return (
        votes.groupBy(F.window("_time", length, slide).alias("_w"), "title_id")
        .agg(F.sum("_rating").alias("_sum"), F.sum("_votes").alias("n_votes"))
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "title_id",
                (F.col("_sum") / F.col("n_votes")).alias("mean_vote"), "n_votes")
    )


def top_window_titles(means: DataFrame, titles: DataFrame, k: int = 3) -> DataFrame:
    """The k titles with the best mean in each window, ties by id (tables only).

    Titles that are not in the catalog take no place. Each task keeps k rows per
    window before the shuffle.
    """
    return ranked_titles(means.join(titles.select("title_id", "original_title"), "title_id"), k).select(
        "window_start", "window_end", "rank", "title_id", "original_title", "mean_vote")


def ranked_titles(named: DataFrame, k: int = 3) -> DataFrame:
    """The first k rows of each window with their rank."""
    order = Window.partitionBy("window_end").orderBy(F.desc("mean_vote"), "title_id")
    return named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def period_counts(votes: DataFrame, period: str = TREND_PERIOD) -> DataFrame:
    """Number of votes per title in each period."""
    return (
        votes.groupBy(F.window("ts", period).alias("_w"), "title_id").agg(F.count("*").alias("n_votes"))
        .select(F.col("_w.start").alias("period_start"), F.col("_w.end").alias("period_end"), "title_id", "n_votes")
    )


def rising_titles(votes: DataFrame, period: str = TREND_PERIOD) -> DataFrame:
    """Titles with more votes in a period than in the one before it.

    One window spans both periods, so the comparison is a plain aggregate and a
    stream needs no state beyond the window. A period without votes counts as 0.
    """
    length = F.expr(f"INTERVAL {period}")
    window = F.window("ts", _doubled(period), period).alias("_w")
    late = F.col("ts") >= F.col("_w.start") + length
    return (
        votes.select("ts", "title_id", window)
        .groupBy("_w", "title_id")
        .agg(F.count_if(late).alias("n_votes"), F.count_if(~late).alias("previous_votes"))
        .where(F.col("n_votes") > F.col("previous_votes"))
        .select((F.col("_w.start") + length).alias("period_start"), F.col("_w.end").alias("period_end"),
                "title_id", "n_votes", "previous_votes")
    )


def rising_titles_by_lag(counts: DataFrame) -> DataFrame:
    """The same answer from period counts, by looking one row back (tables only).

    The row before counts only if its period ends where this one starts.
    """
    order = Window.partitionBy("title_id").orderBy("period_start")
    adjacent = F.lag("period_end").over(order) == F.col("period_start")
    previous = F.when(adjacent, F.lag("n_votes").over(order)).otherwise(F.lit(0))
    return counts.withColumn("previous_votes", previous.cast("bigint")).where(
        F.col("n_votes") > F.col("previous_votes"))


def named_titles(rows: DataFrame, titles: DataFrame) -> DataFrame:
    """Add title names; rows of titles that are not in the catalog are dropped."""
    if rows.isStreaming:
        rows = from_state(rows)
    return rows.join(titles.select("title_id", "original_title"), "title_id")


def from_state(rows: DataFrame) -> DataFrame:
    """Rows that a stream's state hands over, for a join in which neither side goes through the driver.

    Their number is guessed from what came in the batch. The batch that closes windows brings
    no votes, so the guess is nothing at all, and all that is closed would be broadcast.
    """
    return rows.hint("merge")


def seconds(period: str) -> int:
    count, unit = period.split()
    return int(count) * _SECONDS[unit.removesuffix("s")]


def common_seconds(length: str, slide: str) -> int:
    """The longest period that divides both."""
    return math.gcd(seconds(length), seconds(slide))


def _doubled(period: str) -> str:
    count, unit = period.split()
    return f"{2 * int(count)} {unit}"
