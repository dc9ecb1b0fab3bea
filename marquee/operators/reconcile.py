"""Hold what a stream has reported against the log of all votes.

A stream drops votes that come after their window was reported. The log has them all, so what
is missing from the reports is found by joining the two: late votes where the window is
closed, votes still to be reported where it is open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.trends import TREND_PERIOD, period_counts

KEY = ("period_start", "period_end", "title_id")


def vote_account(votes: DataFrame, reported: DataFrame, closed_until: Column, period: str = TREND_PERIOD) -> DataFrame:
    """Votes of each title and period: ``n_votes`` in the log, ``n_reported``, ``n_late`` and ``n_open``.

    ``votes`` is the log, ``reported`` what ``trends.period_counts`` gave on the stream, and
    ``closed_until`` the stream's last watermark: periods that end by then are closed. The log
    is counted before it is joined, by the key of the join. Reported, late and open votes are
    all votes. A report that the log knows nothing of has a negative number of late votes, so
    a log that lost votes shows as well.
    """
    seen = reported.select(*KEY, F.col("n_votes").alias("n_reported"))
    joined = period_counts(votes, period).join(seen, list(KEY), "full")
    n_votes, n_reported = (F.coalesce(c, F.lit(0)).cast("bigint") for c in ("n_votes", "n_reported"))
    missing, closed = n_votes - n_reported, F.col("period_end") <= closed_until
    none = F.lit(0).cast("bigint")
    return joined.select(*KEY, n_votes.alias("n_votes"), n_reported.alias("n_reported"),
                         F.when(closed, missing).otherwise(none).alias("n_late"),
                         F.when(closed, none).otherwise(missing).alias("n_open"))


def corrections(account: DataFrame) -> DataFrame:
    """What has to be reported again, with its right number of votes: closed periods that late votes belong to."""
    return account.where("n_late <> 0").select(*KEY, "n_votes", (F.col("n_votes") - F.col("n_late")).alias("was_reported"))


def unreported_votes(votes: DataFrame, reported: DataFrame, closed_until: Column, period: str = TREND_PERIOD) -> DataFrame:
    """The votes themselves, where a closed period of a title was not reported at all."""
    window = F.window("ts", period)
    placed = votes.withColumns({"period_start": window.start, "period_end": window.end}).where(
        F.col("period_end") <= closed_until)
    return placed.join(reported.select(*KEY), list(KEY), "left_anti").select(*votes.columns)


def totals(account: DataFrame) -> DataFrame:
    """One row with the sums of all periods and titles."""
    return account.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_votes", "n_reported", "n_late", "n_open")])
