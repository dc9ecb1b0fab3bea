"""Streams that keep state of their own per key.

Votes are counted per period first, by the engine, so a key's state sees one row per title and
period and not one per vote. State is looked up by key; how much there is follows the keys that
are active, since a timer clears what nobody will ask for again.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import chain
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from marquee.operators.trends import TREND_PERIOD, from_state, seconds


class LastPeriod(StatefulProcessor):
    """Holds each title's last period and its votes, and passes on periods that had more than the one before.

    A period without votes clears a title: a timer runs out when the watermark passes the end
    of the period after the last one. What is held for any other period counts as 0 votes.
    """

    def __init__(self, period: int):
        self.period = period

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "start bigint, n_votes bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        start, before = self.last.get() if self.last.exists() else (None, 0)
        # Several periods may end in one batch, in any order.
        for row in sorted(rows, key=lambda r: r.start):
            previous = before if start == row.start - self.period else 0
            if row.n_votes > previous:
                yield Row(title_id=row.title_id, start=row.start, n_votes=row.n_votes, previous_votes=previous)
            start, before = row.start, row.n_votes
        self.last.update((start, before))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(1000 * (start + 2 * self.period))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.last.clear()
        return iter(())


def rising_titles(votes: DataFrame, period: str = TREND_PERIOD) -> DataFrame:
    """Titles with more votes in a period than in the one before, as ``trends.rising_titles`` gives them.

    ``votes`` is a stream with a watermark on ``ts``. Two states follow each other: open
    periods, then the last finished period of each active title, which is all that is held of
    the past. ``trends.rising_titles`` holds every period twice instead, in two windows.
    """
    kind = votes.schema["title_id"].dataType.simpleString()
    counts = (
        votes.groupBy(F.window("ts", period).alias("_w"), "title_id").agg(F.count("*").alias("n_votes"))
        .select("title_id", F.window_time("_w").alias("_at"), F.unix_seconds("_w.start").alias("start"), "n_votes")
    )
    rising = counts.groupBy("title_id").transformWithState(
        LastPeriod(seconds(period)), f"title_id {kind}, start bigint, n_votes bigint, previous_votes bigint",
        "Append", "EventTime")
    return rising.select(
        F.timestamp_seconds("start").alias("period_start"), F.timestamp_seconds(F.col("start") + seconds(period)).alias("period_end"),
        "title_id", "n_votes", "previous_votes")


class BestOfPart(StatefulProcessor):
    """Holds the k best titles of one part of a window and hands them over once the window is closed.

    Means that come when their window is closed, as from a grouping that gives finished
    windows, are handed over at once and never stored.
    """

    def __init__(self, k: int, columns: str):
        self.k = k
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", self.columns)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = list(self.best.get()) if self.best.exists() else []
        came = ((r.mean_vote, r.title_id, r.original_title) for r in rows)
        # A heap of k rows, however many come.
        best = [tuple(r) for r in heapq.nsmallest(self.k, chain(held, came), key=lambda r: (-r[0], r[1]))]
        if timerValues.getCurrentWatermarkInMs() < 1000 * key[0]:
            self.best.put(best)
            self.handle.registerTimer(1000 * key[0])
            return
        if held:
            self.best.clear()
            self.handle.deleteTimer(1000 * key[0])
        yield from self._rows(key, best)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        best = list(self.best.get())
        self.best.clear()
        yield from self._rows(key, best)

    def _rows(self, key: Any, best: list) -> Iterator[Row]:
        return (Row(end=key[0], mean_vote=mean, title_id=title, original_title=name) for mean, title, name in best)


def best_of_parts(means: DataFrame, titles: DataFrame, k: int = 3, parts: int = 16) -> DataFrame:
    """Of every finished window the ``k`` best titles of each of ``parts`` parts: ``window_end`` and the columns of a report.

    ``means`` are the window means of a stream with a watermark, ``titles`` a table of names;
    titles without one take no place. A title's part is a hash of its id, so a window is spread
    over many tasks and none holds more than ``k`` rows a part. The best of the window are among
    the best of its parts. A mean that is null takes no place.
    """
    kind = means.schema["title_id"].dataType.simpleString()
    columns = f"mean_vote double, title_id {kind}, original_title string"
    named = from_state(means.where("mean_vote IS NOT NULL")).join(titles.select("title_id", "original_title"), "title_id").select(
        F.unix_seconds("window_end").alias("end"), F.pmod(F.xxhash64("title_id"), F.lit(parts)).cast("int").alias("part"),
        "title_id", "original_title", "mean_vote")
    best = named.groupBy("end", "part").transformWithState(
        BestOfPart(k, columns), f"end bigint, {columns}", "Append", "EventTime")
    return best.select(F.timestamp_seconds("end").alias("window_end"), "title_id", "original_title", "mean_vote")
