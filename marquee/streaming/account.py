"""Count what goes into a stream and what it drops, batch by batch."""

from __future__ import annotations

import threading
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

#: Name of the metrics that ``observed`` puts on a stream.
METRICS = "votes_in"


def observed(votes: DataFrame) -> DataFrame:
    """The same votes; on the way their number and first and last times are noted for each batch.

    It costs no further pass: the numbers are gathered as the rows go by.
    """
    return votes.observe(METRICS, F.count("*").alias("n_votes"), F.min("ts").alias("first"), F.max("ts").alias("last"))


@dataclass
class Batch:
    """One batch: votes that came, the oldest and newest of them, the watermark it ran with, and rows dropped for it.

    ``lateness`` is how far the oldest vote lies behind the watermark, in seconds; 0 where none does.
    """

    number: int
    n_votes: int
    first: datetime | None
    last: datetime | None
    watermark: datetime | None
    dropped: int

    @property
    def lateness(self) -> float:
        if self.first is None or self.watermark is None:
            return 0.0
        return max(0.0, (self.watermark - self.first).total_seconds())


@dataclass
class Account(StreamingQueryListener):
    """A listener that keeps a line per batch of the queries it is told to follow, or of all.

    ``keep`` lines are held, the last ones; sums are over all batches ever seen.
    """

    query_id: str | None = None
    keep: int = 10_000
    batches: list[Batch] = field(default_factory=list)
    n_votes: int = 0
    dropped: int = 0
    _lock: threading.Lock = field(default_factory=threading.Lock)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self.query_id not in (None, str(progress.id)):
            return
        seen = (progress.observedMetrics or {}).get(METRICS)
        dropped = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        batch = Batch(progress.batchId, seen.n_votes if seen else 0, _utc(seen.first) if seen else None,
                      _utc(seen.last) if seen else None, _parsed((progress.eventTime or {}).get("watermark")), dropped)
        with self._lock:
            self.batches = [*self.batches[1 - self.keep :], batch]
            self.n_votes += batch.n_votes
            self.dropped += dropped


def _utc(at: datetime | None) -> datetime | None:
    return at.astimezone(timezone.utc) if at else None


def _parsed(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


def follow(spark: SparkSession, query_id: str | None = None) -> Account:
    """Start an account of a session's queries; ``unfollow`` ends it."""
    account = Account(query_id)
    spark.streams.addListener(account)
    return account


def unfollow(spark: SparkSession, account: Account) -> None:
    spark.streams.removeListener(account)


def last_watermark(query: StreamingQuery) -> datetime | None:
    """Up to when a query's windows are closed, from its progress so far. None before its first vote."""
    marks = [_parsed(p["eventTime"].get("watermark")) for p in query.recentProgress if p.get("eventTime")]
    known = [m for m in marks if m and m.year > 1970]
    return max(known, default=None)
