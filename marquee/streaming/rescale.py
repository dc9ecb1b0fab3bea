"""Let a stream go on with another number of state partitions.

The number is fixed when a stream first starts. To change it, the stream is stopped, and a new
one starts from what the old one's checkpoint says: the state of every key, the place in its
source, and up to when its periods are closed. Votes are counted by the engine; the counts
that were held are added up with the new votes. The old checkpoint is only read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.trends import TREND_PERIOD, seconds
from marquee.session import new_folder
from marquee.sources.once import rows_once
from marquee.sources.tables import files


def period_counts(votes: DataFrame, period: str = TREND_PERIOD, held: DataFrame | None = None,
                  closed_until: int = 0) -> DataFrame:
    """Number of votes per title in each period, as ``trends.period_counts`` gives it, from state that can be handed over.

    ``votes`` is a stream with a watermark on ``ts``. ``held`` (``held_votes``) and
    ``closed_until`` (milliseconds, ``last_batch``) are what an earlier stream left; the held
    counts come in with the first batch, and not again when this stream is started anew. The number
    of state partitions is the session's number of shuffle partitions at the first start.
    """
    at, length = F.unix_seconds("ts"), seconds(period)
    # A vote of a period that was closed when the stream was handed over is late.
    still_open = 1000 * (at - F.pmod(at, F.lit(length)) + length) > closed_until
    counted = votes.where(still_open).select("title_id", "ts", F.lit(1).cast("bigint").alias("n_votes"))
    if held is not None:
        folder = new_folder(votes.sparkSession, "held")
        held.write.parquet(folder)
        left = rows_once(votes.sparkSession, folder, held.schema)
        counted = counted.union(left.select("title_id", F.timestamp_seconds("start").alias("ts"), "n_votes"))
    return (
        counted.groupBy(F.window("ts", period).alias("period"), "title_id").agg(F.sum("n_votes").alias("n_votes"))
        .select(F.col("period.start").alias("period_start"), F.col("period.end").alias("period_end"), "title_id", "n_votes")
    )


@dataclass(frozen=True)
class LastBatch:
    """The last batch that a checkpoint has committed: its watermark in milliseconds, and its place in each source."""

    number: int
    closed_until: int
    places: list[str]


def last_batch(spark: SparkSession, checkpoint: str) -> LastBatch:
    """Where a stopped stream ended. A batch that was begun and not committed is none."""
    number = max(_numbers(spark, f"{checkpoint}/commits"), default=None)
    if number is None:
        raise ValueError(f"{checkpoint} has no finished batch")
    _, about, *places = spark.read.text(f"{checkpoint}/offsets/{number}", wholetext=True).first().value.split("\n")
    return LastBatch(number, int(json.loads(about)["batchWatermarkMs"]), places)


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    store, path = files(spark, folder)
    names = [s.getPath().getName() for s in store.listStatus(path)] if store.exists(path) else []
    return [int(n) for n in names if n.isdigit()]


def held_votes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``title_id``, ``start`` and ``n_votes`` of every open period that a ``period_counts`` stream holds.

    Read as a table from the state of its last batch, partition by partition.
    """
    state = spark.read.format("statestore").option("batchId", last_batch(spark, checkpoint).number).load(checkpoint)
    return state.select("key.title_id", F.unix_seconds("key.window.start").alias("start"), F.col("value.sum").alias("n_votes"))
