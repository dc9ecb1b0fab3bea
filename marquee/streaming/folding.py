"""Fold vote lots into mean ratings, each once.

A stream over the folder of lots sums up what is new and adds it to a ledger: a folder per
batch with the sums of its titles. A batch that ran before and was not noted as done finds its
folder finished and leaves it, so every vote counts once however often the job is killed. The
stored ratings are never changed; the present ones are they and the ledger. What a batch costs
follows its lots and not all lots there ever were. From time to time the ledger is summed up,
so that a reader opens few files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from marquee.operators.ratings import merge_ratings, vote_totals
from marquee.schema import LOGGED_VOTES
from marquee.sources.tables import delete_folder, files
from marquee.sources.votes import lot_stream
from marquee.streaming.runner import trigger

_BATCH = re.compile(r"batch-(\d{10})")
_SUMMED = re.compile(r"summed-(\d{10})")


def fold_lots(spark: SparkSession, lots: str, ledger: str, checkpoint: str, every: str | None = None,
              fmt: str = "parquet", schema: StructType = LOGGED_VOTES, max_files: int | None = None) -> StreamingQuery:
    """Add the votes of new files of the lots to the ledger.

    Files are told apart by name, so a file that is added to an old lot counts too. The
    checkpoint knows which files a batch has; the ledger, which batches are in it. They belong
    together. Without ``every`` the query handles what is there and stops.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        folder = f"{ledger}/batch-{batch_id:010}"
        if not _finished(spark, folder) and batch_id > summed_up_to(spark, ledger):
            vote_totals(batch).write.mode("overwrite").parquet(folder)

    stream = lot_stream(spark, lots, fmt, schema, max_files)
    return (
        stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add).trigger(**trigger(every)).start()
    )


def _finished(spark: SparkSession, folder: str) -> bool:
    store, path = files(spark, f"{folder}/_SUCCESS")
    return bool(store.exists(path))


def _finished_numbers(spark: SparkSession, ledger: str, pattern: re.Pattern) -> list[tuple[int, str]]:
    store, path = files(spark, ledger)
    if not store.exists(path):
        return []
    names = [s.getPath().getName() for s in store.listStatus(path)]
    found = [(int(m[1]), f"{ledger}/{n}") for n in names if (m := pattern.fullmatch(n))]
    return sorted((n, folder) for n, folder in found if _finished(spark, folder))


def summed_up_to(spark: SparkSession, ledger: str) -> int:
    """The last batch that is in a finished sum, or -1."""
    return max((n for n, _ in _finished_numbers(spark, ledger, _SUMMED)), default=-1)


def ledger_totals(spark: SparkSession, ledger: str, like: StructType = LOGGED_VOTES) -> DataFrame:
    """Sum and number of votes per title over all finished batches. ``like`` has the type of ``title_id``."""
    folders = _ledger_folders(spark, ledger)
    kind = like["title_id"].dataType.simpleString()
    schema = f"title_id {kind}, vote_sum bigint, vote_count bigint"
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders).groupBy("title_id").agg(
        F.sum("vote_sum").alias("vote_sum"), F.sum("vote_count").alias("vote_count"))


def _ledger_folders(spark: SparkSession, ledger: str) -> list[str]:
    summed = _finished_numbers(spark, ledger, _SUMMED)[-1:]
    last = summed[0][0] if summed else -1
    return [f for _, f in summed] + [f for n, f in _finished_numbers(spark, ledger, _BATCH) if n > last]


def sum_up(spark: SparkSession, ledger: str, like: StructType = LOGGED_VOTES, keep: int = 1) -> int:
    """Write the sums of all finished batches to one folder and return the last batch in it, or -1.

    Folders that are older than the sum before, ``keep`` sums back, are deleted: readers that
    took them from a listing have had that long. A sum that was cut off is written anew.
    """
    batches = _finished_numbers(spark, ledger, _BATCH)
    last = max([n for n, _ in batches] + [summed_up_to(spark, ledger)], default=-1)
    if last > summed_up_to(spark, ledger):
        ledger_totals(spark, ledger, like).write.mode("overwrite").parquet(f"{ledger}/summed-{last:010}")
    sums = _finished_numbers(spark, ledger, _SUMMED)
    for number, folder in sums[: -keep - 1]:
        delete_folder(spark, folder)
    if len(sums) > keep:
        for number, folder in batches:
            if number <= sums[-keep - 1][0]:
                delete_folder(spark, folder)
    return last


def folded_ratings(spark: SparkSession, stored: DataFrame, ledger: str) -> DataFrame:
    """Stored means with every vote of the ledger added, as ``merge_ratings`` adds them."""
    return merge_ratings(stored, ledger_totals(spark, ledger, stored.schema))
