"""Store rows in a catalog table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.operators.upsert import upsert
from marquee.sinks.puts import bloom_filter, read_table
from marquee.sources import tables


def upsert_table(spark: SparkSession, name: str, updates: DataFrame, key: str, order: str | None = None) -> str:
    """Merge rows into a table by key; see ``upsert`` for ``order``.

    The new state is written beside the table's versions and becomes the next one once the
    write is complete, so readers never see half of it and a lost job leaves the old state in
    place. If another writer has finished a version since this one read, the rows are merged
    again into that. Stored and new rows meet bucket by bucket: only the updates are
    shuffled, and each task writes the bucket it has merged. What was put since the last
    version is merged too, before the updates. Returns the new folder.
    """
    return _next_version(spark, name, key, lambda rows: upsert(rows, updates, key, order))


def compact(spark: SparkSession, name: str, key: str) -> str | None:
    """Merge what was put into the next version and return its folder. Without puts nothing is written."""
    if not tables.puts_after(spark, tables.table_folder(spark, name)):
        return None
    return _next_version(spark, name, key, lambda rows: rows)


def _next_version(spark: SparkSession, name: str, key: str, change: Callable[[DataFrame], DataFrame]) -> str:
    folder = tables.table_folder(spark, name)
    while True:
        number, buckets, _ = tables.switch_to_latest(spark, name)
        waiting = tables.puts_after(spark, folder)
        puts = waiting[-1] if waiting else tables.merged_puts(spark, folder)
        target = read_table(spark, name, key, up_to=puts)
        writing = f"{name}_{uuid.uuid4().hex}"
        written = f"{folder}/_{uuid.uuid4().hex}"
        merged = change(target).select(*target.columns)
        (
            merged.write.format("parquet").option("path", written).options(**bloom_filter(key))
            .bucketBy(buckets, key).sortBy(key).saveAsTable(writing)
        )
        spark.sql(f"DROP TABLE {writing}")
        if tables.add_version(spark, folder, written, number + 1, buckets, puts):
            break
        tables.delete_folder(spark, written)
    tables.switch_to_latest(spark, name)
    return f"{folder}/{tables.version_name(number + 1, buckets, puts)}"
