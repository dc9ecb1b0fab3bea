"""A join that stays even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join many rows per key to one row per key.

    Adaptive execution splits a hot partition, and measures whether ``lookup`` is
    small enough to broadcast, only where a side comes straight from a shuffle. A
    lookup made by a join or a grouping on the same key would not. The hash as a
    second key gives it a shuffle of its own; the facts are shuffled once either
    way.
    """
    second = F.xxhash64(key)
    return (
        facts.withColumn("_hash", second)
        .join(lookup.withColumn("_hash", second), [key, "_hash"], how)
        .drop("_hash")
    )
