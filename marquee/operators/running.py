"""Running totals over a table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import shared_dir


def running_total(df: DataFrame, order_by: list[str], weight: str, out: str = "running",
                  ranges: int | None = None) -> DataFrame:
    """The sum of ``weight`` over all rows up to and including each row.

    The rows are cut into key ranges and checkpointed, so the ranges stay fixed
    for both uses below. Each range adds up its own rows, and the sum of all
    earlier ranges is added to them. The only broadcast table has one row per
    range. ``order_by`` is a unique key; a null weight counts as 0.
    """
    shared_dir(df.sparkSession)
    cut = df.repartitionByRange(ranges, *order_by) if ranges else df.repartitionByRange(*order_by)
    ranged = cut.withColumn("_range", F.spark_partition_id()).checkpoint()
    added = F.coalesce(F.col(weight), F.lit(0)).cast("bigint")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range").agg(F.sum(added).alias("_sum"))
        .select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_range").orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.withColumn("_within", F.sum(added).over(inside))
        .join(F.broadcast(offsets), "_range")
        .withColumn(out, F.col("_before") + F.col("_within"))
        .drop("_range", "_before", "_within")
    )
