"""Catalog tables stored for joins by title that move nothing.

Credits, titles and ratings are stored in equal buckets of the title id, sorted by it, so they
are joined bucket by bucket. A title with so many credits that its bucket would be far larger
than the others is hot: its credits lie in a table of their own, in as many files as they need,
and meet the few hot titles, whose number is bounded by that of the buckets, as a broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.scalars import ACTING_CATEGORIES
from marquee.operators.credits import acting_credits, rated_titles
from marquee.sources.tables import drop_table, table_root

KEY = "title_id"


@dataclass(frozen=True)
class Catalog:
    """The names of the stored tables."""

    name: str

    @property
    def credits(self) -> str:
        return f"{self.name}_credits"

    @property
    def titles(self) -> str:
        return f"{self.name}_titles"

    @property
    def ratings(self) -> str:
        return f"{self.name}_ratings"

    @property
    def hot(self) -> str:
        return f"{self.name}_hot"

    @property
    def hot_titles(self) -> str:
        return f"{self.name}_hot_titles"


def hot_titles(credits: DataFrame, buckets: int) -> DataFrame:
    """Titles with more credits than half a bucket's share of all; there are fewer than two a bucket."""
    total = credits.count()
    return credits.groupBy(KEY).agg(F.count("*").alias("n")).where(F.col("n") * (2 * buckets) > total).select(KEY)


def store_catalog(spark: SparkSession, name: str, credits: DataFrame, titles: DataFrame, ratings: DataFrame,
                  buckets: int | None = None) -> Catalog:
    """Write the tables of a catalog, one file per bucket, and return their names.

    All rows are shuffled here, once; joins by title then move none of them. ``buckets`` is by
    default the session's number of shuffle partitions. ``titles`` and ``ratings`` have one
    row per title. A credit without a title joins nothing and is not stored.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    catalog, credits = Catalog(name), credits.where(F.col(KEY).isNotNull())
    _plain(spark, catalog.hot_titles, hot_titles(credits, buckets).coalesce(1))
    hot = spark.table(catalog.hot_titles).withColumn("_hot", F.lit(True))
    marked = credits.join(F.broadcast(hot), KEY, "left")  # fewer than 2 * buckets titles
    _bucketed(spark, catalog.credits, marked.where(F.col("_hot").isNull()).drop("_hot"), buckets)
    _bucketed(spark, catalog.titles, titles, buckets)
    _bucketed(spark, catalog.ratings, ratings, buckets)
    _plain(spark, catalog.hot, marked.where(F.col("_hot")).drop("_hot"))
    return catalog


def _plain(spark: SparkSession, table: str, rows: DataFrame) -> None:
    rows.write.format("parquet").option("path", f"{table_root(spark)}/{table}").saveAsTable(table)


def _bucketed(spark: SparkSession, table: str, rows: DataFrame, buckets: int) -> None:
    rows.repartition(buckets, KEY).write.format("parquet").option("path", f"{table_root(spark)}/{table}").bucketBy(
        buckets, KEY).sortBy(KEY).saveAsTable(table)


def drop_catalog(spark: SparkSession, catalog: Catalog) -> None:
    """Forget the tables; their files stay for readers that still hold them."""
    for table in (catalog.credits, catalog.titles, catalog.ratings, catalog.hot, catalog.hot_titles):
        drop_table(spark, table)


def stored_rated_titles(spark: SparkSession, catalog: Catalog,
                        acting: tuple[str, ...] = ACTING_CATEGORIES) -> DataFrame:
    """One row per acting credit of a rated title, as ``credits.credited_rated_titles`` gives them, without a shuffle."""
    rated = rated_titles(spark.table(catalog.titles), spark.table(catalog.ratings))
    names = ("title_id", "person_id", "original_title", "rating")
    spread = acting_credits(spark.table(catalog.credits), acting).join(rated.hint("merge"), KEY).select(*names)
    few = rated.join(F.broadcast(spark.table(catalog.hot_titles)), KEY, "left_semi")  # fewer than 2 * buckets titles
    hot = acting_credits(spark.table(catalog.hot), acting).join(F.broadcast(few), KEY)
    return spread.unionByName(hot.select(*names))


def stored_title_best(spark: SparkSession, catalog: Catalog,
                      acting: tuple[str, ...] = ACTING_CATEGORIES) -> DataFrame:
    """The best rating per person and title name; the only shuffle is that of the grouping, after the partial maximum."""
    return stored_rated_titles(spark, catalog, acting).groupBy("person_id", "original_title").agg(
        F.max("rating").alias("rating"))
