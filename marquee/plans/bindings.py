"""The benchmark tables in the roles of the engine (FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from marquee.functions import utc_instant
from marquee.sources import roles
from marquee.sources.votes import parquet_stream

# Which return flags stand for acting, and the window lengths that
# suit events about four minutes apart.
ACTING = ("A", "R")
MEAN_WINDOW = "10 hours"
MEAN_SLIDE = "1 hour"
LOT = "1 day"
PERIOD = "1 day"
DELAY = "10 minutes"

_EVENTS = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()),
    StructField("event_type", StringType()),
    StructField("value", DoubleType()),
    StructField("props", StringType()),
])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_credits(spark: SparkSession, folder: str) -> DataFrame:
    return roles.credits(table(spark, folder, "lineitem"), "l_orderkey", "l_suppkey", "l_returnflag")


def part_credits(spark: SparkSession, folder: str) -> DataFrame:
    return roles.credits(table(spark, folder, "lineitem"), "l_partkey", "l_suppkey", "l_returnflag")


def titles(spark: SparkSession, folder: str) -> DataFrame:
    return roles.titles(table(spark, folder, "part"), "p_partkey", "p_name", genres=F.split("p_name", " "))


def people(spark: SparkSession, folder: str) -> DataFrame:
    return roles.people(table(spark, folder, "supplier"), "s_suppkey", "s_name", "s_nationkey",
                        F.nullif(F.col("s_nationkey"), F.lit(0)))


def part_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Part size both as a title's rating and as its number of votes."""
    return roles.ratings(table(spark, folder, "part"), "p_partkey", F.col("p_size").cast("double"), "p_size")


def stored_ratings(spark: SparkSession, folder: str) -> DataFrame:
    closed = table(spark, folder, "lineitem").where("l_linestatus = 'F'")
    sums = closed.groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("s"), F.count("*").alias("n"))
    return roles.ratings(sums, "l_partkey", F.col("s") / F.col("n"), "n")


def new_votes(spark: SparkSession, folder: str) -> DataFrame:
    open_lines = table(spark, folder, "lineitem").where("l_linestatus = 'O'")
    return roles.votes(open_lines, "l_partkey", "l_quantity", ts=None)


def as_votes(events: DataFrame) -> DataFrame:
    """Events as votes; their times have no zone and are UTC."""
    return roles.votes(events, "user_id", F.round(F.col("value") * 100), utc_instant(F.col("ts")))


def event_votes(spark: SparkSession, folder: str) -> DataFrame:
    return as_votes(table(spark, folder, "events"))


def event_vote_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    return as_votes(parquet_stream(spark, f"{folder}/events.parquet", _EVENTS, max_files))


def stream_titles(spark: SparkSession, folder: str) -> DataFrame:
    return roles.titles(table(spark, folder, "customer"), "c_custkey", "c_name")


def vote_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """The value of each event, in cents, as the number of a vote."""
    return table(spark, folder, "events").select(
        "event_id", F.round(F.col("value") * 100).cast("bigint").alias("point"))
