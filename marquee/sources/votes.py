"""Vote streams and the stored vote lots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marquee.schema import LOGGED_VOTES


def parse_votes(lines: DataFrame, arrival: Column | None = None) -> DataFrame:
    """Votes from text lines ``title <tab> rating``; a line without both is dropped.

    The event time is ``arrival``, by default the column ``timestamp`` that the
    line source adds.
    """
    parts = F.split("value", "\t")
    return (
        lines.select(
            F.get(parts, F.lit(0)).alias("title_id"),
            F.expr("try_cast(get(split(value, '\t'), 1) AS BIGINT)").alias("rating"),
            (F.col("timestamp") if arrival is None else arrival).alias("ts"),
        )
        .where(F.col("title_id").isNotNull() & F.col("rating").isNotNull())
    )


def socket_votes(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Votes from a line socket. It cannot be replayed, so use it for trials only."""
    lines = (
        spark.readStream.format("socket")
        .option("host", host).option("port", port).option("includeTimestamp", True).load()
    )
    return parse_votes(lines)


def text_votes(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Votes from text files dropped into a folder, timed by when the file arrived."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(folder).select("value", F.col("_metadata.file_modification_time").alias("timestamp"))
    return parse_votes(lines)


def parquet_stream(spark: SparkSession, path: str, schema: StructType,
                   max_files: int | None = None) -> DataFrame:
    """A stream over Parquet files; ``max_files`` bounds one micro-batch.

    The last path element is given as a pattern, because a stream takes a plain
    path to be a folder while a pattern may also name a single file.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{folder}/{{{name}}}")


def lot_stream(spark: SparkSession, folder: str, fmt: str = "parquet", schema: StructType = LOGGED_VOTES,
               max_files: int | None = None) -> DataFrame:
    """The votes of all lots as a stream, in the files' order of arrival; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(_with_lot(schema))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _lots(reader, folder, fmt)


def _with_lot(schema: StructType) -> StructType:
    return StructType(schema.fields + [StructField("lot", StringType(), True)])


def _lots(reader, folder: str, fmt: str) -> DataFrame:
    if fmt == "csv":
        reader = reader.options(sep="\t", quote="", escape="", nullValue="\\N")
    return reader.format(fmt).load(folder)


def read_lots(spark: SparkSession, folder: str, fmt: str = "parquet",
              schema: StructType = LOGGED_VOTES) -> DataFrame:
    """All votes of all lots. ``lot`` is a partition column, so a filter on it prunes folders."""
    return _lots(spark.read.schema(_with_lot(schema)), folder, fmt)
