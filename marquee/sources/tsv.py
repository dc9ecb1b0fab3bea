"""Scans of the tab-separated catalog files.

One header line per file, no quoting, ``\\N`` for null, codec by file extension.
A row with missing trailing fields is kept and the fields are null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.schema import CREDITS, PEOPLE, RATINGS, TITLES, as_text

# The file dialect.
DIALECT = {
    "sep": "\t",
    "header": "true",
    "quote": "",
    "escape": "",
    "nullValue": "\\N",
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
    "enforceSchema": "true",
}


def read_tsv(spark: SparkSession, path: str | list[str], schema: StructType, raw: bool = False,
             splits: int | None = None) -> DataFrame:
    """Read one kind of catalog file.

    ``raw`` keeps every column as text. ``splits`` spreads the rows of a codec that
    cannot be split, such as gzip, over that many partitions. Header lines left
    inside a concatenated file are dropped.
    """
    first = schema.fields[0].name
    reader = spark.read.options(**DIALECT).schema(as_text(schema) if raw else schema)
    rows = reader.csv(path).where(F.col(first) != first)
    return rows.repartition(splits) if splits else rows


def read_titles(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_tsv(spark, path, TITLES, **options)


def read_people(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_tsv(spark, path, PEOPLE, **options)


def read_credits(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_tsv(spark, path, CREDITS, **options)


def read_ratings(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_tsv(spark, path, RATINGS, **options)
