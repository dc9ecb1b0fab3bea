"""Helpers that the text operators share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: the space and the five control characters from tab to carriage return.
SPACES = " \t\n\v\f\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows are handed back in batches of about this many bytes, whatever the size of the batch read.
OUT_BYTES = 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and the text, a null text as an empty one; whatever else the table holds is left behind."""
    return df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def in_batches(rows: Iterator[tuple], schema: pa.Schema, weigh: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += weigh(row)
        if size >= OUT_BYTES:
            yield to_batch(held, schema)
            held, size = [], 0
    if held:
        yield to_batch(held, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def map_texts(df: DataFrame, id_col: str, text_col: str, each: Callable[[list[str]], list[list]],
              fields: dict[str, pa.DataType], slice_chars: int = 4 << 20) -> DataFrame:
    """One row per row of ``df``: its id and what ``each`` makes of its text.

    ``each`` gets a list of texts of about ``slice_chars`` bytes together and returns one
    list per field. It runs where the rows are; nothing is shuffled.
    """
    rows = id_and_text(df, id_col, text_col)
    types = ", ".join(f"`{name}` {spark_type(kind)}" for name, kind in fields.items())
    schema = f"id {rows.schema['id'].dataType.simpleString()}, {types}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, slice_chars):
                made = each(part.column("text").to_pylist())
                columns = [part.column("id"), *(pa.array(c, type=k) for c, k in zip(made, fields.values()))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", *fields])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def slices(batch: pa.RecordBatch, chars: int) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about so many bytes of text, of one row at least."""
    if not batch.num_rows:
        return
    step = max(1, math.ceil(batch.num_rows * chars / max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def spark_type(kind: pa.DataType) -> str:
    if pa.types.is_list(kind):
        return f"array<{spark_type(kind.value_type)}>"
    return {pa.int64(): "bigint", pa.int32(): "int", pa.float64(): "double", pa.bool_(): "boolean",
            pa.string(): "string", pa.binary(): "binary"}[kind]
