"""Put rows into a catalog table without rewriting it.

A put writes only its own rows, as a numbered folder beside the versions of the table,
bucketed and sorted like it. Who reads the table takes the stored rows and, of what was put
since, the last value of each column. Compaction merges the puts into the next version; the
version's name says up to which put, so a reader never counts a put twice or misses one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.operators.upsert import one_row_per_key, upsert
from marquee.sources import tables

PUT = "put_no"


def put_rows(spark: SparkSession, name: str, updates: DataFrame, key: str, order: str | None = None) -> int:
    """Store rows under the next number and return it. What a put leaves null keeps its value.

    Of rows that share a key one counts, as in ``upsert``. The rows are shuffled into the
    table's buckets; nothing that is stored is read. They are there for readers all at once,
    when their folder gets its name. Columns that the table does not have are refused.
    """
    folder, schema = tables.table_folder(spark, name), spark.table(name).schema
    unknown = set(updates.columns) - set(schema.names) - {order}
    if unknown:
        raise ValueError(f"{name} has no columns {sorted(unknown)}")
    one = one_row_per_key(updates, key, order) if set(updates.columns) > {key, order} - {None} else updates.select(key).distinct()
    rows = one.select(*[
        (_typed(F.col(f.name), one.schema[f.name].dataType, f.dataType) if f.name in one.columns
         else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
    buckets = tables.versions(spark, folder)[-1][1]
    writing, written = f"{name}_{uuid.uuid4().hex}", f"{folder}/_{uuid.uuid4().hex}"
    rows.write.format("parquet").option("path", written).bucketBy(buckets, key).sortBy(key).saveAsTable(writing)
    spark.sql(f"DROP TABLE {writing}")
    return tables.add_put(spark, folder, written)


def _typed(value: Column, given, wanted) -> Column:
    """A value as the table has it; of a family the columns that are not given are null."""
    if not (isinstance(given, StructType) and isinstance(wanted, StructType)):
        return value.cast(wanted)
    names = set(given.names)
    fields = [(_typed(value[f.name], given[f.name].dataType, f.dataType) if f.name in names
               else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def puts_since(spark: SparkSession, name: str, key: str) -> DataFrame | None:
    """What was put after the table's present version, with the number of each put. None where nothing was.

    A bucketed table like the stored one, so neither a merge with it nor a lookup has to
    read or move more than its buckets.
    """
    folder = tables.table_folder(spark, name)
    numbers = tables.puts_after(spark, folder)
    if not numbers:
        return None
    beside = f"{name}_puts"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(name).schema.fields)
    buckets = tables.versions(spark, folder)[-1][1]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {beside} ({columns}, {PUT} BIGINT) USING parquet PARTITIONED BY ({PUT}) "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{tables.puts_folder(folder)}'")
    known = {int(r.partition.rpartition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {beside}").collect()}
    new, gone = set(numbers) - known, known - set(tables.put_numbers(spark, folder))
    if new:
        spark.sql(f"ALTER TABLE {beside} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({PUT}={n})" for n in sorted(new)))
    for number in gone:
        spark.sql(f"ALTER TABLE {beside} DROP IF EXISTS PARTITION ({PUT}={number})")
    return spark.table(beside).where((F.col(PUT) >= numbers[0]) & (F.col(PUT) <= numbers[-1]))


def folded(puts: DataFrame, key: str) -> DataFrame:
    """One row per key: of every column, and every column of a family, the value of the last put that gave one."""
    fields = [f for f in puts.schema.fields if f.name not in (key, PUT)]
    return puts.groupBy(key).agg(*[_last(F.col(f.name), f.dataType).alias(f.name) for f in fields])


def _last(value: Column, kind) -> Column:
    if not isinstance(kind, StructType):
        return F.max_by(value, F.when(value.isNotNull(), F.col(PUT)))
    family = F.struct(*[_last(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    return F.when(F.max(value.isNotNull()), family)


def bloom_filter(key: str) -> dict[str, str]:
    """Options that give every row group of a version a filter over its keys, sized by their number.

    Puts go without: a filter has 64 KB at least, and a put may be one row.
    """
    return {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def read_table(spark: SparkSession, name: str, key: str, wanted: Column | None = None,
               up_to: int | None = None) -> DataFrame:
    """The rows of a table with all puts, or those ``up_to`` a number.

    ``wanted`` is a condition on the key, which both sides are read by.

    Without puts it is the stored table. With some, stored rows and puts meet bucket by bucket.
    """
    tables.switch_to_latest(spark, name)
    puts, stored = puts_since(spark, name, key), spark.table(name)
    if puts is not None and up_to is not None:
        puts = puts.where(F.col(PUT) <= up_to)
    if wanted is not None:
        puts, stored = puts if puts is None else puts.where(wanted), stored.where(wanted)
    return stored if puts is None else upsert(stored, folded(puts, key), key)


def get_row(spark: SparkSession, name: str, key: str, value: Any) -> DataFrame:
    """The row of one key as it is now, or no row. One bucket of the table and one of each put are read."""
    return read_table(spark, name, key, F.col(key) == F.lit(value))


def get_rows(spark: SparkSession, name: str, key: str, values: Iterable[Any]) -> DataFrame:
    """The rows of a list of keys as they are now; a key that is not there has no row.

    Only the buckets of the keys are read, and in them only the row groups whose range, and
    for up to ``spark.sql.parquet.pushdown.inFilterThreshold`` keys whose bloom filter, may
    hold one. The list goes with the plan, so it is for pages and not for joins: more than a
    few thousand keys belong in a table and a join.
    """
    values = list(dict.fromkeys(values))
    return read_table(spark, name, key, F.col(key).isin(values) if values else F.lit(False))
