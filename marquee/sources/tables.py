"""Catalog tables: create, drop, scan one column family, look one key up."""

from __future__ import annotations

import re
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

_VERSION = re.compile(r"v(\d{8})-b(\d+)(?:-p(\d+))?")
_PUT = re.compile(r"put_no=(\d+)")

_TITLE_DETAILS = StructType([
    StructField("title_type", StringType()),
    StructField("primary_title", StringType()),
    StructField("original_title", StringType()),
    StructField("is_adult", IntegerType()),
    StructField("start_year", IntegerType()),
    StructField("end_year", IntegerType()),
    StructField("runtime_minutes", IntegerType()),
    StructField("genres", ArrayType(StringType())),
])

TITLE_TABLE = StructType([
    StructField("title_id", StringType()),
    StructField("details", _TITLE_DETAILS),
])

PERSON_TABLE = StructType([
    StructField("person_id", StringType()),
    StructField("details", StructType([
        StructField("name", StringType()),
        StructField("birth", IntegerType()),
        StructField("death", IntegerType()),
    ])),
    StructField("movies", StructType([
        StructField("total", IntegerType()),
        StructField("top3", ArrayType(StringType())),
    ])),
])


def table_root(spark: SparkSession) -> str:
    """The folder that tables lie in unless they are given one: the session's warehouse."""
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def files(spark: SparkSession, path: str):
    """The store that holds a path, and the path in its terms."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def versions(spark: SparkSession, folder: str) -> list[tuple[int, int, str]]:
    """Number, buckets and folder of each version of a table, oldest first."""
    store, path = files(spark, folder)
    if not store.exists(path):
        return []
    names = [s.getPath().getName() for s in store.listStatus(path)]
    found = [(_VERSION.fullmatch(n), n) for n in names]
    return sorted((int(m[1]), int(m[2]), f"{folder}/{n}") for m, n in found if m)


def version_name(number: int, buckets: int, puts: int = 0) -> str:
    """``puts`` is the last put that is merged into the version."""
    return f"v{number:08d}-b{buckets}" + (f"-p{puts}" if puts else "")


def add_version(spark: SparkSession, folder: str, written: str, number: int, buckets: int, puts: int = 0) -> bool:
    """Make a folder of finished files the given version. False where that number is there already."""
    store, target = files(spark, f"{folder}/{version_name(number, buckets, puts)}")
    latest = versions(spark, folder)
    if latest and latest[-1][0] >= number:
        return False
    return bool(store.rename(files(spark, written)[1], target))


def puts_folder(folder: str) -> str:
    return f"{folder}/puts"


def put_numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of all puts whose folders are there."""
    store, path = files(spark, puts_folder(folder))
    if not store.exists(path):
        return []
    found = (_PUT.fullmatch(s.getPath().getName()) for s in store.listStatus(path))
    return sorted(int(m[1]) for m in found if m)


def merged_puts(spark: SparkSession, folder: str) -> int:
    """The last put that the latest version holds, or 0."""
    return int(_VERSION.fullmatch(versions(spark, folder)[-1][2].rpartition("/")[2])[3] or 0)


def puts_after(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the puts that the latest version does not hold yet."""
    last = merged_puts(spark, folder)
    return [n for n in put_numbers(spark, folder) if n > last]


def add_put(spark: SparkSession, folder: str, written: str) -> int:
    """Make a folder of finished files the next put and return its number."""
    store, parent = files(spark, puts_folder(folder))
    store.mkdirs(parent)
    while True:
        number = max([merged_puts(spark, folder), *put_numbers(spark, folder)]) + 1
        target = files(spark, f"{puts_folder(folder)}/put_no={number}")[1]
        if not store.exists(target) and store.rename(files(spark, written)[1], target):
            return number


def delete_folder(spark: SparkSession, folder: str) -> None:
    store, path = files(spark, folder)
    store.delete(path, True)


def table_folder(spark: SparkSession, name: str) -> str:
    """The folder that holds all versions of a table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return described.data_type.rpartition("/")[0]


def _register(spark: SparkSession, name: str, schema: StructType, key: str, buckets: int, location: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{location}'"
    )


def create_table(spark: SparkSession, name: str, schema: StructType, key: str | None = None,
                 buckets: int | None = None, location: str | None = None) -> bool:
    """Create an empty Parquet table unless it exists. True where it was created.

    Rows are bucketed and sorted by ``key``, by default the first column. A merge
    then leaves the stored rows where they are and moves only the updates, and a
    lookup opens one bucket. ``buckets`` is fixed for the life of the table, by
    default the session's number of shuffle partitions. The table's folder is
    ``location``, by default a new one in the warehouse; each version is a folder
    in it.
    """
    key = key or schema.fields[0].name
    if spark.catalog.tableExists(name) or location and open_table(spark, name, schema, location, key):
        return False
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = location or f"{table_root(spark)}/{name.replace('.', '-')}-{uuid.uuid4().hex}"
    first = f"{folder}/{version_name(0, buckets)}"
    store, path = files(spark, first)
    store.mkdirs(path)
    _register(spark, name, schema, key, buckets, first)
    return True


def open_table(spark: SparkSession, name: str, schema: StructType, location: str, key: str | None = None) -> bool:
    """Make a table that lies in a folder known to the session. False where there is none."""
    found = versions(spark, location)
    if not found:
        return False
    _register(spark, name, schema, key or schema.fields[0].name, found[-1][1], found[-1][2])
    return True


def switch_to_latest(spark: SparkSession, name: str) -> tuple[int, int, str]:
    """Number, buckets and folder of the latest version; the table is switched to it where another writer left one."""
    number, buckets, path = versions(spark, table_folder(spark, name))[-1]
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    if described.data_type.rpartition("/")[2] != path.rpartition("/")[2]:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return number, buckets, path


def drop_table(spark: SparkSession, name: str, delete: bool = False) -> bool:
    """Drop a table if it is there. Its files stay for readers that still hold them, unless ``delete`` is set."""
    if not spark.catalog.tableExists(name):
        return False
    folder = table_folder(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}_puts")
    if delete:
        delete_folder(spark, folder)
    return True


def clean_versions(spark: SparkSession, name: str, keep: int = 2) -> int:
    """Delete all versions of a table but the last ``keep``, one at least; the number deleted.

    Puts that all versions left hold go too.
    """
    root = table_folder(spark, name)
    found = versions(spark, root)
    old = found[: -max(1, keep)]
    for _, _, folder in old:
        delete_folder(spark, folder)
    merged = int(_VERSION.fullmatch(found[len(old)][2].rpartition("/")[2])[3] or 0)
    for number in put_numbers(spark, root):
        if number <= merged:
            delete_folder(spark, f"{puts_folder(root)}/put_no={number}")
    return len(old)


def scan_family(table: DataFrame, key: str, family: str) -> DataFrame:
    """The key and the columns of one family; the other families are not read."""
    return table.select(key, f"{family}.*")


def lookup(table: DataFrame, key: str, value: Any) -> DataFrame:
    """The row of one key, or no row. Of a bucketed table one bucket is read."""
    return table.where(F.col(key) == F.lit(value))
