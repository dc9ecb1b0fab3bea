"""The rows of a folder of Parquet files as a stream that gives them in its first batch and never again.

A stream that is started anew from its checkpoint does not read them a second time, wherever
they lie by then; a first batch that is run again reads the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "rows_once"


@dataclass
class Part(InputPartition):
    """One row group of one file."""

    path: str
    group: int


class RowsOnce(DataSource):
    """Option: ``path``, the folder. The schema is the reader's."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return RowsOnceReader(self.options["path"], schema.fieldNames())


class RowsOnceReader(DataSourceStreamReader):
    def __init__(self, uri: str, names: list[str]):
        self.uri = uri
        self.names = names

    def initialOffset(self) -> dict:
        return {"given": 0}

    def latestOffset(self) -> dict:
        return {"given": 1}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if start == end:
            return []
        store, folder = fs.FileSystem.from_uri(self.uri)
        paths = sorted(f.path for f in store.get_file_info(fs.FileSelector(folder)) if f.is_file and f.base_name.endswith(".parquet"))
        return [Part(p, g) for p in paths for g in range(pq.ParquetFile(p, filesystem=store).num_row_groups)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.uri)
        file = pq.ParquetFile(partition.path, filesystem=store)
        yield from file.iter_batches(row_groups=[partition.group], columns=self.names)

    def commit(self, end: dict) -> None:
        pass


def rows_once(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """``folder`` is a URI, or an absolute path, that driver and executors share."""
    spark.dataSource.register(RowsOnce)
    return spark.readStream.format(FORMAT).schema(schema).option("path", folder).load()
