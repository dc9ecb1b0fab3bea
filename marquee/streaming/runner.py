"""Run the time transforms as Structured Streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.session import is_local

# Window state lives in RocksDB, outside the heap. Each batch stores only its
# changes, and the rows of the whole store are not counted.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def stream_session(spark: SparkSession) -> SparkSession:
    """A session for streams beside the given one, on the same cluster.

    The number of state partitions is fixed when a stream first starts: it is the
    session's number of shuffle partitions, on a local master at most one per core.
    """
    child = spark.newSession()
    for key, value in STATE_STORE.items():
        child.conf.set(key, value)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if is_local(spark):
        partitions = min(partitions, spark.sparkContext.defaultParallelism)
    child.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return child


def kept(static: DataFrame, key: str) -> DataFrame:
    """A static table kept on the executors in the partitioning of its join.

    Every micro-batch joins it again; this way it is read and shuffled once. A
    partition lost with its executor is made again. Its session plans without adaptive
    execution, which would hide the partitioning of a cached table; give it a session
    of its own, as ``stream_session`` makes.
    """
    conf = static.sparkSession.conf
    conf.set("spark.sql.adaptive.enabled", "false")
    return static.repartition(int(conf.get("spark.sql.shuffle.partitions")), key).persist(StorageLevel.MEMORY_AND_DISK)


def trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def to_files(stream: DataFrame, path: str, checkpoint: str, partition_by: str | None = None,
             fmt: str = "parquet", every: str | None = None, name: str | None = None) -> StreamingQuery:
    """Append finished rows to files, each exactly once.

    ``every`` is the micro-batch interval; without it the query handles what is
    there and stops. Restarting with the same ``checkpoint`` continues.
    """
    writer = stream.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if fmt == "csv":
        writer = writer.option("sep", "\t").option("quote", "").option("nullValue", "\\N")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger(every)).start(path)


def lots_to_files(logged: DataFrame, path: str, checkpoint: str, files_per_lot: int | None = None,
                  fmt: str = "parquet", every: str | None = None) -> StreamingQuery:
    """Write each lot to its own folder, named for its period.

    ``files_per_lot`` gathers the rows of a lot into that many files per batch. Rows are spread
    by a hash of all their columns, so a hot title's votes are in all of them and a task that
    runs again sends every row where it was; without it every task writes its own rows and
    nothing moves.
    """
    if files_per_lot:
        logged = logged.repartition("lot", F.pmod(F.xxhash64(*logged.columns), F.lit(files_per_lot)))
    return to_files(logged, path, checkpoint, partition_by="lot", fmt=fmt, every=every)


def to_batches(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
               every: str | None = None, show: bool = False, order: list[str] | None = None,
               keeping: list[DataFrame] | None = None) -> StreamingQuery:
    """Apply a table transform to the windows that each micro-batch finishes.

    In append mode a window is finished in one batch, so ranking inside the batch
    sees all of it. A batch that is run again replaces its own folder. Rows are written
    in ``order``; with ``show`` their number is printed and all of them, a partition at a time.
    ``keeping`` are tables whose copies on the executors go once the query has ended.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch)
        folder = f"{path}/batch={batch_id}"
        (rows.orderBy(*order) if order else rows).write.mode("overwrite").parquet(folder)
        if show:
            written = batch.sparkSession.read.schema(rows.schema).parquet(folder)
            print(f"{written.count()} rows in {folder}\n|{'|'.join(written.columns)}|")
            for row in (written.orderBy(*order) if order else written).toLocalIterator():
                print(f"|{'|'.join(map(str, row))}|")

    query = (
        stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        .foreachBatch(write).trigger(**trigger(every)).start()
    )
    if keeping:
        _KEPT[str(query.id)] = keeping
    return query


_KEPT: dict[str, list[DataFrame]] = {}


def release(query: StreamingQuery) -> None:
    """Drop what was kept on the executors for a query that has ended."""
    for table in _KEPT.pop(str(query.id), []):
        table.unpersist()


def drain(query: StreamingQuery) -> None:
    """Let a query with a trigger handle what is there, batch after batch, then stop it.

    For sources that a run without a trigger would read only up to their first bound.
    """
    query.processAllAvailable()
    query.stop()
    finish(query)


def finish(query: StreamingQuery) -> None:
    """Wait for a query that stops by itself and raise what it failed on."""
    query.awaitTermination()
    release(query)
    failure = query.exception()
    if failure is not None:
        raise failure
