"""Start and finish streaming queries. Every query needs a checkpoint in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillstream.sources.sinks import BatchWriter


@contextmanager
def _state_partitions(spark: SparkSession, partitions: int | None, closing: bool = True) -> Iterator[None]:
    """Start a query with so many state partitions, by default one per core of the cluster.

    The number holds for the life of the checkpoint; each partition keeps a store per operator.
    """
    settings = {"spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism),
                "spark.sql.streaming.noDataMicroBatches.enabled": str(closing).lower()}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def start(df: DataFrame, checkpoint: str, writer: BatchWriter, mode: str = "append",
          every: str | None = None, available_now: bool = False,
          partitions: int | None = None, closing: bool = True) -> StreamingQuery:
    """Without `closing` no micro-batch runs for the watermark alone. That fits a query whose one
    stateful step is an inner join: such a batch gives no rows of it, it only clears old state,
    which the next batch with rows does as well."""
    out = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
           .foreachBatch(writer))
    if available_now:
        out = out.trigger(availableNow=True)
    elif every:
        out = out.trigger(processingTime=every)
    with _state_partitions(df.sparkSession, partitions, closing):
        return out.start()


def drain(df: DataFrame, checkpoint: str, writer: BatchWriter, mode: str = "append",
          timeout: int | None = None, partitions: int | None = None, closing: bool = True) -> None:
    """Process what is there now, then stop."""
    _finish(start(df, checkpoint, writer, mode, available_now=True, partitions=partitions, closing=closing), timeout)


def to_folder(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
              timeout: int | None = None, partitions: int | None = None, closing: bool = True) -> None:
    """Drain into a parquet folder with Spark's own exactly-once file sink."""
    out = (df.writeStream.outputMode(mode).format("parquet")
           .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    with _state_partitions(df.sparkSession, partitions, closing):
        query = out.start(path)
    _finish(query, timeout)


def _finish(query: StreamingQuery, timeout: int | None) -> None:
    """Wait for the end, without a limit unless the caller sets one."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream not drained within {timeout} s")
