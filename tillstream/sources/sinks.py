"""Append, upsert, multi-way, dimension and window-table sinks, all for foreachBatch."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators.filters import keep_columns, loaded
from tillstream.operators.joins import route_rows
from tillstream.sources.keyed import DELETED, DimensionTable, KeyedTable, batch_folder, run_of, write_dimensions

# the folder column of window files
DAY = "_day"
# Text files are compressed and so not split by a reader: a writer's rows go to files of so many.
TEXT_FILES = {"compression": "gzip", "maxRecordsPerFile": 250_000}
BatchWriter = Callable[[DataFrame, int], None]
Lookup = TypeVar("Lookup")


def as_text(df: DataFrame) -> DataFrame:
    """Rows as JSON texts."""
    return df if df.columns == ["value"] else df.select(F.to_json(F.struct("*")).alias("value"))


def as_keyed_text(df: DataFrame, key: str) -> DataFrame:
    """Rows as topic records of an upserted table: key, and JSON text or null for a delete."""
    columns = [c for c in df.columns if c != DELETED]
    value = F.to_json(F.struct(*columns))
    if DELETED in df.columns:
        value = F.when(~F.coalesce(F.col(DELETED), F.lit(False)), value)
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def with_lookup(read: Callable[[], Lookup], join: Callable[[DataFrame, Lookup], DataFrame],
                writer: BatchWriter) -> BatchWriter:
    """Join each micro-batch to lookup tables read at that moment, then write it.

    For lookups that change while the stream runs. `join` must need no state of the stream:
    a fact without joins of its own, or the naming of rows already joined or summed.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        writer(join(df, read()), batch_id)
    return write


def topic_stream(df: DataFrame, checkpoint: str, format: str = "kafka", **options: str):
    """A started-by-the-caller stream writer of JSON texts to a topic or to files."""
    return (as_text(df).writeStream.format(format).options(**options)
            .option("checkpointLocation", checkpoint).outputMode("append"))


def append_batch(path: str, format: str = "text", packed: bool = True) -> BatchWriter:
    """Each micro-batch to a folder of its run and number: a repeated batch replaces itself, and
    the batches of a new checkpoint are added. Texts are compressed, as JSON repeats its names, unless
    `packed` is false: few long texts are better left to be split by the reader."""
    def write(df: DataFrame, batch_id: int) -> None:
        out, options = (as_text(df), TEXT_FILES if packed else {}) if format == "text" else (df, {})
        out.write.mode("overwrite").format(format).options(**options).save(batch_folder(path, run_of(df), batch_id))
    return write


def multi_way(split: Callable[[DataFrame], dict[str, DataFrame]],
              writers: dict[str, BatchWriter]) -> BatchWriter:
    """One input to several outputs; the input is computed once."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            parts = split(df)
            for name, writer in writers.items():
                writer(parts[name], batch_id)
        finally:
            df.unpersist()
    return write


def upsert_batch(table: KeyedTable, order: str | None = None) -> BatchWriter:
    """Add each micro-batch to an upserted table."""
    def write(df: DataFrame, batch_id: int) -> None:
        table.upsert(df, batch_id, order)
    return write


def window_batch(columns: list[str], format: str = "jdbc", mode: str = "append",
                 **options: str) -> BatchWriter:
    """Window rows to a table by column name; columns not listed stay out of the sink.

    `jdbc` tables are appended to. Files get a folder per batch, and in it one for each day of the
    windows' start, so that a report of a day opens that day's files.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        rows = df.select(*columns)
        if format == "jdbc":
            rows.write.format(format).options(**options).mode(mode).save()
        else:
            dated = rows.withColumn(DAY, F.substring("stt", 1, 10)) if "stt" in columns else rows
            dated.write.format(format).mode("overwrite").partitionBy(*[DAY] if "stt" in columns else []).save(
                batch_folder(options["path"], run_of(df), batch_id))
    return write


# -- dimensions built from config --------------------------------------------

def dimension_table(spark: SparkSession, root: str, sink_table: str, sink_columns: str,
                    sink_pk: str | None = None) -> DimensionTable:
    """The all-text table a config row asks for. The key defaults to `id`."""
    names = [c.strip() for c in sink_columns.split(",")]
    return DimensionTable(spark, root, sink_table, sink_pk or "id", names)


def routed(changes: DataFrame, config: DataFrame, version: str | None = None) -> DataFrame:
    """Change events with their sink table, deletes and unlisted payload keys dropped."""
    return keep_columns(route_rows(loaded(changes), config, version))


def dimension_batch(config: Callable[[], DataFrame], root: str, order: str = "ts",
                    version: str | None = None) -> BatchWriter:
    """Add each listed source table's changes to its dimension table, all in one write.

    The config is read anew for every micro-batch, and nothing of it comes to the driver.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        write_dimensions(routed(df, config(), version), root, batch_id, order)
    return write
