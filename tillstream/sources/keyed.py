"""Upserted tables: an append log of changes, read as the last write of each column per key.

A write adds the changes of a micro-batch in a folder named by its run and its number, and never
touches another one. A run is a checkpoint: a repeated batch of it replaces itself, and a batch of
another run, of a new checkpoint or of a second writer, has a folder of its own. There is no state
beside the log. A read folds it by key: the newest change wins, column by column.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELETED, PRESENT = "_deleted", "_present"
# when the batch was written, its run, its number, and the place of a change in it
_AT, _RUN, _BATCH, _SEQ = "_at", "_run", "_batch", "_seq"
LOG_COLUMNS = [T.StructField(DELETED, T.BooleanType()), T.StructField(PRESENT, T.ArrayType(T.StringType())),
               T.StructField(_SEQ, T.LongType()), T.StructField(_AT, T.LongType())]
_FOLDERS = [T.StructField(_RUN, T.StringType()), T.StructField(_BATCH, T.LongType())]


def run_of(df: DataFrame) -> str:
    """The run a micro-batch belongs to: the id that its checkpoint gives the streaming query.

    It stays over restarts from the checkpoint. Outside of a stream it is `batch`.
    """
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def batch_folder(path: str, run: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{_RUN}={run}/{_BATCH}={batch_id}"


def changes(rows: DataFrame, columns: list[Column], order: str | None) -> DataFrame:
    """Rows in the shape of the log; `order` is a whole number that grows with the change's time."""
    deleted = F.coalesce(F.col(DELETED), F.lit(False)) if DELETED in rows.columns else F.lit(False)
    present = F.col(PRESENT) if PRESENT in rows.columns else F.lit(None).cast("array<string>")
    seq = F.col(order).try_cast("long") if order else F.lit(None).cast("long")
    return rows.select(*columns, deleted.alias(DELETED), present.alias(PRESENT), seq.alias(_SEQ),
                       F.lit(time.time_ns() // 1_000_000).alias(_AT))


def open_log(spark: SparkSession, path: str, fields: list[T.StructField]) -> DataFrame:
    """The log with its folder columns; empty where nothing was written yet."""
    schema = T.StructType([*fields, *LOG_COLUMNS, *_FOLDERS])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def fold(log: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key that is there, each column as last written.

    Batches go by the time they were written, changes of a batch by their order, then deletes
    before the rest. A change leaves the columns it doesn't have as they are; a delete clears all.
    Changes are folded in each task before they are shuffled.
    """
    place = F.struct(_AT, _RUN, _BATCH, _SEQ, DELETED, F.xxhash64(*columns).alias("tie"))
    rows = log.withColumn("_place", place)
    gone = F.col(DELETED)

    def last(name: str) -> Column:
        has = gone | F.col(PRESENT).isNull() | F.array_contains(PRESENT, name)
        return F.max_by(F.when(~gone, F.col(name)), F.when(has, F.col("_place"))).alias(name)
    others = [c for c in columns if c != key]
    return (rows.groupBy(key).agg(F.max_by(~gone, "_place").alias("_there"), *map(last, others))
            .where("_there").select(*columns))


class KeyedTable:
    """One row per key. A change with `_deleted` true removes its key; one whose frame lacks a
    column, or whose `_present` lacks its name, keeps the value the key has there."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType):
        if key not in schema.fieldNames():
            raise ValueError(f"key {key!r} is not a column of the table: {schema.fieldNames()}")
        self.spark, self.path, self.key, self.schema = spark, path.rstrip("/"), key, schema

    def upsert(self, rows: DataFrame, batch_id: int, order: str | None = None, run: str | None = None) -> None:
        """Add a batch; `order` tells which of several changes of a key is the newest."""
        named = [f.name for f in self.schema.fields if f.name in rows.columns]
        if PRESENT not in rows.columns and len(named) < len(self.schema):
            rows = rows.withColumn(PRESENT, F.array(*map(F.lit, named)))
        columns = [(F.col(f.name).try_cast(f.dataType) if f.name in named else F.lit(None).cast(f.dataType)).alias(f.name)
                   for f in self.schema.fields]
        changes(rows, columns, order).write.mode("overwrite").parquet(
            batch_folder(self.path, run or run_of(rows), batch_id))

    def read(self) -> DataFrame:
        return fold(open_log(self.spark, self.path, self.schema.fields), self.key, self.schema.fieldNames())


class DimensionTable:
    """A table of a dimension log: all-text columns taken from the payload of routed changes."""

    def __init__(self, spark: SparkSession, root: str, name: str, key: str, columns: list[str]):
        if key not in columns:
            raise ValueError(f"key {key!r} is not a column of the table: {columns}")
        self.spark, self.root, self.name, self.key, self.columns = spark, root, name, key, columns

    def read(self) -> DataFrame:
        """Columns that a change lacks keep their value; other tables' files aren't read."""
        log = open_log(self.spark, _dimension_log(self.root), _DIMENSION).where(F.col("sink_table") == self.name)
        return fold(log.select(*[F.try_element_at("data", F.lit(c)).alias(c) for c in self.columns], DELETED,
                               F.map_keys("data").alias(PRESENT), _SEQ, _AT, _RUN, _BATCH), self.key, self.columns)


def _dimension_log(root: str) -> str:
    """A folder of its own: `root` may hold checkpoints and bad records as well."""
    return f"{root.rstrip('/')}/dimension_log"


_DIMENSION = [T.StructField("data", T.MapType(T.StringType(), T.StringType())), T.StructField("sink_table", T.StringType())]


def write_dimensions(routed: DataFrame, root: str, batch_id: int, order: str, run: str | None = None) -> None:
    """All dimensions of a micro-batch in one write, a folder for each table."""
    rows = changes(routed, [F.col("sink_table"), F.col("data")], order)
    rows.write.partitionBy("sink_table").mode("overwrite").parquet(
        batch_folder(_dimension_log(root), run or run_of(routed), batch_id))
