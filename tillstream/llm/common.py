"""What the operators of this part share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstream.session import work_dir


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Fewer rows at a time in Python workers: a batch of whole texts must fit in memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, min(rows, int(spark.conf.get(key))))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """So many rows at a time in Python workers, for what is run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared work folder and read again: later jobs don't depend on executors."""
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_read(docs: DataFrame, to: str) -> DataFrame | None:
    """Adds `to`, the place of each row in the files that were written in order: the number of the part,
    then the row. None if the rows don't come straight from files."""
    try:
        part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).try_cast("long")
        return docs.withColumn(to, part * 2 ** 40 + F.col("_metadata.row_index"))
    except AnalysisException:
        return None


def spread(spark: SparkSession, *cols: str) -> Column:
    """A bucket number that splits a hot key over the tasks of a shuffle."""
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return F.pmod(F.xxhash64(*cols), F.lit(parts)).cast("int")


def ranked(df: DataFrame, keys: list[str], bucket: str, order: list[str], to: str) -> DataFrame:
    """Adds `to`, the place from 0 of each row among the rows of its key, by (bucket, order).

    No task gets a whole key: rows are numbered within (key, bucket), and the number of rows in
    the buckets before is added. Only one row for each key and bucket meets in the running sum.
    """
    counts = df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    return (df.withColumn("_row", F.row_number().over(inside))
            .join(starts, [*keys, bucket])
            .withColumn(to, F.col("_from") + F.col("_row") - 1)
            .drop("_from", "_row"))
