"""Topic, table and config readers. Connection options always come from the caller."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.schemas import CHANGE_EVENT


def text_topic(spark: SparkSession, format: str = "kafka", stream: bool = True,
               **options: str) -> DataFrame:
    """Topic records as one text column `value`; a null record becomes an empty text.

    `kafka` options are the connector's own (`subscribe`, `kafka.bootstrap.servers`, ...).
    File formats take `path`; `text` is one record per line.
    """
    reader = spark.readStream if stream else spark.read
    path = options.pop("path", None)
    if format != "kafka":
        reader = reader.schema("value string")
    elif stream:
        options.setdefault("startingOffsets", "latest")
    raw = reader.format(format).options(**options).load(path)
    return raw.select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"))


def json_topic(spark: SparkSession, schema: T.StructType, format: str = "kafka",
               stream: bool = True, **options: str) -> DataFrame:
    """Topic records with a fixed JSON schema."""
    text = text_topic(spark, format, stream, **options)
    # inline() keeps later predicates above the parse: once per text, not once per predicate
    return text.select(F.inline(F.array(F.from_json("value", schema))))


def change_topic(spark: SparkSession, format: str = "kafka", stream: bool = True,
                 **options: str) -> DataFrame:
    """The change event topic with its processing-time column `pt`."""
    return (json_topic(spark, CHANGE_EVENT, format, stream, **options)
            .withColumn("pt", F.current_timestamp()))


def table(spark: SparkSession, format: str, path: str | None = None, **options: str) -> DataFrame:
    """A lookup or config table: `jdbc` with the caller's options, or files."""
    return spark.read.format(format).options(**options).load(path)


def rereading(spark: SparkSession, format: str, path: str | None = None,
              **options: str) -> Callable[[], DataFrame]:
    """A reader to call once per micro-batch, so changed lookup or config rows are seen."""
    return lambda: table(spark, format, path, **options)
