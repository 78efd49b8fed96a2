"""JSON text to columns, with a good and a bad side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.schemas import CHANGE_EVENT, LOG_EVENT

_CORRUPT = "_corrupt_record"


def _parsed(df: DataFrame, schema: T.StructType, value: str) -> DataFrame:
    # inline() keeps later predicates above the parse, so each text is parsed once per row
    # instead of once per predicate.
    full = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value), full, {"mode": "PERMISSIVE",
                                              "columnNameOfCorruptRecord": _CORRUPT})
    return df.select("*", F.inline(F.array(parsed)))


def _is_object(value: str) -> Column:
    # A top-level array or scalar is not an event, even if its parts would fit the schema.
    return F.ltrim(F.col(value)).startswith("{") & F.try_parse_json(value).isNotNull()


def _marked(df: DataFrame, value: str, checks: list[tuple[str, Column, str]]) -> DataFrame:
    """Adds `faults`, the (field, reason) of each check that doesn't hold; empty for a sound event.

    The text is only looked at again where the parser already found something wrong.
    """
    found = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(field).alias("field"), F.lit(why).alias("reason")))
                      for field, ok, why in checks])
    # what the parser can't read has no fields to check
    faults = F.when(F.col(_CORRUPT).isNotNull() & ~_is_object(value) | ~F.ltrim(F.col(value)).startswith("{"), F.array(F.struct(
        F.lit("value").alias("field"), F.lit("not a JSON object").alias("reason")))) \
        .otherwise(F.filter(found, lambda f: f.isNotNull()))
    other = F.array(F.struct(F.lit("value").alias("field"), F.lit("a field of another type").alias("reason")))
    return (df.withColumn("faults", F.coalesce(faults, F.array()))
            .withColumn("faults", F.when(F.col(_CORRUPT).isNotNull() & (F.size("faults") == 0), other)
                        .otherwise(F.col("faults"))).drop(_CORRUPT))


def _sides(marked: DataFrame, value: str) -> tuple[DataFrame, DataFrame]:
    sound = F.size("faults") == 0
    return marked.filter(sound).drop("faults", value), marked.filter(~sound).select(value, "faults")


def _whole_number(value: str, path: str, parsed: Column) -> Column:
    """The field is there as a number, or not there at all."""
    return F.when(F.col(_CORRUPT).isNull(), True).otherwise(parsed.isNotNull() | F.get_json_object(value, path).isNull())


def marked_log(df: DataFrame, value: str = "value") -> DataFrame:
    """Click log texts with their parsed fields and `faults`, the fields that are wrong and why.

    An event needs common.mid, and start or page; without them nothing later could use it.
    """
    page = F.col("start").isNotNull() | F.col("page").isNotNull()
    return _marked(_parsed(df, LOG_EVENT, value), value, [
        ("common.mid", F.col("common.mid").isNotNull(), "missing"),
        ("page", page, "neither start nor page"),
        ("ts", _whole_number(value, "$.ts", F.col("ts")), "not a whole number")])


def split_log(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Click log text to (events, unreadable texts with their faults)."""
    return _sides(marked_log(df, value), value)


def split_changes(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Change event text to (events, unreadable texts with their faults)."""
    time = F.col("ts").isNull() | F.col("ts").try_cast("long").isNotNull()
    return _sides(_marked(_parsed(df, CHANGE_EVENT, value), value, [
        ("table", F.col("table").isNotNull(), "missing"), ("type", F.col("type").isNotNull(), "missing"),
        ("ts", time, "not a whole number")]), value)


def page_rows(events: DataFrame) -> DataFrame:
    """Page view events as flat rows, one column per log field."""
    return events.select("common.*", "page.*", "ts")
