"""Tumbling event-time windows over tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.scalars import DATE_TIME, TOTAL, emission_ms, text_time

WINDOW = "10 seconds"
DELAY = "2 seconds"
UNION_DELAY = "13 seconds"
# late rows, and two seconds more for the newest version of a row
VERSION_DELAY = "4 seconds"


def event_time(df: DataFrame, ms: str | Column = "ts", delay: str | None = DELAY,
               out: str = "rt") -> DataFrame:
    """Event time from epoch ms; a stream also gets a watermark of bounded lateness."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    timed = df.withColumn(out, F.timestamp_millis(ms))
    return timed.withWatermark(out, delay) if df.isStreaming and delay else timed


def event_time_of(df: DataFrame, *texts: str, delay: str | None = DELAY,
                  out: str = "rt") -> DataFrame:
    """Event time from the first of several date-time texts that is not null."""
    timed = df.withColumn(out, text_time(F.coalesce(*texts)))
    return timed.withWatermark(out, delay) if df.isStreaming and delay else timed


def tumble(df: DataFrame, keys: list[str], measures: list[Column], size: str = WINDOW,
           time: str = "rt", bounds: tuple[str, str] = ("stt", "edt")) -> DataFrame:
    """Measures per window and keys, with the window bounds as text and the emission time.

    `time` is a time, or the window of an earlier sum. Spark aggregates in each input task first, so neither a hot key nor a keyless window
    gathers raw rows in one task.
    """
    start, end = bounds
    window = F.col(time) if dict(df.dtypes)[time].startswith("struct") else F.window(time, size).alias("w")
    grouped = df.groupBy(window, *keys).agg(*measures)
    names = [c for c in grouped.columns if c != "w"]
    return grouped.select(F.date_format("w.start", DATE_TIME).alias(start),
                          F.date_format("w.end", DATE_TIME).alias(end),
                          *names, emission_ms().alias("ts"))


def total(column: str | Column, out: str) -> Column:
    return F.sum(column).cast("long").alias(out)


def decimal_sum(column: str) -> Column:
    amount = F.col(column).try_cast(TOTAL)
    return F.sum(F.coalesce(amount, F.lit(0).cast(TOTAL)))


def total_money(column: str, out: str) -> Column:
    """Sum of an amount: added as decimals, given as double, so order does not matter."""
    return decimal_sum(column).cast("double").alias(out)


def traffic_rows(pages: DataFrame, unique: DataFrame, bounced: DataFrame) -> DataFrame:
    """Three inputs in one shape: 1 where the row counts, 0 elsewhere."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")

    def shape(df: DataFrame, uv=zero, sv=zero, pv=zero, dur=zero, uj=zero) -> DataFrame:
        return df.select("vc", "ch", "ar", "is_new", uv.alias("uv_ct"), sv.alias("sv_ct"),
                         pv.alias("pv_ct"), dur.alias("dur_sum"), uj.alias("uj_ct"), "ts")

    views = shape(pages, sv=F.col("last_page_id").isNull().cast("long"), pv=one,
                  dur=F.coalesce("during_time", zero))
    return views.unionByName(shape(unique, uv=one)).unionByName(shape(bounced, uj=one))
