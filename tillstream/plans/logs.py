"""Click log jobs: split, unique visitors, bounces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.parsing import marked_log, split_log
from tillstream.operators import filters, state
from tillstream.operators.windows import DELAY, event_time


# the outputs of a split log event
OUTPUTS = ("page", "start", "display", "action", "error")


def repaired_events(events: DataFrame) -> DataFrame:
    """Log events with the new-visitor flag corrected per device."""
    flat = events.select("*", F.col("common.mid").alias("mid"),
                         F.col("common.is_new").alias("is_new"))
    fixed = state.repair_new_flag(flat)
    return (fixed.withColumn("common", F.col("common").withField("is_new", F.col("is_new")))
            .drop("mid", "is_new"))


def split_click_log(text: DataFrame) -> dict[str, DataFrame]:
    """Raw log texts to page, start, display, action and error events, and unreadable texts.

    To write several outputs of a stream, use sinks.multi_way on `repaired_events`.
    """
    good, bad = split_log(text)
    return {**filters.split_events(repaired_events(good)), "bad": bad}


def repaired_log(text: DataFrame) -> DataFrame:
    """Raw log texts parsed once, sound events with the new-visitor flag corrected, the others marked.

    Texts without a device share out over many keys, on which the flag rule has nothing to repair.
    For a stream that writes all outputs and the quarantine in one query, see split_outputs.
    """
    marked = marked_log(text)
    sound = F.size("faults") == 0
    spread = F.concat(F.lit("?"), F.pmod(F.xxhash64("value"), F.lit(1024)).cast("string"))
    flat = marked.select("*", F.when(sound, F.col("common.mid")).otherwise(spread).alias("mid"),
                         F.when(sound, F.col("common.is_new")).alias("is_new")) \
        .withColumn("ts", F.when(sound, F.col("ts")).otherwise(F.lit(0))) \
        .withColumn("value", F.when(~sound, F.col("value")))  # an event's text is not needed any more
    fixed = state.repair_new_flag(flat)
    return (fixed.withColumn("common", F.when(sound, F.col("common").withField("is_new", F.col("is_new"))))
            .drop("mid", "is_new"))


def split_outputs(log: DataFrame) -> dict[str, DataFrame]:
    """The five outputs of `repaired_log`, and `bad`: texts with the fields that are wrong."""
    sound = F.size("faults") == 0
    return {**filters.split_events(log.filter(sound).drop("value", "faults")),
            "bad": log.filter(~sound).select("value", "faults")}


def unique_visitors(pages: DataFrame, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """The first visit start of each device per day."""
    return state.first_per_day(filters.entry_pages(pages), ["mid"], list(order))


def bounce_details(pages: DataFrame, order: tuple[str, ...] = ("ts",), gap_ms: int = 10_000,
                   slice_ms: int = 3_600_000, delay: str = DELAY) -> DataFrame:
    """Visits that ended on their first page."""
    if pages.isStreaming:
        pages = event_time(pages, delay=delay)
    return state.bounces(pages, list(order), gap_ms=gap_ms, slice_ms=slice_ms)
