"""Per-key rules in event-time order, for tables and streams.

On a table no rule sends all rows of a key to one task. First and last rows are picked with
row_number() = 1, which Spark also applies before the shuffle; repaired rows come back through
spread or row-id joins; the bounce rule cuts each key into time slices.
A stream takes the form of the same name in tillstream.streaming.state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.operators.joins import PART_ROWS, heavy_keys, spread_join
from tillstream.streaming import state as streams


def day_of(ms: str) -> Column:
    return F.to_date(F.timestamp_millis(F.col(ms)))


def _one_per(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", first).filter("_rn = 1").drop("_rn")


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key; on a stream, within the watermark delay."""
    if df.isStreaming:
        return streams.first_per_key(df, key)
    return _one_per(df, [key], [F.asc(c) for c in order])


def latest_per_key(df: DataFrame, key: str, order: list[str], event_time: str | None = None) -> DataFrame:
    """The newest version of each key. `order` ends with a column that leaves no ties.

    On a stream, `event_time` names the watermarked column that all versions of a key share: the
    newest version is then chosen when the watermark passes it, and can go on into a window.
    """
    if df.isStreaming:
        return streams.latest_per_key(df, key, order, event_time=event_time or False)
    return _one_per(df, [key], [F.desc(c) for c in order])


def first_per_day(df: DataFrame, keys: list[str], order: list[str],
                  day: Column | None = None, event_time: str | None = None) -> DataFrame:
    """The first row of each key on each day; order[0] is epoch ms unless `day` is given."""
    day = day_of(order[0]) if day is None else day
    if df.isStreaming:
        return streams.first_per_day(df, keys, order, day, event_time)
    dated = df.withColumn("_day", day)
    return _one_per(dated, [*keys, "_day"], [F.asc(c) for c in order]).drop("_day")


def repair_new_flag(df: DataFrame, ms: str = "ts", key: str = "mid", flag: str = "is_new",
                    part_rows: int = PART_ROWS, event_time: str | None = None) -> DataFrame:
    """Set the new-visitor flag to 0 on every day but the key's first day.

    A key first seen without the flag counts as first seen the day before. Of rows at the same
    moment the one without the flag comes first.
    """
    if df.isStreaming:
        return streams.repair_new_flag(df, ms, day_of(ms), key, flag, event_time)
    is_new = F.coalesce(F.col(flag) == "1", F.lit(False))
    # Only numbers are aggregated, so this is a hash aggregate with a small map-side result. It
    # keeps one row per key, and only of keys with something to repair.
    stale = (df.groupBy(key)
             .agg(F.min(F.when(is_new, F.col(ms))).alias("new_ms"),
                  F.max(F.when(is_new, F.col(ms))).alias("last_ms"),
                  F.min(F.when(~is_new, F.col(ms))).alias("old_ms"),
                  F.count(F.lit(1)).alias("_rows"))
             .filter("new_ms is not null")
             .withColumn("_first", F.when(F.coalesce(F.col("old_ms") <= F.col("new_ms"),
                                                     F.lit(False)),
                                          F.date_sub(day_of("old_ms"), 1))
                         .otherwise(day_of("new_ms")))
             .filter(day_of("last_ms") != F.col("_first"))
             .select(key, "_first", "_rows"))
    joined = spread_join(df, stale, key, "left", [ms], "_rows", part_rows)
    wrong = is_new & (day_of(ms) != F.col("_first"))
    return joined.withColumn(flag, F.when(wrong, "0").otherwise(F.col(flag))).drop("_first")


def daily_page_counters(df: DataFrame, order: list[str], key: str = "mid",
                        home: str = "home", detail: str = "good_detail",
                        event_time: str | None = None) -> DataFrame:
    """First view of the home page and of the detail page per key and day, as 0/1 counters."""
    first = first_per_day(df.filter(F.col("page_id").isin(home, detail)), [key, "page_id"], order,
                          event_time=event_time)
    return (first.withColumn("home_uv_ct", (F.col("page_id") == home).cast("long"))
            .withColumn("good_detail_uv_ct", (F.col("page_id") == detail).cast("long")))


def daily_and_returning(df: DataFrame, order: list[str], key: str = "uid",
                        away_days: int = 8, event_time: str | None = None) -> DataFrame:
    """First row per key and day, with uu_ct = 1 and back_ct = 1 after `away_days` or more."""
    if df.isStreaming:
        return streams.daily_and_returning(df, order, day_of(order[0]), key, away_days,
                                           event_time)
    daily = first_per_day(df, [key], order).withColumn("_day", day_of(order[0]))
    # At most one row per key and calendar day is left, so this window stays small.
    before = F.lag("_day").over(Window.partitionBy(key).orderBy("_day"))
    back = F.coalesce(F.datediff("_day", before) >= away_days, F.lit(False))
    return (daily.withColumn("back_ct", back.cast("long"))
            .withColumn("uu_ct", F.lit(1).cast("long")).drop("_day"))


def daily_firsts(df: DataFrame, order: list[str], day: Column, key: str = "user_id",
                 event_time: str | None = None) -> DataFrame:
    """First row per key and day; is_unique = 1, is_new = 1 on the key's first day."""
    if df.isStreaming:
        return streams.daily_firsts(df, order, day, key, event_time)
    daily = _one_per(df.withColumn("_day", day), [key, "_day"], [F.asc(c) for c in order])
    before = F.lag("_day").over(Window.partitionBy(key).orderBy("_day"))
    return (daily.withColumn("is_new", before.isNull().cast("long"))
            .withColumn("is_unique", F.lit(1).cast("long")).drop("_day"))


def unique_and_new(df: DataFrame, order: list[str], day: Column, row_id: str,
                   key: str = "user_id", event_time: str | None = None) -> DataFrame:
    """Every row, with is_unique on the key's first of the day and is_new on its first ever.

    The few flagged rows return by the unique row id, so a hot key never gathers in a task.
    """
    if df.isStreaming:
        return streams.unique_and_new(df, order, day, key, event_time)
    flags = daily_firsts(df.select(row_id, key, *[c for c in order if c not in (row_id, key)],
                                   day.alias("_d")),
                         order, F.col("_d"), key).select(row_id, "is_unique", "is_new")
    zero = F.lit(0).cast("long")
    return (df.join(flags, row_id, "left")
            .withColumn("is_unique", F.coalesce("is_unique", zero))
            .withColumn("is_new", F.coalesce("is_new", zero)))


def bounces(df: DataFrame, order: list[str], key: str = "mid", entry: Column | None = None,
            gap_ms: int = 10_000, slice_ms: int = 3_600_000, part_rows: int = PART_ROWS) -> DataFrame:
    """Entry views with no further page within the gap: the key's next view is an entry too, or
    comes after `gap_ms` or more, or never.

    Keys are cut into time slices, and a slice with more than `part_rows` rows into as many shorter
    ones, down to the gap. A row close behind a slice's start is also shown to the slice before, as
    a look-ahead row only, so every next view within the gap is seen.
    """
    ms = F.col(order[0])
    entry = F.col("last_page_id").isNull() if entry is None else entry
    if df.isStreaming:
        return streams.bounces(df, order, key, entry, gap_ms)
    slice_ms = max(slice_ms, gap_ms)
    whole = F.floor(ms / slice_ms)
    sizes = df.groupBy(F.col(key).alias("_key"), whole.alias("_heavy")).agg(F.count(F.lit(1)).alias("_rows"))
    heavy = F.broadcast(heavy_keys(sizes, ["_key", "_heavy"], "_rows", part_rows).withColumn(
        "_parts", F.least("_parts", F.lit(slice_ms // gap_ms))))

    def parts_of(rows: DataFrame, shift: int, name: str) -> DataFrame:
        """In how many parts the row's slice is cut, or the slice before it."""
        side = heavy.withColumnsRenamed({"_key": "_k", "_heavy": "_h", "_parts": "_p"})
        return (rows.join(side, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_whole") + shift == F.col("_h")), "left")
                .withColumn(name, F.coalesce("_p", F.lit(1))).drop("_k", "_h", "_p"))

    def place(slice_: Column, part: Column, own: bool) -> Column:
        return F.struct(slice_.alias("_slice"), part.cast("long").alias("_part"), F.lit(own).alias("_own"))
    cut = parts_of(parts_of(df.withColumn("_entry", entry).withColumn("_whole", whole), 0, "_parts"), -1, "_before")
    # part i of n holds the times from i / n to (i + 1) / n of its slice, never less than the gap
    inside = ms - F.col("_whole") * slice_ms
    part = F.floor(inside * F.col("_parts") / slice_ms)
    begin = F.ceil(part * slice_ms / F.col("_parts"))
    before = F.when(part > 0, place(F.col("_whole"), part - 1, False)) \
        .otherwise(place(F.col("_whole") - 1, F.col("_before") - 1, False))
    here = place(F.col("_whole"), part, True)
    shown = (cut.withColumn("_at", F.explode(F.when(inside - begin < gap_ms, F.array(before, here)).otherwise(F.array(here))))
             .select("*", "_at.*").drop("_at", "_whole", "_parts", "_before"))
    ahead = Window.partitionBy(key, "_slice", "_part").orderBy(*order)
    next_ms, next_entry = F.lead(order[0]).over(ahead), F.lead("_entry").over(ahead)
    return (shown.withColumn("_next_ms", next_ms).withColumn("_next_entry", next_entry)
            .filter(F.col("_own") & F.col("_entry")
                    & (F.col("_next_ms").isNull() | F.col("_next_entry")
                       | (F.col("_next_ms") - ms >= gap_ms)))
            .drop("_entry", "_own", "_slice", "_part", "_next_ms", "_next_entry"))
