"""Streaming forms of the per-key rules; same names and results as the table forms.

Each rule is one shuffle by key, but for the bounces' by a bucket of keys: a rule's calls and round
trips to its state are counted by buckets, not by keys. Chained into a window, pass `event_time` (the watermarked
column) so that the window downstream still knows its event time. The rules whose flags or choice
depend on earlier rows then hold a row until the watermark passes its time: what they emit is the
same in whatever order rows arrive within the watermark's delay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.streaming import processors as p


def _days(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("int")


def _run(df: DataFrame, keys: list[str], processor, schema: T.StructType,
         event_time: str | None, time_mode: str | None = None, frames: bool = False) -> DataFrame:
    mode = time_mode or ("EventTime" if event_time else "None")
    grouped = df.groupBy(*keys)
    return (grouped.transformWithStateInPandas if frames else grouped.transformWithState)(
        processor, schema, "Append", mode, eventTimeColumnName=event_time or "")


# Buckets of keys that have their state together. A micro-batch writes the state of the buckets it
# touches anew, so there are many. The number holds for the life of a checkpoint.
BUCKETS = 4096


def _by_bucket(df: DataFrame, keys: list[str], processor, schema: T.StructType, event_time: str | None,
               time_mode: str | None = None, buckets: int = BUCKETS, frames: bool = False) -> DataFrame:
    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    return _run(bucketed, ["_bucket"], processor, schema, event_time, time_mode, frames)


def _is_cell(kind: T.DataType) -> bool:
    """The type comes back from its text as it was."""
    return isinstance(kind, (T.StringType, T.IntegralType, T.DoubleType, T.FloatType, T.DecimalType, T.BooleanType,
                             T.TimestampType))


def _by_rule(df: DataFrame, keys: list[str], rule, added: tuple[str, ...] = (), day: Column | None = None,
             event_time: str | None = None, time_mode: str | None = None) -> DataFrame:
    """A rule on buckets of keys, by frames of texts. Rows with a nested column go one by one."""
    dated = df if day is None else df.withColumn("_day", _days(day))
    if not all(_is_cell(f.dataType) for f in df.schema.fields):
        return _by_bucket(dated, keys, rule, _plus(df.schema, *added), event_time, time_mode)

    def text(name: str) -> Column:
        c = F.col(f"`{name}`")
        return (F.unix_micros(c) if isinstance(df.schema[name].dataType, T.TimestampType) else c).cast("string")

    def back(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            return (c if f.name == event_time else F.timestamp_micros(c.cast("long"))).alias(f.name)
        return c.cast(f.dataType).alias(f.name)
    # the rule's own columns first; the watermarked time stays a time, by which late rows are known
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    packed = dated.select(
        *[text(c).alias(f"c{n}") for n, c in enumerate(df.columns)], *[F.col("_day").cast("string").alias("d")] * (day is not None),
        F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("_bucket"), *times)
    types = [f.dataType.simpleString().split("(")[0] for f in df.schema.fields]
    out = T.StructType([T.StructField(f.name, f.dataType if f.name == event_time else T.StringType()) for f in df.schema.fields]
                       + [T.StructField(c, T.LongType()) for c in added])
    done = _run(packed, ["_bucket"], p.Framed(rule, types, day is not None, event_time), out, event_time, time_mode, frames=True)
    return done.select(*[back(f) for f in df.schema.fields], *added)


def _is_plain(kind: T.DataType) -> bool:
    """The type comes back from a JSON text as it was."""
    if isinstance(kind, T.StructType):
        return all(_is_plain(f.dataType) for f in kind.fields)
    if isinstance(kind, T.MapType):
        return isinstance(kind.keyType, T.StringType) and _is_plain(kind.valueType)
    return _is_plain(kind.elementType) if isinstance(kind, T.ArrayType) \
        else isinstance(kind, (T.StringType, T.LongType, T.IntegerType, T.BooleanType))


def _is_ordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_is_ordered(f.dataType) for f in kind.fields)
    return _is_ordered(kind.elementType) if isinstance(kind, T.ArrayType) \
        else not isinstance(kind, (T.MapType, T.VariantType))


def _types(df: DataFrame, keys: list[str]) -> list[tuple[str, str]]:
    return [(k, df.schema[k].dataType.simpleString()) for k in keys]


def _plus(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]
                        + [T.StructField(n, T.LongType()) for n in names])


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def first_per_day(df: DataFrame, keys: list[str], order: list[str], day: Column,
                  event_time: str | None = None) -> DataFrame:
    return _by_rule(df, keys, p.FirstPerDay(_types(df, keys), order, df.columns), (), day, event_time)


def repair_new_flag(df: DataFrame, ms: str, day: Column, key: str, flag: str,
                    event_time: str | None = None) -> DataFrame:
    """Each row goes through Python and back, where many and nested columns cost the most: those that
    the rule doesn't look at go as one text."""
    rest = T.StructType([f for f in df.schema.fields
                         if f.name not in (ms, key, flag, event_time) and _is_plain(f.dataType)])
    packed = df.withColumn("_day", _days(day))
    if len(rest):
        text = F.to_json(F.struct(*[f"`{c}`" for c in rest.names]), {"ignoreNullFields": "false"})
        packed = packed.withColumn("_rest", text).drop(*rest.names)
    packed = packed.select(*[c for c in packed.columns if c != "_day"], "_day")
    mine = packed.drop("_day")
    fixed = _by_bucket(packed, [key], p.NewFlagRepair(_types(df, [key]), [ms, flag], mine.columns, flag),
                       _plus(mine.schema), event_time, frames=True)
    if len(rest):
        fixed = fixed.select("*", F.inline(F.array(F.from_json("_rest", rest))))
    return fixed.select(*[f"`{c}`" for c in df.columns])


def daily_and_returning(df: DataFrame, order: list[str], day: Column, key: str, away_days: int,
                        event_time: str | None = None) -> DataFrame:
    rule = p.HeldReturning(_types(df, [key]), order, df.columns, _ddl(df), away_days) if event_time \
        else p.Returning(_types(df, [key]), order, df.columns, away_days)
    return _by_rule(df, [key], rule, ("back_ct", "uu_ct"), day, event_time)


def daily_firsts(df: DataFrame, order: list[str], day: Column, key: str,
                 event_time: str | None = None) -> DataFrame:
    rule = p.HeldDailyFirsts(_types(df, [key]), order, df.columns, _ddl(df)) if event_time \
        else p.DailyFirsts(_types(df, [key]), order, df.columns)
    return _by_rule(df, [key], rule, ("is_new", "is_unique"), day, event_time)


def unique_and_new(df: DataFrame, order: list[str], day: Column, key: str,
                   event_time: str | None = None) -> DataFrame:
    rule = p.HeldUniqueAndNew(_types(df, [key]), order, df.columns, _ddl(df)) if event_time \
        else p.UniqueAndNew(_types(df, [key]), order, df.columns)
    return _by_rule(df, [key], rule, ("is_unique", "is_new"), day, event_time)


def latest_per_key(df: DataFrame, key: str, order: list[str], wait_ms: int = 2_000,
                   event_time: bool | str = False) -> DataFrame:
    """The newest version of a key within `wait_ms` of its first, emitted once and never again.

    By the clock the query never drains by itself, and its output goes to a window through a
    topic, not in one query. With `event_time` true, `order[0]` is the ms of a watermarked column
    and the result depends on the data alone. With the name of the watermarked column, which all
    versions of a key share, the newest is an aggregate per key and second: it comes out when the
    watermark passes that second, so the wait is the watermark's delay, its state goes with it, and
    a window may follow in the same query. The column then holds the end of the second.
    """
    if isinstance(event_time, str):
        # the order first and then the rest: the greatest of it is the newest, and state holds nothing twice
        fields = [*order, *[c for c in df.columns if c not in (event_time, key, *order)]]
        rest = [df.schema[c].dataType for c in fields]
        version = F.struct(*fields)
        newest = df.groupBy(F.window(event_time, "1 second").alias("_second"), key).agg(
            (F.max(version) if all(_is_ordered(t) for t in rest) else F.max_by(version, F.struct(*order))).alias("_newest"))
        return newest.select(*[F.col(c) if c == key else F.col("_newest")[c].alias(c) for c in df.columns if c != event_time],
                             F.window_time("_second").alias(event_time))
    processor = p.LatestVersion(_types(df, [key]), order, df.columns, _ddl(df), wait_ms, event_time)
    return _by_rule(df, [key], processor, time_mode="EventTime" if event_time else "ProcessingTime")


def first_per_key(df: DataFrame, key: str) -> DataFrame:
    """The first row of a key within the watermark delay."""
    return df.dropDuplicatesWithinWatermark([key])


def bounces(df: DataFrame, order: list[str], key: str, entry: Column, gap_ms: int) -> DataFrame:
    """Needs a watermarked column; a row is decided once the watermark is past its gap."""
    return _run(df.withColumn("_entry", entry), [key],
                p.Bounce(order, df.columns, _ddl(df), gap_ms), _plus(df.schema), None, "EventTime")
