"""Streams over several micro-batches and restarts give what the tables give."""

import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF
from tillstream.functions.parsing import split_log
from tillstream.operators import filters, joins, state
from tillstream.operators.windows import event_time, tumble
from tillstream.plans import dim, facts, logs, windows
from tillstream.schemas import CODE_DICTIONARY
from tillstream.sources import readers, samples, sinks
from tillstream.streaming import run
from tillstream.streaming import state as streams
from tillstream.streaming.joins import interval_join

ORDER = ["ts", "event_id"]
SIX_HOURS = 6 * 3_600_000
CUTS = ["2024-01-01", "2024-01-09", "2024-01-16", "2024-01-24", "2024-03-01"]


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture
def parts(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    return [events.filter((F.col("ts") >= a) & (F.col("ts") < b)) for a, b in zip(CUTS, CUTS[1:])]


class Feed:
    """A folder stream whose files come one per micro-batch, drained with one checkpoint."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema = spark, folder, schema

    def add(self, *parts):
        for part in parts:
            part.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
            time.sleep(0.05)

    def stream(self):
        return (self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
                .parquet(f"{self.folder}/in"))

    def drain(self, make, name="q", timeout=120):
        run.to_folder(make(self.stream()), f"{self.folder}/out-{name}",
                      f"{self.folder}/checkpoint-{name}", timeout=timeout, partitions=3)
        return self.spark.read.parquet(f"{self.folder}/out-{name}")


@pytest.fixture
def feed(spark, folder, parts):
    return Feed(spark, folder, parts[0].schema)


RULES = {
    "new_flag": (lambda p: state.repair_new_flag(p), ["event_id", "mid", "is_new", "ts"]),
    "first_per_day": (lambda p: logs.unique_visitors(p, tuple(ORDER)), ["event_id", "mid", "ts"]),
    "page_firsts": (lambda p: state.daily_page_counters(p, ORDER),
                    ["event_id", "home_uv_ct", "good_detail_uv_ct"]),
    "returning": (lambda p: state.daily_and_returning(filters.logged_in_entries(p), ORDER),
                  ["event_id", "uu_ct", "back_ct"]),
    "unique": (lambda p: state.unique_and_new(p.drop("is_new"), ORDER, state.day_of("ts"),
                                              "event_id", key="mid"),
               ["event_id", "is_unique", "is_new"]),
    "daily_firsts": (lambda p: state.daily_firsts(p.drop("is_new"), ORDER, state.day_of("ts"),
                                                  key="mid"), ["event_id", "is_unique", "is_new"]),
}


@pytest.mark.parametrize("rule", RULES)
def test_rule_over_batches_and_restart(spark, feed, parts, rule):
    make, columns = RULES[rule]
    feed.add(*parts[:2])
    feed.drain(lambda e: make(samples.pages_of(e)))
    feed.add(*parts[2:])
    got = feed.drain(lambda e: make(samples.pages_of(e)))
    assert bag(got, *columns) == bag(make(samples.pages(spark, SF)), *columns)


def test_bounces_decided_over_batches_and_restart(spark, feed, parts):
    def make(pages):
        return logs.bounce_details(pages, tuple(ORDER), SIX_HOURS)
    feed.add(*parts[:2])
    feed.drain(lambda e: make(samples.pages_of(e)))
    feed.add(*parts[2:])
    got = feed.drain(lambda e: make(samples.pages_of(e)))
    pages = samples.pages(spark, SF)
    last = pages.agg(F.max("ts")).first()[0]
    closed = make(pages).filter(F.col("ts") + SIX_HOURS <= last - 2000)
    assert bag(got, "event_id") == bag(closed, "event_id")


@pytest.mark.parametrize("make, columns", [
    (lambda p: windows.logins(p, "1 hour", tuple(ORDER)), ["stt", "edt", "back_ct", "uu_ct"]),
    (lambda p: windows.home_and_detail(p, "1 hour", tuple(ORDER)),
     ["stt", "edt", "home_uv_ct", "good_detail_uv_ct"])])
def test_rule_chained_into_window(spark, feed, parts, make, columns):
    feed.add(*parts)
    got = feed.drain(lambda e: make(samples.pages_of(e)))
    pages = samples.pages(spark, SF)
    last = pages.agg(F.date_format(F.timestamp_millis(F.max("ts") - 2000),
                                   "yyyy-MM-dd HH:mm:ss")).first()[0]
    full = make(pages).filter(F.col("edt") <= last)
    extra = bag(got, *columns) - bag(make(pages), *columns)
    missing = bag(full, *columns) - bag(got, *columns)
    # the watermark follows the rule's own rows, so only the very last windows may stay open
    assert not extra and sum(missing.values()) <= 2


def test_late_row_is_dropped_and_last_window_waits(spark, folder):
    """A row counts as late by the watermark its operator had one micro-batch before."""
    schema = "ts bigint"
    feed = Feed(spark, folder, spark.createDataFrame([], schema).schema)
    for ms in ([1_000, 25_000], [26_000], [2_000, 27_000], [50_000]):
        feed.add(spark.createDataFrame([(m,) for m in ms], schema))
    got = feed.drain(lambda s: tumble(event_time(s).drop("ts"), [], [F.count("*").alias("n")]))
    assert bag(got, "stt", "n") == Counter({("1970-01-01 00:00:00", 1): 1,
                                            ("1970-01-01 00:00:20", 3): 1})


def test_copies_within_the_watermark(spark, folder):
    schema = "id string, ts bigint"
    feed = Feed(spark, folder, spark.createDataFrame([], schema).schema)
    for batch in ([("a", 1000), ("a", 1000), ("b", 1000)], [("a", 1500), ("c", 9000)]):
        feed.add(spark.createDataFrame(batch, schema))
    got = feed.drain(lambda s: state.first_per_key(event_time(s), "id", ["ts"]))
    assert bag(got, "id") == Counter({("a",): 1, ("b",): 1, ("c",): 1})


def test_latest_version_by_the_clock(spark, folder):
    """A newer version within the wait replaces, an equal one too, a later copy is silent."""
    schema = "id string, ts bigint, v string"
    feed = Feed(spark, folder, spark.createDataFrame([], schema).schema)
    feed.add(spark.createDataFrame([("a", 42, "old"), ("a", 900, "new"), ("b", 1, "only")], schema))
    out = streams.latest_per_key(feed.stream(), "id", ["ts", "v"], wait_ms=2_000)
    query = (out.writeStream.format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/checkpoint")
             .trigger(processingTime="500 milliseconds").start())
    try:
        def wait_for(n):
            end = time.time() + 60
            while time.time() < end:
                try:
                    if spark.read.schema(schema).parquet(f"{folder}/out").count() >= n:
                        return
                except Exception:
                    pass
                time.sleep(0.5)
            raise AssertionError("not emitted in time")
        wait_for(2)
        feed.add(spark.createDataFrame([("a", 5_000, "too late"), ("c", 1, "next")], schema))
        wait_for(3)
    finally:
        query.stop()
    got = spark.read.parquet(f"{folder}/out")
    assert bag(got, "id", "v") == Counter({("a", "new"): 1, ("b", "only"): 1, ("c", "next"): 1})


def test_left_interval_join_gives_unmatched_rows_once(spark, folder):
    left = Feed(spark, f"{folder}/l", spark.createDataFrame([], "k string, lt timestamp").schema)
    right = Feed(spark, f"{folder}/r", spark.createDataFrame([], "j string, rt timestamp").schema)

    def at(s):
        return f"2024-01-01 00:{s // 60:02d}:{s % 60:02d}"

    def add(feed, *data):
        feed.add(spark.createDataFrame(list(data), "a string, b string").select(
            F.col("a").alias(feed.schema.names[0]),
            F.col("b").cast("timestamp").alias(feed.schema.names[1])))
    add(left, ("a", at(0)), ("b", at(1)), ("c", at(2)))
    add(right, ("a", at(5)), ("b", at(59)))
    add(left, ("end", at(600)))
    add(right, ("none", at(600)))
    joined = interval_join(left.stream(), right.stream(), ("k", "j"), ("lt", "rt"), "10 seconds",
                           "10 seconds", "left")
    run.to_folder(joined, f"{folder}/out", f"{folder}/checkpoint", timeout=120, partitions=3)
    got = bag(spark.read.parquet(f"{folder}/out"), "k", "j")
    assert got == Counter({("a", "a"): 1, ("b", None): 1, ("c", None): 1})


def test_wide_order_fact_from_a_stream(spark, folder):
    """The five-way join as one streaming query; equals the table form on closed rows."""
    def event(table, ts, type_="insert", old=None, **data):
        return ("shop", table, type_, data, old, str(ts))
    events = [event("order_detail", 100, id="1", order_id="o", source_type="c"),
              event("order_detail", 100, id="2", order_id="o", source_type="c"),
              event("order_detail", 100, id="3", order_id="o", source_type="?"),
              event("order_info", 101, id="o", user_id="u"),
              event("order_detail_activity", 102, order_detail_id="1", activity_id="a"),
              event("order_detail_coupon", 99, order_detail_id="2", coupon_id="k"),
              event("order_info", 90_000, id="end"),
              event("order_detail", 90_000, id="end", order_id="end", source_type="c"),
              event("order_detail_activity", 90_000, order_detail_id="end"),
              event("order_detail_coupon", 90_000, order_detail_id="end")]
    columns = ("database string, table string, type string, data map<string,string>, "
               "old map<string,string>, ts string")
    table = spark.createDataFrame(events, columns)
    codes = spark.createDataFrame([("c", "C", "p", None, None)], CODE_DICTIONARY)
    feed = Feed(spark, folder, table.schema)
    feed.add(table.filter("ts < 1000"), table.filter("ts >= 1000"))
    got = feed.drain(lambda s: facts.order_detail(s, codes, span="1 minute"))
    want = facts.order_detail(table, codes)
    columns = ["order_detail_id", "user_id", "activity_id", "coupon_id", "dic_name"]
    # the closing line itself waits for its own coupon; only its match comes at once
    assert bag(got.filter("order_id = 'o'"), *columns) == bag(
        want.filter("order_id = 'o'"), *columns)


def test_log_split_writes_five_outputs_and_quarantine(spark, folder):
    sinks.append_batch(f"{folder}/topic")(samples.raw_log(spark, SF), 0)

    def topic():
        return readers.text_topic(spark, "text", path=f"{folder}/topic")
    good, bad = split_log(topic())
    writers = {n: sinks.append_batch(f"{folder}/{n}") for n in logs.OUTPUTS}
    run.drain(logs.repaired_events(good), f"{folder}/c1",
              sinks.multi_way(filters.split_events, writers))
    run.drain(bad, f"{folder}/c2", sinks.append_batch(f"{folder}/bad"))
    want = logs.split_click_log(samples.raw_log(spark, SF))
    for name, df in want.items():
        assert spark.read.text(f"{folder}/{name}").count() == df.count(), name


def test_dimension_sync_sees_config_changes(spark, folder):
    columns = "source_table string, sink_table string, sink_columns string, sink_pk string"
    config = [[("a", "dim_a", "id,name", None)],
              [("a", "dim_a", "id,name", None), ("b", "dim_b", "code", "code")]]
    texts = [['{"table":"a","type":"insert","ts":1,"data":{"id":1,"name":"it\'s","x":2}}',
              '{"table":"b","type":"insert","ts":1,"data":{"code":"lost"}}', '{"cut'],
             ['{"table":"a","type":"update","ts":2,"data":{"id":1,"name":"new"}}',
              '{"table":"a","type":"delete","ts":3,"data":{"id":1,"name":"new"}}',
              '{"table":"b","type":"insert","ts":2,"data":{"code":"kept"}}']]
    for batch, (rows, values) in enumerate(zip(config, texts)):
        spark.createDataFrame(rows, columns).write.mode("overwrite").parquet(f"{folder}/config")
        spark.createDataFrame([(v,) for v in values], "value string").coalesce(1) \
            .write.mode("append").text(f"{folder}/in")
        writer = dim.sync_batch(readers.rereading(spark, "parquet", f"{folder}/config"),
                                f"{folder}/dims", sinks.append_batch(f"{folder}/bad"))
        run.drain(readers.text_topic(spark, "text", path=f"{folder}/in"), f"{folder}/checkpoint",
                  writer, timeout=120, partitions=3)
    a = sinks.dimension_table(spark, f"{folder}/dims", "dim_a", "id,name")
    b = sinks.dimension_table(spark, f"{folder}/dims", "dim_b", "code", "code")
    assert bag(a.read(), "id", "name") == Counter({("1", "new"): 1})
    assert bag(b.read(), "code") == Counter({("kept",): 1})
    assert spark.read.text(f"{folder}/bad").count() == 1


def test_changed_lookup_is_seen_by_the_next_batch(spark, folder):
    schema = "code string"
    feed = Feed(spark, folder, spark.createDataFrame([], schema).schema)
    writer = sinks.with_lookup(
        readers.rereading(spark, "parquet", f"{folder}/codes"),
        lambda df, codes: joins.decode(df, codes, {"code": "name"}),
        sinks.append_batch(f"{folder}/out", "parquet"))
    for name in ("before", "after"):
        spark.createDataFrame([("c", name)], "dic_code string, dic_name string") \
            .write.mode("overwrite").parquet(f"{folder}/codes")
        feed.add(spark.createDataFrame([("c",)], schema))
        run.drain(feed.stream(), f"{folder}/checkpoint", writer, timeout=120)
    assert bag(spark.read.parquet(f"{folder}/out"), "name") == Counter(
        {("before",): 1, ("after",): 1})


DAYS = [10, 7, 9, 7, 8]


@pytest.mark.parametrize("rule, columns", [
    (lambda d: state.first_per_day(d, ["mid"], ["ts", "event_id"]), ["mid", "day"]),
    (lambda d: state.daily_and_returning(d, ["ts", "event_id"], key="mid"), ["mid", "day", "uu_ct"]),
    (lambda d: state.daily_firsts(d, ["ts", "event_id"], state.day_of("ts"), key="mid"), ["mid", "day", "is_unique"]),
    (lambda d: state.unique_and_new(d, ["ts", "event_id"], state.day_of("ts"), "event_id", key="mid").where("is_unique = 1"),
     ["mid", "day", "is_unique"]),
])
def test_days_out_of_order_across_batches_are_all_kept(spark, folder, rule, columns):
    rows = [spark.createDataFrame([(f"m{k}", d * 86_400_000 + k + n, 10 * n + k, d) for k in range(3)],
                                  "mid string, ts long, event_id long, day int") for n, d in enumerate(DAYS)]
    feed = Feed(spark, folder, rows[0].schema)
    feed.add(*rows)
    whole = rows[0]
    for part in rows[1:]:
        whole = whole.union(part)
    assert bag(feed.drain(rule), *columns) == bag(rule(whole), *columns)


@pytest.mark.parametrize("rule, columns", [
    (lambda d, t: state.daily_and_returning(d, ["ts", "event_id"], key="mid", away_days=2, event_time=t),
     ["event_id", "uu_ct", "back_ct"]),
    (lambda d, t: state.daily_firsts(d, ["ts", "event_id"], state.day_of("ts"), key="mid", event_time=t),
     ["event_id", "is_unique", "is_new"]),
    (lambda d, t: state.unique_and_new(d, ["ts", "event_id"], state.day_of("ts"), "event_id", key="mid", event_time=t),
     ["event_id", "is_unique", "is_new"]),
])
def test_flags_of_days_out_of_order_follow_event_time(spark, folder, rule, columns):
    """Within the watermark's delay the order of arrival decides nothing, neither of days nor of rows."""
    day_ms, parts = 86_400_000, []
    for n, d in enumerate([*DAYS, 12, 7]):
        rows = [(f"m{k}", d * day_ms + (k * 7 + n * 5) % 11, 100 * n + 10 * k + c) for k in range(3) for c in range(1 + n % 2)]
        parts.append(spark.createDataFrame(rows, "mid string, ts long, event_id long"))
    last = spark.createDataFrame([("closes", 100 * day_ms, -1)], parts[0].schema)
    feed = Feed(spark, folder, parts[0].schema)
    feed.add(*parts, last)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    got = feed.drain(lambda d: rule(event_time(d, delay="6 days"), "rt"))
    assert bag(got.filter("mid <> 'closes'"), *columns) == bag(rule(whole, None), *columns)


def test_the_newest_version_goes_into_a_window_of_the_same_query(spark, folder):
    schema = "id string, at long, version int, amount int"
    parts = [[("a", 1_000, 1, 1), ("b", 2_000, 1, 10)], [("a", 1_000, 3, 5), ("b", 2_000, 2, 20), ("c", 9_000, 1, 100)],
             [("a", 1_000, 2, 7)], [("d", 60_000, 1, 1000)], [("e", 61_000, 1, 1)],
             [("a", 1_000, 9, 99)]]
    feed = Feed(spark, folder, spark.createDataFrame(parts[0], schema).schema)
    feed.add(*(spark.createDataFrame(p, schema) for p in parts))

    def make(df):
        newest = state.latest_per_key(event_time(df, "at", delay="20 seconds"), "id", ["version"], event_time="rt")
        return tumble(newest, [], [F.sum("amount").alias("amount"), F.count("*").alias("n")], "10 seconds")
    got = feed.drain(make)
    assert bag(got, "amount", "n") == Counter({(125, 3): 1})


def test_a_bad_time_does_not_end_a_stream(spark, folder):
    rows = [(f"{k}", ts) for k, ts in enumerate(["1", "x", None, "", "99999999999999999999", "2"])]
    feed = Feed(spark, folder, spark.createDataFrame(rows, "id string, ts string").schema)
    feed.add(*(spark.createDataFrame([r], "id string, ts string") for r in rows))
    out = feed.drain(lambda d: d.withColumn("at", facts._seconds()))
    assert Counter(r["at"] is None for r in out.collect()) == Counter({True: 4, False: 2})


def test_joined_streams_need_a_span(spark, folder):
    feed = Feed(spark, folder, samples.changes(spark, SF, "favor_info").schema)
    feed.add(samples.changes(spark, SF, "favor_info"))
    with pytest.raises(ValueError, match="span"):
        facts.joined_lines(feed.stream())
