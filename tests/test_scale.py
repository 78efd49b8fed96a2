"""What keeps a query's disk, time and memory in proportion to its input."""

from __future__ import annotations

import glob
import gzip
import random
from collections import Counter
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import SF
from tillstream import catalog
from tillstream.functions.parsing import split_log
from tillstream.plans import facts, logs, windows
from tillstream.schemas import CODE_DICTIONARY
from tillstream.sources import readers, sinks
from tillstream.streaming import processors as p
from tillstream.streaming import run
from tillstream.streaming.joins import interval_join


def test_topic_texts_are_compressed_in_files_of_bounded_length(spark, folder, monkeypatch):
    monkeypatch.setitem(sinks.TEXT_FILES, "maxRecordsPerFile", 100)
    rows = spark.range(1000).withColumn("name", F.lit("x" * 50)).coalesce(1)
    sinks.append_batch(f"{folder}/topic")(rows, 0)
    files = glob.glob(f"{folder}/topic/**/*.txt.gz", recursive=True)
    assert len(files) == 10 and not glob.glob(f"{folder}/topic/**/*.txt", recursive=True)
    assert all(gzip.open(f).read().count(b"\n") == 100 for f in files)
    back = readers.json_topic(spark, rows.schema, "text", stream=False, path=f"{folder}/topic", recursiveFileLookup="true")
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, rows.collect()))


def test_rows_of_a_feed_are_made_once(spark):
    """A part that is drawn by lot would differ each time the rows are made."""
    lot = F.udf(lambda n: random.randrange(4), "int").asNondeterministic()
    rows = spark.range(2000)
    feed = catalog._fed(spark, rows, lot("id"), 4, "lots", rows.schema)
    got = catalog._drained(spark, feed, "lots_out")
    assert Counter(r["id"] for r in got.collect()) == Counter(range(2000))


class _State:
    def __init__(self, calls: list):
        self.rows, self.calls = [], calls

    def exists(self):
        self.calls.append("exists")
        return bool(self.rows)

    def get(self):
        self.calls.append("get")
        return iter(self.rows)

    def put(self, rows):
        self.calls.append("put")
        self.rows = list(rows)

    def appendList(self, rows):
        self.calls.append("append")
        self.rows += rows

    def clear(self):
        self.calls.append("clear")
        self.rows = []


class _Handle:
    """State and timers that count how often a rule turns to them."""

    def __init__(self):
        self.calls, self.timers = [], set()

    def getListState(self, name, schema):
        return _State(self.calls)

    def listTimers(self):
        self.calls.append("timers")
        return iter(sorted(self.timers))

    def registerTimer(self, ms):
        self.calls.append("timer")
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.calls.append("no timer")
        self.timers.discard(ms)


KEYS, COLUMNS = [("mid", "string")], ["mid", "ts", "is_new"]


@pytest.mark.parametrize("rule, held", [
    (p.FirstPerDay(KEYS, ["ts"], COLUMNS), False),
    (p.HeldReturning(KEYS, ["ts"], COLUMNS, "mid string, ts long, is_new string", 8), True),
    (p.HeldUniqueAndNew(KEYS, ["ts"], ["mid", "ts"], "mid string, ts long"), True),
    (p.LatestVersion(KEYS, ["ts"], COLUMNS, "mid string, ts long, is_new string", 0, True), True),
    (p.NewFlagRepair(KEYS, ["ts", "is_new"], COLUMNS, "is_new"), False)])
def test_a_rule_turns_to_its_state_a_few_times_for_many_keys(rule, held):
    handle, now = _Handle(), 0
    rule.init(handle)
    times = SimpleNamespace(getCurrentWatermarkInMs=lambda: now)
    rows = [Row(mid=f"m{k}", ts=1000 + k, is_new="1", _day=0) for k in range(500)]
    frames = isinstance(rule, p.NewFlagRepair)
    given = [pd.DataFrame([r.asDict() for r in rows])] if frames else rows
    out = list(rule.handleInputRows((0,), iter(given), times))
    if frames:
        out = [Row(**r) for frame in out for r in frame.to_dict("records")]
    assert len(handle.timers) == held
    if held:
        now, at = 10_000, handle.timers.pop()
        out += rule.handleExpiredTimer((0,), times, SimpleNamespace(getExpiryTimeInMs=lambda: at))
        assert not handle.timers
    assert Counter(r["mid"] for r in out) == Counter(f"m{k}" for k in range(500))
    assert len(handle.calls) < 20


def test_parts_of_a_state_grow_with_the_rows(spark, folder):
    spark.range(5_000).write.parquet(f"{folder}/events.parquet")
    cores = spark.sparkContext.defaultParallelism
    assert catalog._state_parts(spark, folder, "events", 100) == 50
    assert catalog._state_parts(spark, folder, "events", 5_000) == cores


def test_streamed_log_events_keep_all_fields_through_the_flag_rule(spark, folder):
    """Nested fields go through Python as one text: nulls in them, and in maps, come back as they were."""
    common = '"common":{"mid":"a","uid":null,"is_new":"1"}'
    texts = [f'{{{common},"start":{{"entry":null,"x":""}},"ts":86400000}}',
             f'{{{common},"page":{{"page_id":"q\\"\\n","during_time":7}},"displays":[{{"item":null}},{{}}],"actions":[],"ts":1}}',
             f'{{{common},"page":{{}},"err":{{"error_code":"9"}},"ts":172800000}}', "no event"]
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(f"{folder}/in")
    stream = readers.text_topic(spark, "text", path=f"{folder}/in")
    table = readers.text_topic(spark, "text", stream=False, path=f"{folder}/in")
    got = catalog._drained(spark, logs.repaired_log(stream), "log")
    want = logs.repaired_log(table).withColumn("value", F.when(F.size("faults") > 0, F.col("value")))
    assert set(got.columns) == set(want.columns)
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    plan = logs.repaired_events(split_log(stream)[0])._jdf.queryExecution().analyzed().toString()
    assert "to_json" in plan  # nothing nested goes to Python and back


def test_versions_carry_only_the_columns_their_window_needs(spark):
    got = catalog._version_feed(spark, SF, "province_id").columns
    assert "province_id" in got and not {"order_id", "user_id", "original_total_amount", "coupon_reduce_amount"} & set(got)


def test_entries_of_a_bucket_lie_many_to_a_value():
    state = p.Packed(_Handle(), "entries")
    rows = [(f"m{k}", k, None) for k in range(3 * p.PACKED + 1)]
    state.put(rows)
    state.append([("last", 2**62, 0.5)])
    assert len(state.state.rows) == 5 and list(state.get()) == [*rows, ("last", 2**62, 0.5)]
    state.put([])
    assert list(state.get()) == []


def test_cells_of_a_frame_stay_as_they_were():
    """Numbers that a frame would round, and nulls beside them."""
    rule = p.LatestVersion([("id", "bigint")], ["ts", "v"], ["id", "ts", "v", "x"], "", 0, True)
    framed, handle = p.Framed(rule, ["bigint", "bigint", "bigint", "double"], False, None), _Handle()
    framed.init(handle)
    now = 0
    times = SimpleNamespace(getCurrentWatermarkInMs=lambda: now)
    big = str(2**62 + 1)
    frame = pd.DataFrame([(big, "5", "9", "NaN"), (big, "5", "10", None), ("7", "6", "1", "0.1"), (None, "6", "1", "x")])
    assert list(framed.handleInputRows((0,), iter([frame]), times)) == []
    now, at = 10, min(handle.timers)
    out = list(framed.handleExpiredTimer((0,), times, SimpleNamespace(getExpiryTimeInMs=lambda: at)))
    got = {tuple(r) for f in out for r in f.itertuples(index=False)}
    assert got == {(big, "5", "10", None), ("7", "6", "1", "0.1"), (None, "6", "1", "x")}


def test_stores_write_without_counting_their_rows(spark):
    from tillstream.session import prepare
    prepare(spark, "UTC")
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows") == "false"


def test_an_inner_join_of_streams_ends_with_its_rows(spark, folder):
    """No micro-batch only to clear the state of a stream that is drained."""
    spark.range(10).selectExpr("id", "timestamp_seconds((id + 1) * 100000) as at").write.parquet(f"{folder}/in")

    def side(key, at):
        rows = spark.readStream.schema("id long, at timestamp").parquet(f"{folder}/in")
        return rows.withColumnsRenamed({"id": key, "at": at})
    joined = interval_join(side("k", "a"), side("j", "b"), ("k", "j"), ("a", "b"), "1 hour", "1 hour")
    for closing, batches in ((True, 2), (False, 1)):
        path = f"{folder}/{closing}"
        run.to_folder(joined, f"{path}/out", f"{path}/checkpoint", partitions=2, closing=closing)
        assert spark.read.parquet(f"{path}/out").count() == 10
        assert len([f for f in glob.glob(f"{path}/checkpoint/commits/*") if f.rsplit("/", 1)[1].isdigit()]) == batches


def test_a_stream_sums_once_by_the_ids_of_its_skus(spark, folder):
    """Equal to the table, where names are summed, also with ids that have a name twice, two names or none."""
    def dim(columns, *rows):
        return spark.createDataFrame(rows, columns)
    dims = {"sku_info": dim("id string, spu_id string, tm_id string, category3_id string",
                            ("1", "p", "t", "c"), ("2", "p", "t", "c"), ("3", None, "t", "x"), ("3", "q", "u", None)),
            "spu_info": dim("id string, spu_name string", ("p", "P"), ("p", "P"), ("q", "Q"), ("q", "R")),
            "base_trademark": dim("id string, tm_name string", ("t", "T")),
            "base_category3": dim("id string, name string, category2_id string", ("c", "C", "d")),
            "base_category2": dim("id string, name string, category1_id string", ("d", "D", "e")),
            "base_category1": dim("id string, name string", ("e", "E"))}
    rows = dim("order_detail_id string, sku_id string, user_id string, order_create_time string, split_total_amount string, rt timestamp",
               *[(str(n), sku, "u", f"2024-01-01 00:00:{n % 3:02d}", "1.10", None)
                 for n, sku in enumerate(["1", "2", "1", "3", "3", "9", None])],
               ("end", "1", "u", "2024-01-02 00:00:00", "1", None)).drop("rt")
    rows.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    run.to_folder(windows.spu_orders(stream, dims), f"{folder}/out", f"{folder}/checkpoint", partitions=2)
    want = windows.spu_orders(rows, dims).drop("ts").filter("stt < '2024-01-02'")
    got = spark.read.parquet(f"{folder}/out").drop("ts")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_lines_of_an_unknown_source_are_not_grouped(spark):
    topic = spark.createDataFrame([], "database string, table string, type string, data map<string,string>, "
                                      "old map<string,string>, ts string").repartition(3)
    codes = spark.createDataFrame([("c", "C", "p", None, None)], CODE_DICTIONARY)
    text = facts.order_detail(topic, codes, one_pass=True)._jdf.queryExecution().executedPlan().toString()
    group = text.index("ObjectHashAggregate")
    assert "_known" in text[group:]
