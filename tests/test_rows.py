"""Hand-made rows for the corners of filters, parsing, joins and windows."""

import json

import pytest
from pyspark.sql import functions as F

from tillstream.functions import scalars
from tillstream.functions.parsing import page_rows, split_changes, split_log
from tillstream.functions.tokens import explode_words, register_split
from tillstream.operators import filters, joins, windows as w
from tillstream.plans import facts, report, windows
from tillstream.schemas import CHANGE_EVENT, CODE_DICTIONARY
from tillstream.sources import sinks

LOG = {"common": {"mid": "m", "is_new": "1"}, "page": {"page_id": "home"}, "ts": 1}


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def changes(spark, *events):
    full = [{"database": "shop", "old": None, "ts": "1", **e} for e in events]
    return spark.createDataFrame(
        [tuple(e.get(n) for n in CHANGE_EVENT.fieldNames()) for e in full], CHANGE_EVENT)


def dictionary(spark, **codes):
    return spark.createDataFrame([(c, n, "p", None, None) for c, n in codes.items()],
                                 CODE_DICTIONARY)


def test_log_texts_that_are_no_events_go_to_bad(spark):
    bad = ["", "null", '{"common":{"mid":"m"},"pa', json.dumps([LOG]), "7",
           json.dumps({**LOG, "common": None}), json.dumps({**LOG, "common": {"uid": "u"}}),
           json.dumps({"common": {"mid": "m"}, "ts": 1})]
    good_df, bad_df = split_log(texts(spark, json.dumps(LOG), *bad))
    assert rows(good_df, "common.mid", "page.page_id", "ts") == [("m", "home", 1)]
    assert [v for v, in rows(bad_df, "value")] == sorted(bad, key=lambda v: repr((v,)))


def test_unknown_log_keys_do_not_matter_and_pages_flatten(spark):
    good, _ = split_log(texts(spark, json.dumps({**LOG, "extra": {"a": [1]}})))
    assert rows(page_rows(good), "mid", "page_id", "is_new", "ts") == [("m", "home", "1", 1)]


def test_change_texts(spark):
    good, bad = split_changes(texts(
        spark, '{"table":"t","type":"insert","data":{"id":5,"x":null},"ts":9}', '{"table":"t"}', ""))
    assert rows(good, F.col("data")["id"], "ts") == [("5", "9")]
    assert bad.count() == 2


def test_log_split_is_not_exclusive(spark):
    item = [{"item": "1"}, {"item": "2"}]
    events = [{**LOG, "err": {"error_code": "9"}, "displays": item, "actions": []},
              {"common": LOG["common"], "start": {"entry": "icon"}, "err": {"error_code": "8"},
               "displays": item, "ts": 2}, {**LOG, "displays": None}]
    good, _ = split_log(texts(spark, *map(json.dumps, events)))
    parts = filters.split_events(good)
    assert {k: v.count() for k, v in parts.items()} == {
        "error": 2, "start": 1, "display": 2, "action": 0, "page": 2}
    assert "displays" not in parts["page"].columns and "err" in parts["page"].columns
    out = [json.loads(v) for v, in rows(filters.item_json(parts["display"]), "value")]
    assert [o["item"] for o in out] == ["1", "2"] and out[0]["ts"] == 1
    assert json.loads(out[0]["common"]) == {"mid": "m", "is_new": "1"}


def test_changed_is_not_touched(spark):
    df = changes(spark, {"table": "t", "type": "update", "data": {"k": "1"}, "old": {"k": None}},
                 {"table": "t", "type": "update", "data": {"k": "2"}, "old": {"k": "0"}},
                 {"table": "t", "type": "update", "data": {"k": "3"}, "old": {"j": "0"}},
                 {"table": "t", "type": "insert", "data": {"k": "4"}})
    key = F.col("data")["k"]
    assert rows(df.filter(filters.changed("k")), key) == [("2",)]
    assert rows(df.filter(filters.in_old("k")), key) == [("1",), ("2",)]


def test_cart_counts_rises_only(spark):
    def update(id_, new, old):
        return {"table": "cart_info", "type": "update",
                "data": {"id": id_, "sku_num": new, "source_type": "c"}, "old": {"sku_num": old}}
    df = changes(spark, update("up", "5", "2"), update("down", "2", "5"), update("same", "3", "3"),
                 update("text", "many", "1"), update("null", "3", None),
                 {"table": "cart_info", "type": "insert",
                  "data": {"id": "new", "sku_num": "4", "source_type": "c"}},
                 {"table": "cart_info", "type": "insert",
                  "data": {"id": "unknown code", "sku_num": "4", "source_type": "?"}})
    assert rows(facts.cart_adds(df, dictionary(spark, c="C")), "id", "sku_num", "dic_name") == [
        ("new", 4, "C"), ("up", 3, "C")]


def test_favours_of_another_table_do_not_pass(spark):
    back = {"type": "update", "data": {"id": "1", "is_cancel": "0"}, "old": {"is_cancel": "1"}}
    df = changes(spark, {**back, "table": "favor_info"}, {**back, "table": "cart_info"})
    assert facts.favours(df).count() == 1


def test_cancelled_needs_an_update(spark):
    df = spark.createDataFrame(
        [("insert", None, "1003"), ("update", {"order_status": "1001"}, "1003"),
         ("update", {"order_status": "1001"}, "1004"), ("update", {"total_amount": "1"}, "1003")],
        "type string, old map<string,string>, order_status string")
    assert filters.cancelled(df).count() == 1


def test_wide_fact_keeps_unmatched_lines_and_drops_unknown_codes(spark):
    line = {"table": "order_detail", "type": "insert"}
    df = changes(
        spark,
        {**line, "data": {"id": "1", "order_id": "o", "source_type": "c", "sku_num": "3",
                          "order_price": "1.15"}},
        {**line, "data": {"id": "2", "order_id": "o", "source_type": "?"}},
        {**line, "data": {"id": "3", "order_id": "none", "source_type": "c"}},
        {"table": "order_info", "type": "insert", "data": {"id": "o", "user_id": "u"}},
        {"table": "order_detail_coupon", "type": "insert",
         "data": {"order_detail_id": "1", "coupon_id": "k"}})
    out = facts.order_detail(df, dictionary(spark, c="C"))
    assert out.columns == facts.ORDER_DETAIL
    got = rows(out, "order_detail_id", "coupon_id", "activity_id", "dic_name",
               F.col("split_original_amount").cast("string"))
    assert got == [("1", "k", None, "C", "3.45")]


def test_refund_names_are_two_lookups(spark):
    df = changes(spark, {"table": "order_refund_info", "type": "insert",
                         "data": {"id": "1", "order_id": "o", "refund_type": "a",
                                  "refund_reason_type": "b", "create_time": "2024-01-02 03:04:05"}},
                 {"table": "order_refund_info", "type": "insert",
                  "data": {"id": "2", "order_id": "x", "refund_type": "?"}},
                 {"table": "order_info", "type": "update", "old": {"order_status": None},
                  "data": {"id": "o", "order_status": "1005", "province_id": "9"}},
                 {"table": "order_info", "type": "update", "old": {"x": "1"},
                  "data": {"id": "x", "order_status": "1005", "province_id": "8"}})
    out = facts.refunds(df, dictionary(spark, a="A", b="B"))
    assert rows(out, "id", "province_id", "date_id", "refund_type_name",
                "refund_reason_type_name") == [
        ("1", "9", "2024-01-02", "A", "B"), ("2", None, None, None, None)]


def test_missing_middle_hop_gives_nulls_after_it(spark):
    def table(schema, *data):
        return spark.createDataFrame(list(data), schema)
    dims = {"sku_info": table("id string, spu_id string, tm_id string, category3_id string",
                              ("s", "p", "t", "c3")),
            "spu_info": table("id string, spu_name string", ("p", "P")),
            "base_trademark": table("id string, tm_name string"),
            "base_category3": table("id string, name string, category2_id string",
                                    ("c3", "C3", "c2")),
            "base_category2": table("id string, name string, category1_id string"),
            "base_category1": table("id string, name string", ("c1", "C1"))}
    df = spark.createDataFrame([("s",), ("unknown",)], "sku_id string")
    got = rows(joins.enrich_sku(df, dims), "sku_id", "spu_name", "trademark_name",
               "category3_name", "category2_id", "category2_name", "category1_name")
    assert got == [("s", "P", None, "C3", "c2", None, None),
                   ("unknown", None, None, None, None, None, None)]


def test_an_event_takes_the_newest_route_not_later_than_it(spark):
    schema = "source_table string, sink_table string, sink_columns string, sink_pk string, since int"
    config = spark.createDataFrame([("t", "old", "id", None, 10), ("t", "new", "id", None, 20),
                                    ("t", "new", "id", None, 20), ("u", "a", "id", None, 5)], schema)
    events = spark.createDataFrame([("t", "9", 1), ("t", "10", 2), ("t", "19", 3), ("t", "20", 4),
                                    ("u", "99", 5), ("v", "99", 6), ("t", "x", 7)], "table string, ts string, n int")
    got = rows(joins.route_rows(events, config, "since"), "n", "sink_table")
    assert sorted(got) == [(2, "old"), (3, "old"), (4, "new"), (5, "a")]


def test_without_versions_equal_routes_count_once_and_different_ones_are_an_error(spark):
    schema = "source_table string, sink_table string, sink_columns string, sink_pk string"
    events = spark.createDataFrame([("t", "1", 1)], "table string, ts string, n int")
    same = spark.createDataFrame([("t", "a", "id", None)] * 2, schema)
    assert rows(joins.route_rows(events, same), "n", "sink_table") == [(1, "a")]
    other = spark.createDataFrame([("t", "a", "id", None), ("t", "b", "id", None)], schema)
    with pytest.raises(Exception, match="several routes and no version of table t"):
        joins.route_rows(events, other).collect()


def test_a_control_table_has_a_bound(spark, monkeypatch):
    monkeypatch.setattr(joins, "MAX_ROUTES", 1)
    schema = "source_table string, sink_table string, sink_columns string, sink_pk string"
    config = spark.createDataFrame([("t", "a", "id", None), ("u", "b", "id", None)], schema)
    with pytest.raises(ValueError, match="control table"):
        joins.route_rows(spark.createDataFrame([], "table string, ts string"), config)


def test_routing_prunes_columns_and_drops_deletes(spark):
    config = spark.createDataFrame([("t", "dim_t", "id, name", None)],
                                   "source_table string, sink_table string, "
                                   "sink_columns string, sink_pk string")
    data = {"id": "1", "name": "n", "secret": "s"}
    df = changes(spark, *[{"table": "t", "type": t, "data": data} for t in
                          ("insert", "update", "delete", "bootstrap-insert", "bootstrap-start")],
                 {"table": "u", "type": "insert", "data": data})
    out = sinks.routed(df, config)
    keys = F.array_join(F.array_sort(F.map_keys("data")), ",")  # a map has no order
    assert rows(out, "type", "sink_table", keys) == [
        (t, "dim_t", "id,name") for t in ("bootstrap-insert", "insert", "update")]


def test_fraction_digits_are_trailing_zeros(spark):
    df = texts(spark, "2024-01-01 00:00:00.9Z", "2024-01-01 00:00:00.042Z",
               "2024-01-01 00:00:00.42Z")
    assert [m % 1000 for m, in rows(df, scalars.zoned_ms(F.col("value")))] == [42, 420, 900]


def test_zone_moves_text_times(spark):
    from tillstream.session import prepare
    df = texts(spark, "2024-01-01 08:00:00")
    try:
        prepare(spark)
        assert rows(df, scalars.text_ms(F.col("value"))) == [(1704067200000,)]
        assert rows(df, scalars.ms_date_time_text(F.lit(1704067200000))) == [
            ("2024-01-01 08:00:00",)]
    finally:
        prepare(spark, "UTC")


def test_words(spark):
    df = texts(spark, "Red Widget-7", "小米手机 Pro米", "!!", "中", None)
    got = [v for v, in rows(explode_words(df, "value"), "word")]
    assert got == sorted(["red", "widget", "7", "小米", "米手", "手机", "pro", "米", "!!", "中"],
                         key=lambda v: repr((v,)))


def test_own_segmenter_and_table_function(spark):
    df = texts(spark, "a-b", "c")
    out = explode_words(df, "value", segment=lambda s: s.str.split("-"))
    assert rows(out, "word") == [("a",), ("b",), ("c",)]
    register_split(spark, split=lambda t: iter(t.split("-")) if t != "c" else iter([t[9]]))
    df.createOrReplaceTempView("searched_texts")
    got = spark.sql("select word from searched_texts, lateral split_words(value)")
    assert rows(got, "word") == [("a",), ("b",), ("c",)]


def test_sql_words_are_the_frame_words(spark):
    df = texts(spark, "Red_Hat x2 新款 手 机壳a", "...", "", "é-É 3", None)
    register_split(spark)
    df.createOrReplaceTempView("split_texts")
    got = spark.sql("select value, word from split_texts, lateral split_words(value)")
    assert rows(got, "value", "word") == rows(explode_words(df, "value"), "value", "word")


def test_a_failed_split_gives_the_text_once(spark):
    def half(text):
        yield text[:1]
        raise ValueError
    register_split(spark, "half_words", half)
    texts(spark, "ab").createOrReplaceTempView("half_texts")
    assert rows(spark.sql("select word from half_texts, lateral half_words(value)"), "word") == [("ab",)]


def test_null_duration_counts_as_zero(spark):
    schema = ("vc string, ch string, ar string, is_new string, last_page_id string, "
              "during_time bigint, ts bigint")
    pages = spark.createDataFrame([("v", "c", "a", "1", None, None, 1000),
                                   ("v", "c", "a", "1", "home", 7, 2000)], schema)
    out = windows.traffic(pages, pages.limit(1), pages.limit(0))
    assert rows(out, "stt", "uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct") == [
        ("1970-01-01 00:00:00", 1, 1, 2, 7, 0)]


def test_windows_are_half_open(spark):
    df = spark.createDataFrame([(9_999,), (10_000,)], "ts bigint")
    out = w.tumble(w.event_time(df).drop("ts"), [], [F.count("*").alias("n")])
    assert rows(out, "stt", "edt", "n") == [
        ("1970-01-01 00:00:00", "1970-01-01 00:00:10", 1),
        ("1970-01-01 00:00:10", "1970-01-01 00:00:20", 1)]


def test_gmv_of_a_day_and_of_no_day(spark):
    df = spark.createDataFrame([("2024-01-01 23:59:50", 1.1), ("2024-01-02 00:00:00", 2.2),
                                ("2024-01-02 12:00:00", 3.3)], "stt string, order_amount double")
    assert rows(report.gmv(df, 20240102), "order_amount") == [(5.5,)]
    assert rows(report.gmv(df), "order_amount") == [(None,)]


def test_order_amounts_compat(spark):
    df = spark.createDataFrame(
        [(str(i), "u", "2024-01-01 00:00:01", "10", "1", None, "30", "5", "2") for i in range(3)],
        "order_detail_id string, user_id string, order_create_time string, "
        "split_original_amount string, split_activity_amount string, "
        "split_coupon_amount string, original_total_amount string, "
        "activity_reduce_amount string, coupon_reduce_amount string")
    columns = ("order_unique_user_count", "order_activity_reduce_amount",
               "order_coupon_reduce_amount", "order_original_total_amount")
    assert rows(windows.orders(df), *columns) == [(1, 3.0, 0.0, 30.0)]
    assert rows(windows.orders(df, compat=True), *columns) == [(1, 15.0, 6.0, 90.0)]


def test_window_sink_leaves_other_columns_out(spark, folder):
    df = spark.createDataFrame([("a", "b", 1)], "stt string, secret string, n int")
    sinks.window_batch(["stt", "n"], "parquet", path=folder)(df, 3)
    assert rows(spark.read.parquet(folder), "stt", "n", "_batch", "_run") == [("a", 1, 3, "batch")]
