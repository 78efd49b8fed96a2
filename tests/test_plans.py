"""Physical plans hold at scale: pruned scans, partial work before shuffles, no hidden gathers."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF
from tillstream import catalog as driver
from tillstream.operators import joins, state
from tillstream.plans import report, windows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lines(df, pattern):
    return [line for line in plan(df).splitlines() if re.search(pattern, line)]


BATCH = [name for name in driver.queries() if not name.startswith("stream_")
         and name not in ("dimension_sync", "dimension_partial_rows", "upserted_coupons",
                          "upserted_deletes", "upserted_by_two_streams", "daily_gmv_stored", "order_detail_topic", "topic_round_trip",
                          "window_table_sink")]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_no_python_and_no_single_task(spark, name):
    text = plan(driver.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "ArrowEval" not in text
    # a keyless sum gathers one partial row per task, nothing else may
    singles = [s for s in text.split("Exchange SinglePartition")[1:]]
    assert all("partial_sum" in s for s in singles)


@pytest.mark.parametrize("name", ["latest_lines", "first_copies", "unique_visitors",
                                  "daily_page_firsts"])
def test_first_rows_are_cut_before_the_shuffle(spark, name):
    df = driver.queries()[name](spark, SF)
    assert lines(df, r"WindowGroupLimit.*Partial") and lines(df, r"WindowGroupLimit.*Final")


def test_flag_repair_hashes_numbers(spark):
    text = plan(driver.queries()["new_flag_repair"](spark, SF))
    assert "SortAggregate" not in text and "partial_min" in text


def test_order_window_reads_its_lines_once(spark):
    df = driver.queries()["order_window"](spark, SF)
    assert len(lines(df, r"FileScan parquet \[l_")) == 1


def test_scans_are_pruned_and_filters_pushed(spark, folder):
    columns = [f"c{i} string" for i in range(20)]
    spark.range(10).select(
        F.lit("2024-01-02 00:00:00").alias("stt"), F.lit(1.0).alias("order_amount"),
        *[F.lit("x").alias(c.split()[0]) for c in columns]).write.parquet(folder)
    scan, = lines(report.gmv(spark.read.parquet(folder), 20240102), "FileScan")
    assert "ReadSchema: struct<stt:string,order_amount:double>" in scan
    assert "GreaterThanOrEqual(stt,2024-01-02 00:00:00)" in scan
    assert "LessThan(stt,2024-01-03 00:00:00)" in scan


def test_wide_fact_shuffles_its_lines_twice(spark):
    """Once by line for activity and coupon, once by order; code names need none."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = driver.queries()["order_detail_wide"](spark, SF)
        assert len(lines(df, r"Exchange hashpartitioning\(order_detail_id#")) == 1
        assert len(lines(df, r"Exchange hashpartitioning\(order_id#")) == 1
        assert len(lines(df, "SortMergeJoin")) == 3
        assert len(lines(df, "BroadcastHashJoin")) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("one_pass, key", [(False, "order_detail_id"), (True, "order_id")])
def test_a_line_of_an_unknown_source_is_never_moved(spark, one_pass, key):
    """The dictionary is below the lines' first shuffle to a join."""
    from tillstream.plans import facts
    from tillstream.sources import samples
    changes = samples.changes(spark, SF, "order_detail", "order_detail_activity", "order_detail_coupon", "order_info")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(facts.order_detail(changes, samples.dictionary(spark, SF), one_pass=one_pass))
        assert text.index("BroadcastHashJoin") > text.index(f"Exchange hashpartitioning({key}#")
        named = facts.joined_lines(changes, one_pass=one_pass, dictionary=samples.dictionary(spark, SF))
        later = facts.named_lines(facts.joined_lines(changes, one_pass=one_pass), samples.dictionary(spark, SF))
        columns = [c for c in facts.ORDER_DETAIL if c not in ("pt", "ts", "old")]
        assert named.count() == later.count() > 0 and named.select(columns).exceptAll(later.select(columns)).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_pass_scans_the_topic_once(spark, folder):
    """Lines and orders come from the same groups; the rows are those of the joins, also where an
    order has a third of all lines."""
    from tillstream.plans import facts
    from tillstream.sources import readers, samples
    changes = samples.changes(spark, SF, "order_detail", "order_detail_activity", "order_detail_coupon", "order_info")
    hot = F.pmod(F.xxhash64(F.col("data")["id"]), F.lit(3)) == 0
    moved = F.map_concat(F.map_filter("data", lambda k, v: k != "order_id"), F.create_map(F.lit("order_id"), F.lit("1")))
    changes = changes.withColumn("data", F.when((F.col("table") == "order_detail") & hot, moved).otherwise(F.col("data")))
    changes.drop("pt").select(F.to_json(F.struct("*")).alias("value")).write.text(folder)
    topic = readers.change_topic(spark, "text", stream=False, path=folder)
    grouped, joined = (facts.joined_lines(topic, one_pass=one).withColumn("old", F.to_json("old")) for one in (True, False))
    assert grouped.exceptAll(joined.select(grouped.columns)).count() == 0 and grouped.count() == joined.count()
    _plain_settings(spark, True)
    try:
        text = plan(facts.joined_lines(topic, one_pass=True))
        assert text.count("FileScan") == 1 and text.count("ReusedExchange") == 1
    finally:
        _plain_settings(spark, False)


def test_broadcast_only_what_a_count_proves_small(spark):
    side = spark.range(50)
    assert lines(joins.if_small(side, 50), ".*") and \
        "BroadcastHashJoin" in plan(spark.range(9).join(joins.if_small(side, 50), "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(spark.range(9).join(joins.if_small(side, 49), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _sizes(df):
    return [n for _, n in df.groupBy(F.spark_partition_id()).count().collect()]


def _hot(spark, rows, spread_ms):
    """A third of all rows of one device, all within `spread_ms`; the others over 2,000 devices."""
    mid = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 2000))
    return spark.range(0, rows, 1, 8).select(
        F.col("id").alias("event_id"), mid.alias("mid"), F.pmod(F.xxhash64("id"), F.lit(spread_ms)).alias("ts"),
        F.when(F.col("id") % 4 == 0, "p").alias("last_page_id"), F.lit("1").alias("is_new"))


def _plain_settings(spark, on):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                "spark.sql.shuffle.partitions": "16"}
    for key, value in settings.items():
        spark.conf.set(key, value) if on else spark.conf.unset(key)
    if not on:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_heavy_key_is_cut_in_parts_and_others_are_not_copied(spark):
    """A third of all rows on one key: it is dealt over as many parts as it needs, no other key is."""
    rows = 60_000
    df = _hot(spark, rows, 10 ** 9)
    right = df.groupBy("mid").agg(F.count("*").alias("n"), F.lit(1).alias("x"))
    _plain_settings(spark, True)
    try:
        joined = joins.spread_join(df, right, "mid", "left", ["ts"], "n", part_rows=250)
        sizes = _sizes(joined)
        assert sum(sizes) == rows and max(sizes) < 2 * rows / 16
        assert max(_sizes(df.join(right, "mid"))) >= rows / 3
        assert joined.filter("x is null").count() == 0 and "n" not in joined.columns
        heavy = joins.heavy_keys(right, ["mid"], "n", 250)
        assert [tuple(r) for r in heavy.collect()] == [("hot", 80)]
    finally:
        _plain_settings(spark, False)


def test_a_heavy_hour_of_a_device_is_cut_and_bounces_stay_exact(spark):
    """One device with a third of all rows in one hour: no task of the look-ahead window gets more
    than twice the median, and the bounces are those of uncut slices."""
    df = _hot(spark, 48_000, 3_600_000)
    whole = state.bounces(df, ["ts", "event_id"], gap_ms=50)
    _plain_settings(spark, True)
    try:
        cut = state.bounces(df, ["ts", "event_id"], gap_ms=50, part_rows=200)
        assert sorted(r[0] for r in cut.select("event_id").collect()) == sorted(r[0] for r in whole.select("event_id").collect())
        widest = state.bounces(df, ["ts", "event_id"], gap_ms=1, entry=F.lit(True), part_rows=200)
        sizes = sorted(_sizes(widest))
        assert sizes[-1] < 2 * sizes[len(sizes) // 2]
    finally:
        _plain_settings(spark, False)


def test_shipped_settings_of_the_flag_repair_copy_no_ordinary_key(spark):
    text = plan(driver.queries()["new_flag_repair"](spark, SF))
    assert "TakeOrderedAndProject(limit=10000" in text and "coalesce(_parts#" in text


def test_skewed_fact_join_is_split(spark):
    """A fact joined to a large dimension on a hot key: adaptive execution splits the partition."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
                "spark.sql.shuffle.partitions": "16"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
            .alias("sku_id"), F.col("id").alias("v"))
        side = spark.range(0, 20_000, 1, 8).select(
            F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
            F.col("id").alias("name"))
        out = joins.enrich(fact, side, "sku_id", {"name": "name"})
        assert len(out.collect()) == 300_000
        assert "skew=true" in plan(out)
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_bounce_slices_split_a_hot_device(spark):
    """The look-ahead window is keyed by device, time slice and part, never by device alone."""
    df = spark.createDataFrame([(1, "m", None, 5)], "id int, mid string, last_page_id string, ts int")
    exchanges = lines(state.bounces(df, ["ts", "id"]), "Exchange hashpartitioning")
    assert any("mid#" in e and "_slice#" in e and "_part#" in e for e in exchanges)
    assert all("_slice#" in e or "_heavy" in e or "_whole" in e or "FLOOR" in e or "_groupingexpression" in e for e in exchanges)


def test_order_window_sums_before_it_compares_users(spark):
    details = spark.createDataFrame([], "order_detail_id string, user_id string, "
                                        "order_create_time string, split_original_amount string, "
                                        "split_activity_amount string, split_coupon_amount string")
    text = plan(windows.orders(details.repartition(2)))
    window = text.index("Window [lag(")
    assert "partial_sum" in text[window:]


@pytest.mark.parametrize("name", ["spu_order_window", "refund_window"])
def test_only_sums_meet_the_dimensions(spark, name):
    """Between the scan of the lines and the join of the sku dimensions lies a whole sum."""
    text = plan(driver.queries()[name](spark, SF))
    join = text.index("sku_id#", text.index("Join"))
    below = text[join:text.index("FileScan parquet [l_")]
    assert "partial_count" in below and below.index("HashAggregate") < below.index("partial_count")


def test_a_report_opens_one_day_of_files(spark, folder):
    from tillstream.sources import sinks
    rows = spark.range(100).selectExpr("concat('2024-01-', lpad(id % 20 + 1, 2, '0'), ' 00:00:00') as stt",
                                       "cast(id as double) as order_amount")
    sinks.window_batch(["stt", "order_amount"], "parquet", path=folder)(rows, 0)
    df = report.gmv(spark.read.parquet(folder), 20240103)
    scan, = lines(df, "FileScan")
    assert "PartitionFilters: [isnotnull(_day#" in scan and "2024-01-03" in scan
    assert df.first()[0] == 2 + 22 + 42 + 62 + 82


def test_changes_of_a_keyed_table_are_folded_before_they_are_shuffled(spark, folder):
    from tillstream.schemas import strings
    from tillstream.sources.keyed import KeyedTable
    table = KeyedTable(spark, folder, "id", strings("id", "v"))
    for batch in range(3):
        table.upsert(spark.range(100).selectExpr("cast(id as string) id", "cast(id as string) v"), batch)
    text = plan(table.read())
    exchange = text.index("Exchange hashpartitioning(id")
    assert "partial_max_by" in text[exchange:] and text.count("Exchange") == 1
    assert table.read().count() == 100


@pytest.mark.parametrize("name", ["routed_changes", "routed_versions"])
def test_routing_sends_the_config_and_never_moves_the_topic(spark, name):
    text = plan(driver.queries()[name](spark, SF))
    assert "BroadcastHashJoin" in text and "BuildRight" in text and "SortMergeJoin" not in text
    topic = text[:text.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in topic
