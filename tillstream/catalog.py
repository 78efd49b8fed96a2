"""Every operator as a query over the sample tables: name -> (spark, folder) -> DataFrame.

Amounts leave as double and emission times are left out, so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions import scalars
from tillstream.functions.parsing import split_changes, split_log
from tillstream.functions.tokens import explode_words
from tillstream.operators import filters, joins, state
from tillstream.operators.windows import event_time, traffic_rows, tumble
from tillstream.plans import dim, facts, logs, report, windows
from tillstream.session import prepare, work_dir
from tillstream.sources import readers, samples, sinks
from tillstream.sources.keyed import DELETED, KeyedTable
from tillstream.sources.samples import VERSION, load
from tillstream.schemas import WINDOW_COLUMNS, strings
from tillstream.streaming import run
from tillstream.streaming import state as streams

Query = Callable[[SparkSession, str], DataFrame]
ZONE = "UTC"
_QUERIES: dict[str, Query] = {}

HOUR, DAY = "1 hour", "1 day"
EVENT = ("ts", "event_id")
SIX_HOURS_MS, DAY_MS = 6 * 3_600_000, 24 * 3_600_000


def query(make: Query) -> Query:
    def run_query(spark: SparkSession, sf: str) -> DataFrame:
        out = make(prepare(spark, ZONE), sf)
        money = [f.name for f in out.schema.fields if isinstance(f.dataType, T.DecimalType)]
        return out.withColumns({c: F.col(c).cast("double") for c in money})
    _QUERIES[make.__name__] = run_query
    return make


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _fact(df: DataFrame) -> DataFrame:
    """A wide fact without its clock columns, its former values as one text."""
    return df.withColumn("old", F.to_json("old")).drop("pt", "ts")


# -- functions -----------------------------------------------------------------

@query
def scalar_amounts(spark, sf):
    lines = load(spark, sf, "lineitem")
    price = F.col("l_extendedprice").cast("string")
    quantity = F.col("l_quantity").cast("string")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        scalars.times(quantity, price).alias("original_amount"),
        scalars.whole(F.col("l_returnflag")).alias("flag_number"),
        scalars.amount_or_zero(F.col("l_linestatus")).alias("status_amount"),
        scalars.choose(F.col("l_quantity") > 25, F.lit("many"), F.lit("few")).alias("size"))


@query
def time_texts(spark, sf):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    rows = load(spark, sf, "events").select("event_id", ms.alias("ms")).select(
        "event_id", "ms", scalars.ms_date_text(F.col("ms")).alias("day"),
        scalars.ms_date_time_text(F.col("ms")).alias("time"))
    return rows.select("*", scalars.text_ms(F.col("time")).alias("time_ms"),
                       scalars.text_ms(F.col("day")).alias("day_ms"),
                       scalars.date_text(F.col("time")).alias("time_day"),
                       scalars.day_number(scalars.ms_time(F.col("ms"))).alias("day_number"))


@query
def zoned_millis(spark, sf):
    events = samples.with_k(load(spark, sf, "events"))
    at = F.col("ts").cast("timestamp")
    digits = F.substring(F.date_format(at, "SSS"), F.lit(1), F.col("k") % 3 + 1)
    text = F.concat(F.date_format(at, scalars.DATE_TIME), F.lit("."), digits, F.lit("Z"))
    return events.select("event_id", text.alias("text"), scalars.zoned_ms(text).alias("ms"))


@query
def camel_names(spark, sf):
    return scalars.rename_columns(load(spark, sf, "orders").drop("o_orderdate"))


@query
def keyword_words(spark, sf):
    docs = load(spark, sf, "documents").select("text")
    return explode_words(docs, "text").groupBy("word").agg(F.count("*").alias("n"))


# -- predicates ----------------------------------------------------------------

@query
def log_unreadable(spark, sf):
    _, bad = split_log(samples.raw_log(spark, sf))
    return bad.groupBy(
        F.when(F.try_parse_json("value").isNull(), "cut").otherwise("incomplete").alias("kind"),
        F.get_json_object("value", "$.common.mid").alias("mid")).agg(F.count("*").alias("n"))


@query
def log_readable(spark, sf):
    good, _ = split_log(samples.raw_log(spark, sf))
    return good.select("common.*", "page.page_id", "page.last_page_id", "page.during_time",
                       F.col("start")["entry"].alias("entry"),
                       F.col("err")["error_code"].alias("error_code"),
                       F.size(F.coalesce("displays", F.array())).alias("displays"),
                       F.size(F.coalesce("actions", F.array())).alias("actions"), "ts")


@query
def change_route(spark, sf):
    rows = filters.route(samples.changes(spark, sf), "order_info", "insert",
                         database=samples.DATABASE)
    return filters.payload(rows, "order_info", "ts")


@query
def changed_fields(spark, sf):
    rows = filters.route(samples.changes(spark, sf, "payment_info"), "payment_info", "update")
    return filters.payload(rows.filter(filters.changed("payment_status")), "payment_info")


@query
def touched_fields(spark, sf):
    rows = filters.route(samples.changes(spark, sf, "payment_info"), "payment_info", "update")
    return filters.payload(rows.filter(filters.in_old("payment_status")), "payment_info")


@query
def entry_pages(spark, sf):
    return filters.entry_pages(samples.pages(spark, sf)).select("event_id", "mid", "ts")


@query
def page_set(spark, sf):
    return filters.on_pages(samples.pages(spark, sf), "home").select("event_id", "page_id", "ts")


@query
def logged_in_entries(spark, sf):
    return filters.logged_in_entries(samples.pages(spark, sf)).select("event_id", "uid", "ts")


@query
def keyword_searches(spark, sf):
    return filters.keyword_searches(samples.searches(spark, sf)).select("item", "ts")


@query
def live_records(spark, sf):
    """Records without tombstones: errors stand for deleted keys."""
    events = load(spark, sf, "events")
    rows = events.select("event_id", F.when(F.col("event_type") != "error", F.col("props"))
                         .alias("value")).fillna("", ["value"])
    return filters.not_tombstone(rows)


@query
def routed_changes(spark, sf):
    rows = sinks.routed(samples.changes(spark, sf), samples.routes(spark))
    return rows.select("table", "type", "sink_table", "ts", F.col("data")["id"].alias("id"),
                       F.col("data")["name"].alias("name"),
                       F.array_join(F.array_sort(F.map_keys("data")), ",").alias("keys"))


@query
def routed_versions(spark, sf):
    """Change events routed by the config as it was at their time."""
    rows = sinks.routed(samples.changes(spark, sf, "sku_info", "base_province", "not_listed"),
                        samples.route_versions(spark), "version")
    return rows.select("table", "type", "sink_table", "ts", F.col("data")["id"].alias("id"),
                       F.array_join(F.array_sort(F.map_keys("data")), ",").alias("keys"))


# -- log split -----------------------------------------------------------------

def _split(spark, sf) -> dict[str, DataFrame]:
    return logs.split_click_log(samples.raw_log(spark, sf))


def _items(df: DataFrame, *keys: str) -> DataFrame:
    value = filters.item_json(df)
    return value.select(
        *[F.get_json_object("value", f"$.{k}").alias(k) for k in (*keys, "page_id")],
        F.get_json_object("value", "$.ts").cast("long").alias("ts"),
        F.get_json_object("value", "$.common").alias("common"))


@query
def log_pages(spark, sf):
    return _split(spark, sf)["page"].select(
        "common.*", "page.*", F.col("err")["error_code"].alias("error_code"), "ts")


@query
def log_starts(spark, sf):
    return _split(spark, sf)["start"].select(
        "common.*", F.col("start")["entry"].alias("entry"),
        F.col("start")["loading_time"].alias("loading_time"), "ts")


@query
def log_displays(spark, sf):
    return _items(_split(spark, sf)["display"], "pos_id", "item")


@query
def log_actions(spark, sf):
    return _items(_split(spark, sf)["action"], "pos_id", "action_id")


@query
def log_errors(spark, sf):
    return _split(spark, sf)["error"].select(
        "common.*", "page.page_id", F.col("err")["error_code"].alias("error_code"),
        F.col("err")["msg"].alias("msg"), "ts")


# -- facts ---------------------------------------------------------------------

# the parts of the change topic the wide order fact reads
_ORDER_TABLES = ("order_detail", "order_detail_activity", "order_detail_coupon", "order_info")


def _details(spark, sf) -> DataFrame:
    return facts.order_detail(samples.changes(spark, sf, *_ORDER_TABLES),
                              samples.dictionary(spark, sf), samples.DATABASE)


@query
def order_detail_wide(spark, sf):
    return _fact(_details(spark, sf))


@query
def order_detail_topic(spark, sf):
    """The wide order fact from the raw topic of change texts, read and parsed once."""
    path = work_dir(spark, "change_topic")
    sinks.append_batch(path)(samples.changes(spark, sf, *_ORDER_TABLES).drop("pt"), 0)
    topic = readers.change_topic(spark, "text", stream=False, path=path)
    return _fact(facts.order_detail(topic, samples.dictionary(spark, sf), samples.DATABASE, one_pass=True))


@query
def placed_orders(spark, sf):
    return _fact(facts.placed_orders(_details(spark, sf)))


@query
def cancelled_orders(spark, sf):
    return _fact(facts.cancelled_orders(_details(spark, sf)))


@query
def cart_adds(spark, sf):
    return facts.cart_adds(samples.changes(spark, sf, "cart_info"), samples.dictionary(spark, sf))


@query
def paid_orders(spark, sf):
    return facts.payments(samples.changes(spark, sf, "payment_info"), _details(spark, sf),
                          samples.dictionary(spark, sf)).drop("pt")


@query
def paid_orders_in_span(spark, sf):
    """Payments at most 400 days apart from the line they pay."""
    return facts.payments(samples.changes(spark, sf, "payment_info"), _details(spark, sf),
                          samples.dictionary(spark, sf), span="400 days").drop("pt")


def _refunded(spark, sf) -> DataFrame:
    return facts.refunds(samples.changes(spark, sf, "order_refund_info", "order_info"),
                         samples.dictionary(spark, sf))


@query
def order_refunds(spark, sf):
    return _refunded(spark, sf).drop("row_op_ts")


@query
def coupons_received(spark, sf):
    return facts.coupons_received(samples.changes(spark, sf, "coupon_use"))


@query
def coupons_ordered(spark, sf):
    return facts.coupons_ordered(samples.changes(spark, sf, "coupon_use"))


@query
def coupons_paid(spark, sf):
    return facts.coupons_paid(samples.changes(spark, sf, "coupon_use"))


@query
def favourites_added(spark, sf):
    return facts.favours(samples.changes(spark, sf, "favor_info"))


@query
def comment_facts(spark, sf):
    return facts.comments(samples.changes(spark, sf, "comment_info"), samples.dictionary(spark, sf))


@query
def registered_users(spark, sf):
    return facts.registrations(samples.changes(spark, sf, "user_info"))


# -- lookups -------------------------------------------------------------------

@query
def lines_with_orders(spark, sf):
    """Order lines joined to their orders, both rebuilt from change events."""
    changes = samples.changes(spark, sf, "order_detail", "order_info")
    lines = filters.payload(filters.route(changes, "order_detail", "insert"), "order_detail")
    orders = filters.payload(filters.route(changes, "order_info", "insert"), "order_info")
    orders = orders.select(F.col("id").alias("order"), "user_id", "province_id")
    return lines.select("id", "order_id", "sku_id", "create_time") \
        .join(orders, F.col("order_id") == F.col("order")).drop("order")


@query
def customer_provinces(spark, sf):
    customers = load(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("province_id"))
    return joins.enrich(customers, samples.dimensions(spark, sf)["base_province"], "province_id",
                        {"province_name": "name"})


@query
def coded_priorities(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    codes = samples.dictionary(spark, sf)
    named = joins.decode(orders, codes, {"o_orderpriority": "priority_name"}, how="inner")
    return joins.decode(named, codes, {"o_orderstatus": "status_name"})


def _sku_lines(spark, sf) -> DataFrame:
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("sku_id"))


@query
def sku_chain_six(spark, sf):
    return joins.enrich_sku(_sku_lines(spark, sf), samples.dimensions(spark, sf))


@query
def sku_chain_five(spark, sf):
    return joins.enrich_sku(_sku_lines(spark, sf), samples.dimensions(spark, sf),
                            joins.FIVE_HOPS)


# -- per-key rules -------------------------------------------------------------

@query
def new_flag_repair(spark, sf):
    return state.repair_new_flag(samples.pages(spark, sf)).select(
        "event_id", "mid", "is_new", "ts")


@query
def unique_visitors(spark, sf):
    return logs.unique_visitors(samples.pages(spark, sf), EVENT).select("event_id", "mid", "ts")


@query
def daily_page_firsts(spark, sf):
    return state.daily_page_counters(samples.pages(spark, sf), list(EVENT)).select(
        "event_id", "mid", "home_uv_ct", "good_detail_uv_ct")


@query
def returning_users(spark, sf):
    entries = filters.logged_in_entries(samples.pages(spark, sf))
    return state.daily_and_returning(entries, list(EVENT)).select(
        "event_id", "uid", "uu_ct", "back_ct")


def _latest(spark, sf) -> DataFrame:
    return windows.latest_details(samples.order_lines(spark, sf), VERSION)


@query
def latest_lines(spark, sf):
    return _latest(spark, sf).select("order_detail_id", "sku_id", "l_suppkey", "user_id",
                                     "split_total_amount", "ts")


def _timed(df: DataFrame) -> DataFrame:
    at = scalars.text_time(F.col("order_create_time"))
    return df.withColumn("ms", F.unix_millis(at))


@query
def ordering_users(spark, sf):
    """Every line, flagged where it is its user's first of a day and first ever."""
    flagged = state.unique_and_new(_timed(_latest(spark, sf)), ["ms", "order_detail_id"],
                                   state.day_of("ms"), "order_detail_id")
    return flagged.select("order_detail_id", "user_id", "is_unique", "is_new")


@query
def first_copies(spark, sf):
    lines = samples.order_lines(spark, sf)
    return state.first_per_key(lines, "order_detail_id", list(VERSION)).select(
        "order_detail_id", "sku_id", "l_suppkey", "ts")


@query
def bounced_visits(spark, sf):
    return logs.bounce_details(samples.pages(spark, sf), EVENT, SIX_HOURS_MS, DAY_MS).select(
        "event_id", "mid", "ts")


# -- window tables -------------------------------------------------------------

def _traffic_parts(spark, sf):
    pages = samples.pages(spark, sf)
    return (pages, logs.unique_visitors(pages, EVENT),
            logs.bounce_details(pages, EVENT, SIX_HOURS_MS, DAY_MS))


@query
def traffic_union(spark, sf):
    return traffic_rows(*_traffic_parts(spark, sf))


@query
def traffic_window(spark, sf):
    return windows.traffic(*_traffic_parts(spark, sf), size=HOUR).drop("ts")


@query
def keyword_window(spark, sf):
    return windows.keywords(samples.searches(spark, sf)).drop("ts")


@query
def home_detail_window(spark, sf):
    return windows.home_and_detail(samples.pages(spark, sf), HOUR, EVENT).drop("ts")


@query
def login_window(spark, sf):
    return windows.logins(samples.pages(spark, sf), HOUR, EVENT).drop("ts")


@query
def register_window(spark, sf):
    users = facts.registrations(samples.changes(spark, sf, "user_info"))
    return windows.registrations(users).drop("ts")


@query
def cart_window(spark, sf):
    carts = facts.cart_adds(samples.changes(spark, sf, "cart_info"), samples.dictionary(spark, sf))
    return windows.cart_users(carts, HOUR).drop("ts")


@query
def order_window(spark, sf):
    return windows.orders(_latest(spark, sf)).drop("ts")


@query
def order_window_compat(spark, sf):
    return windows.orders(_latest(spark, sf), compat=True).drop("ts")


@query
def payment_window(spark, sf):
    paid = facts.payments(samples.changes(spark, sf, "payment_info"), _details(spark, sf),
                          samples.dictionary(spark, sf))
    return windows.payments(paid, DAY).drop("ts")


@query
def province_window(spark, sf):
    return windows.provinces(_latest(spark, sf),
                             samples.dimensions(spark, sf)["base_province"]).drop("ts")


@query
def spu_order_window(spark, sf):
    return windows.spu_orders(_latest(spark, sf), samples.dimensions(spark, sf)).drop("ts")


@query
def refund_window(spark, sf):
    return windows.refunds(_refunded(spark, sf), samples.dimensions(spark, sf), DAY).drop("ts")


@query
def daily_gmv(spark, sf):
    """A day's sales; only that day's lines are compared and summed."""
    lines = report.of_day(samples.order_lines(spark, sf), "order_create_time", 19980704)
    provinces = windows.provinces(windows.latest_details(lines, VERSION),
                                  samples.dimensions(spark, sf)["base_province"])
    return report.gmv(provinces, 19980704)


@query
def daily_gmv_stored(spark, sf):
    """A day's sales from the stored window table of a month, whose files lie in folders by day."""
    path = work_dir(spark, "province_window")
    lines = _latest(spark, sf).filter("order_create_time like '1998-07-%'")
    provinces = windows.provinces(lines, samples.dimensions(spark, sf)["base_province"])
    columns = [c for c in WINDOW_COLUMNS["province"] if c != "ts"]
    sinks.window_batch(columns, "parquet", path=path)(provinces.repartition(F.substring("stt", 1, 10)), 0)
    return report.gmv(spark.read.parquet(path), 19980704)


# -- sinks ---------------------------------------------------------------------

def _dimensions(spark, root) -> DataFrame:
    sku = sinks.dimension_table(spark, root, "dim_sku_info", "id,sku_name,tm_id")
    place = sinks.dimension_table(spark, root, "dim_base_province", "id,name", "id")
    return (sku.read().select("id", F.col("sku_name").alias("name"), F.lit("sku").alias("dim"))
            .unionByName(place.read().withColumn("dim", F.lit("province"))))


@query
def dimension_sync(spark, sf):
    """Change events, in two batches, to dimension tables read back."""
    root = work_dir(spark, "dims")
    write = sinks.dimension_batch(lambda: samples.routes(spark), root)
    changes = samples.changes(spark, sf, "sku_info", "base_province", "not_listed")
    write(changes.filter("ts <= 100"), 0)
    write(changes.filter("ts > 100"), 1)
    return _dimensions(spark, root)


@query
def dimension_partial_rows(spark, sf):
    """Later changes hold only the id and the name of a part: its other columns stay."""
    root = work_dir(spark, "dims")
    write = sinks.dimension_batch(lambda: samples.routes(spark), root)
    changes = samples.changes(spark, sf, "sku_info")
    write(changes.filter("type <> 'update'"), 0)
    named = F.map_filter("data", lambda k, v: k.isin("id", "sku_name"))
    write(changes.filter("type = 'update'").withColumn("data", named), 1)
    return sinks.dimension_table(spark, root, "dim_sku_info", "id,sku_name,tm_id").read()


def _coupon_table(spark) -> KeyedTable:
    return KeyedTable(spark, work_dir(spark, "coupons"), "id", strings("id", "user_id", "date_id", "ts"))


@query
def upserted_coupons(spark, sf):
    """Three coupon facts upserted on one key; the last batch to touch a key wins."""
    table = _coupon_table(spark)
    changes = samples.changes(spark, sf, "coupon_use")
    write = sinks.upsert_batch(table, "ts")
    write(facts.coupons_received(changes), 0)
    write(facts.coupons_ordered(changes), 1)
    write(facts.coupons_paid(changes), 2)
    return table.read()


@query
def upserted_deletes(spark, sf):
    """Paid coupons are deleted; of some of them a part comes back, without a day."""
    table = _coupon_table(spark)
    changes = samples.changes(spark, sf, "coupon_use")
    paid = facts.coupons_paid(changes)
    table.upsert(facts.coupons_received(changes), 0, "ts")
    table.upsert(paid.withColumn(DELETED, F.lit(True)), 1, "ts")
    table.upsert(paid.filter("cast(user_id as long) % 2 = 0").select("id", "user_id"), 2)
    return table.read().drop("ts")


@query
def upserted_by_two_streams(spark, sf):
    """Two streams, each with a checkpoint of its own and so its own batch 0, write to one table:
    received coupons, then, of ordered ones, the day alone."""
    table = _coupon_table(spark)
    changes = samples.changes(spark, sf, "coupon_use").drop("pt")
    for name, fact in (("received", facts.coupons_received),
                       ("ordered", lambda c: facts.coupons_ordered(c).select("id", "date_id"))):
        texts, _ = split_changes(_topic(spark, changes, name))
        run.drain(fact(texts), work_dir(spark, f"{name}-checkpoint"), sinks.upsert_batch(table))
    return table.read().drop("ts")


@query
def topic_round_trip(spark, sf):
    """Change events written as JSON texts to a topic folder and read back as a table."""
    path = work_dir(spark, "topic")
    rows = filters.route(samples.changes(spark, sf, "favor_info"), "favor_info").drop("pt")
    sinks.append_batch(path)(rows, 0)
    back = readers.change_topic(spark, "text", stream=False, path=path)
    return filters.payload(back, "favor_info", "type", "ts",
                           F.col("old")["is_cancel"].alias("was_cancel"))


@query
def window_table_sink(spark, sf):
    """A window table written by column name to files, two batches, and read back."""
    path = work_dir(spark, "window")
    columns = [c for c in WINDOW_COLUMNS["register"] if c != "ts"]
    users = facts.registrations(samples.changes(spark, sf, "user_info"))
    write = sinks.window_batch(columns, "parquet", path=path)
    early = F.col("user_id").cast("long") % 2 == 0
    halves = [windows.registrations(users.filter(half), "10 minutes") for half in (early, ~early)]
    for batch_id, half in enumerate(halves):
        write(half, batch_id)
    return (spark.read.parquet(path).groupBy("stt", "edt").agg(F.sum("register_ct").alias("register_ct")))


# -- streams: the same rules fed by a stream, drained and read back ---------------

def _streamed(spark, sf, name: str) -> DataFrame:
    file = f"{name}.parquet"
    schema = spark.read.parquet(f"{sf}/{file}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", file).parquet(sf)


# Rows of a stream for each part of its state, so that what one task reads and holds stays the same
# however long the stream is; a searched text gives hundreds of rows.
EVENTS_A_PART, SEARCHES_A_PART = 500_000, 10_000


def _state_parts(spark, sf, table: str, rows: int) -> int:
    """Parts of the state of a stream made from a table: one for each core, more for more rows."""
    return max(spark.sparkContext.defaultParallelism, -(-load(spark, sf, table).count() // rows))


def _drained(spark, df: DataFrame, name: str, partitions: int | None = None, closing: bool = True) -> DataFrame:
    path = work_dir(spark, name)
    run.to_folder(df, f"{path}/out", f"{path}/checkpoint", partitions=partitions, closing=closing)
    return spark.read.parquet(f"{path}/out")


def _topic(spark, rows: DataFrame, name: str, packed: bool = True) -> DataFrame:
    """Rows written as JSON texts to a topic folder, and that topic as a text stream."""
    path = work_dir(spark, name)
    sinks.append_batch(path, packed=packed)(rows, 0)
    return readers.text_topic(spark, "text", path=path)


def _stream_pages(spark, sf) -> DataFrame:
    return samples.pages_of(_streamed(spark, sf, "events"))


@query
def stream_new_flag_repair(spark, sf):
    out = state.repair_new_flag(_stream_pages(spark, sf))
    return _drained(spark, out, "flags").select("event_id", "mid", "is_new", "ts")


@query
def stream_unique_visitors(spark, sf):
    out = logs.unique_visitors(_stream_pages(spark, sf), EVENT)
    return _drained(spark, out, "visitors").select("event_id", "mid", "ts")


@query
def stream_daily_page_firsts(spark, sf):
    out = state.daily_page_counters(_stream_pages(spark, sf), list(EVENT))
    return _drained(spark, out, "page_firsts").select("event_id", "mid", "home_uv_ct",
                                                      "good_detail_uv_ct")


@query
def stream_returning_users(spark, sf):
    entries = filters.logged_in_entries(_stream_pages(spark, sf))
    out = state.daily_and_returning(entries, list(EVENT))
    return _drained(spark, out, "returning").select("event_id", "uid", "uu_ct", "back_ct")


@query
def stream_ordering_users(spark, sf):
    orders = _streamed(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("user_id"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ms"))
    out = state.unique_and_new(orders, ["ms", "o_orderkey"], state.day_of("ms"), "o_orderkey")
    return _drained(spark, out, "ordering").select("o_orderkey", "user_id", "is_unique", "is_new")


@query
def stream_latest_lines(spark, sf):
    """Newest versions of the lines whose wait the watermark has passed."""
    lines = _streamed(spark, sf, "lineitem").select(
        samples.line_id().alias("order_detail_id"), "l_partkey", "l_suppkey",
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ts"), "l_extendedprice")
    out = streams.latest_per_key(event_time(lines), "order_detail_id",
                                 ["ts", "l_partkey", "l_suppkey", "l_extendedprice"],
                                 event_time=True)
    return _drained(spark, out, "latest").drop("rt")


@query
def stream_first_copies(spark, sf):
    lines = _streamed(spark, sf, "lineitem").select(
        samples.line_id().alias("order_detail_id"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ts"))
    out = state.first_per_key(event_time(lines), "order_detail_id", ["ts"])
    return _drained(spark, out, "copies").select("order_detail_id")


@query
def stream_bounced_visits(spark, sf):
    """Bounces whose gap the watermark has passed."""
    out = logs.bounce_details(_stream_pages(spark, sf), EVENT, SIX_HOURS_MS)
    return _drained(spark, out, "bounces").select("event_id", "mid", "ts")


@query
def stream_log_pages(spark, sf):
    """Raw texts split five ways from a stream; the page output."""
    text = _topic(spark, samples.raw_log(spark, sf), "raw_log")
    path = work_dir(spark, "log_split")
    writers = {name: sinks.append_batch(f"{path}/{name}", "parquet") for name in logs.OUTPUTS}
    good, _ = split_log(text)
    run.drain(logs.repaired_events(good), f"{path}/checkpoint",
              sinks.multi_way(filters.split_events, writers), partitions=_state_parts(spark, sf, "events", EVENTS_A_PART))
    return spark.read.parquet(f"{path}/page").select(
        "common.*", "page.*", F.col("err")["error_code"].alias("error_code"), "ts")


@query
def stream_log_job(spark, sf):
    """Raw texts to five outputs and the quarantine, all in one query: rows of each, and of the
    quarantine by the field that is wrong. Texts of k = 4 have a word for a time."""
    raw = samples.raw_log(spark, sf)
    bad_time = F.get_json_object("value", "$.page.during_time") == "4"
    text = raw.withColumn("value", F.when(bad_time, F.regexp_replace("value", '"ts":[0-9]+', '"ts":"soon"'))
                          .otherwise(F.col("value")))
    path = work_dir(spark, "log_job")
    writers = {name: sinks.append_batch(f"{path}/{name}", "parquet") for name in (*logs.OUTPUTS, "bad")}
    run.drain(logs.repaired_log(_topic(spark, text, "job_log")), f"{path}/checkpoint",
              sinks.multi_way(logs.split_outputs, writers), partitions=_state_parts(spark, sf, "events", EVENTS_A_PART))
    whole = [spark.read.parquet(f"{path}/{name}").select(F.lit(name).alias("output"), F.lit(None).cast("string").alias("field"))
             for name in logs.OUTPUTS]
    wrong = spark.read.parquet(f"{path}/bad").select(F.lit("bad").alias("output"), F.explode("faults.field").alias("field"))
    for part in whole:
        wrong = wrong.unionByName(part)
    return wrong.groupBy("output", "field").agg(F.count("*").alias("n"))


@query
def stream_keyword_window(spark, sf):
    """Closed windows of searched words."""
    pages = _topic(spark, samples.searches(spark, sf), "searches", packed=False)
    rows = pages.select(F.from_json("value", "item string, last_page_id string, "
                                             "item_type string, ts bigint").alias("r")).select("r.*")
    return _drained(spark, windows.keywords(rows), "keywords",
                    _state_parts(spark, sf, "documents", SEARCHES_A_PART)).drop("ts")


@query
def stream_login_window(spark, sf):
    """Closed windows; the per-user rule feeds the window in one query."""
    return _drained(spark, windows.logins(_stream_pages(spark, sf), HOUR, EVENT),
                    "logins", _state_parts(spark, sf, "events", EVENTS_A_PART)).drop("ts")


@query
def stream_traffic_window(spark, sf):
    """Closed windows over three streams: page views, unique visitors and bounces."""
    def back(df: DataFrame, name: str) -> DataFrame:
        path = work_dir(spark, name)
        df.write.parquet(path)
        return spark.readStream.schema(df.schema).parquet(path)

    _, unique, bounced = _traffic_parts(spark, sf)
    out = windows.traffic(_stream_pages(spark, sf), back(unique, "uv"), back(bounced, "uj"), HOUR)
    return _drained(spark, out, "traffic").drop("ts")


# Days by which a version of an order line may come late, and the least days it is waited for.
LATE_DAYS, WAIT = 20, "30 days"


def _staged(spark, rows: DataFrame, part: Column, name: str) -> DataFrame:
    """Rows with the number of their part as `_part`, made once and kept in a folder for each part."""
    path = work_dir(spark, f"{name}-staged")
    rows.withColumn("_part", part.cast("int")).write.option("compression", "zstd").partitionBy("_part").parquet(path)
    return spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType())])).parquet(path)


def _part_files(spark, rows: int) -> int:
    """Files of each part of a feed: one for each core, more for more rows."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // sinks.TEXT_FILES["maxRecordsPerFile"]))


def _fed(spark, rows: DataFrame, part: Column, parts: int, name: str, schema) -> DataFrame:
    """Rows written as JSON texts to a topic, one part after another, and read as a stream that gets
    each part as a micro-batch of its own. The rows are made once, then each part is read back."""
    staged, path = _staged(spark, rows, part, name), work_dir(spark, name)
    sizes = {r["_part"]: r["count"] for r in staged.groupBy("_part").count().collect()}
    files = _part_files(spark, max(sizes.values(), default=0))
    write = sinks.append_batch(path)
    for k in range(parts):
        write(staged.filter(F.col("_part") == k).drop("_part").repartition(files), k)
    return readers.json_topic(spark, schema, "text", path=path, maxFilesPerTrigger=files)


def _version_feed(spark, sf, *columns: str) -> DataFrame:
    """Newest versions of order lines from a topic of raw ones, up to twenty days out of order, in four
    micro-batches. Of a line's versions some come micro-batches after others.

    The topic holds whole lines; of their texts only the columns that tell versions apart and those
    asked for are read.
    """
    lines = samples.order_lines(spark, sf)
    late = F.pmod(F.xxhash64("sku_id", "l_suppkey"), F.lit(LATE_DAYS + 1)).cast("int")
    day = F.date_add(F.to_date("order_create_time"), late)
    cuts = [F.lit(d).cast("date") for d in ("1994-01-01", "1995-07-01", "1997-01-01")]
    part = sum(((day >= cut).cast("int") for cut in cuts), F.lit(0))
    kept = dict.fromkeys(["order_detail_id", "type", "order_create_time", *VERSION, *columns])
    feed = _fed(spark, lines.filter(day.isNotNull()), part, len(cuts) + 1, "versions",
                T.StructType([lines.schema[c] for c in kept]))
    return windows.latest_details(feed, VERSION, WAIT, columns)


@query
def stream_province_window(spark, sf):
    """Closed windows of newest order lines with a looked-up province name."""
    path = work_dir(spark, "lines")
    lines = _latest(spark, sf)
    lines.write.parquet(path)
    rows = spark.readStream.schema(lines.schema).parquet(path)
    out = windows.provinces(rows, samples.dimensions(spark, sf)["base_province"])
    return _drained(spark, out, "provinces").drop("ts")


@query
def stream_province_versions(spark, sf):
    """Closed windows from raw line versions: newest versions, windows and names in one query."""
    out = windows.provinces(_version_feed(spark, sf, "province_id"), samples.dimensions(spark, sf)["base_province"])
    return _drained(spark, out, "provinces").drop("ts")


@query
def stream_order_window(spark, sf):
    """Closed windows from raw line versions: newest versions, users' first lines of a day and ever,
    and windows, three stateful steps in one query."""
    return _drained(spark, windows.orders(_version_feed(
        spark, sf, "user_id", "split_activity_amount", "split_coupon_amount", "split_original_amount")), "orders").drop("ts")


@query
def stream_spu_order_window(spark, sf):
    """Closed windows from raw line versions, by product and user."""
    out = windows.spu_orders(_version_feed(spark, sf, "user_id"), samples.dimensions(spark, sf))
    return _drained(spark, out, "spu_orders").drop("ts")


@query
def stream_late_rows(spark, sf):
    """Views per hour; a third micro-batch brings a tenth of the first one's rows again, all late."""
    pages = samples.pages(spark, sf).select("event_id", "ts")
    half = pages.agg(F.expr("(min(ts) + max(ts)) div 2").alias("half"))
    cut = half.first()[0]
    again = pages.filter((F.col("ts") < cut - DAY_MS) & (F.col("event_id") % 10 == 0)).withColumn("part", F.lit(2))
    rows = pages.withColumn("part", (F.col("ts") >= cut).cast("int")).unionByName(again)
    feed = _fed(spark, rows, F.col("part"), 3, "late", rows.schema)
    out = tumble(event_time(feed), [], [F.count("*").alias("pv_ct")], HOUR)
    return _drained(spark, out, "late_rows").drop("ts")


def _paid_stream(spark, sf) -> DataFrame:
    path = work_dir(spark, "details")
    details = _details(spark, sf)
    details.write.option("compression", "zstd").parquet(path)
    rows = spark.readStream.schema(details.schema).parquet(path)
    texts = _topic(spark, samples.changes(spark, sf, "payment_info").drop("pt"), "payments")
    changes, _ = split_changes(texts)
    return facts.payments(changes, rows, samples.dictionary(spark, sf), span="400 days")


@query
def stream_paid_orders(spark, sf):
    """Payments joined to order lines, both streams, at most 400 days apart."""
    return _drained(spark, _paid_stream(spark, sf), "paid", closing=False).drop("pt")


def _through_topic(spark, fact: DataFrame, name: str, closing: bool = True) -> DataFrame:
    """A streamed fact written to a topic by a query of its own, and that topic as a stream."""
    path = work_dir(spark, name)
    run.drain(fact, f"{path}/checkpoint", sinks.append_batch(f"{path}/topic"), closing=closing)
    return readers.json_topic(spark, fact.schema, "text", path=f"{path}/topic", recursiveFileLookup="true")


@query
def stream_payment_window(spark, sf):
    """Closed windows of paying users: the streamed payment fact goes to the window through a topic."""
    paid = _through_topic(spark, _paid_stream(spark, sf).drop("pt"), "paid_topic", closing=False)
    return _drained(spark, windows.payments(paid, DAY), "payments").drop("ts")


def _refund_stream(spark, sf) -> DataFrame:
    texts = _topic(spark, samples.changes(spark, sf, "order_refund_info", "order_info").drop("pt"), "refunds")
    changes, _ = split_changes(texts)
    return facts.refunds(changes, samples.dictionary(spark, sf), span="400 days").drop("row_op_ts")


@query
def stream_order_refunds(spark, sf):
    """Refunds joined to order updates, both streams, at most 400 days apart. A refund without such an
    update comes once the watermark is past its 400 days."""
    return _drained(spark, _refund_stream(spark, sf), "refunded")


@query
def stream_refund_window(spark, sf):
    """Closed windows of refunds: the streamed refund fact goes to the window through a topic.

    Which of several refunds with one id comes first is not told by a stream, so here a refund is
    named by its id, sku, user and time.
    """
    refunded = _through_topic(spark, _refund_stream(spark, sf), "refund_topic")
    refunded = refunded.withColumn("id", F.concat_ws("-", "id", "sku_id", "user_id", "create_time"))
    return _drained(spark, windows.refunds(refunded, samples.dimensions(spark, sf), DAY), "refund_window").drop("ts")


@query
def stream_topic_sink(spark, sf):
    """Favourites from a stream of raw change texts, written to a topic by the stream's own sink and read back."""
    texts, _ = split_changes(_topic(spark, samples.changes(spark, sf, "favor_info").drop("pt"), "favours"))
    fact, path = facts.favours(texts), work_dir(spark, "favour_topic")
    sinks.topic_stream(fact, f"{path}/checkpoint", "text", path=f"{path}/topic") \
        .trigger(availableNow=True).start().awaitTermination()
    return readers.json_topic(spark, fact.schema, "text", stream=False, path=f"{path}/topic")


@query
def stream_home_detail_window(spark, sf):
    """Closed windows; a device's first home and detail pages of a day feed the window in one query."""
    return _drained(spark, windows.home_and_detail(_stream_pages(spark, sf), HOUR, EVENT), "home_detail",
                    _state_parts(spark, sf, "events", EVENTS_A_PART)).drop("ts")


@query
def stream_cart_window(spark, sf):
    """Closed windows from raw change texts in three micro-batches: cart rows, users' first of a day, windows."""
    changes = samples.changes(spark, sf, "cart_info").drop("pt")
    moment = F.coalesce(F.col("data")["operate_time"], F.col("data")["create_time"])
    first, last = changes.agg(F.min(moment), F.max(moment)).first()
    step = F.expr(f"(timestamp'{last}' - timestamp'{first}') / 3")
    cuts = [F.lit(first).cast("timestamp") + step * k for k in (1, 2)]
    at = moment.cast("timestamp")
    parts = [at < cuts[0], (at >= cuts[0]) & (at < cuts[1]), at >= cuts[1]]
    path, files = work_dir(spark, "carts"), spark.sparkContext.defaultParallelism
    write = sinks.append_batch(path)
    for batch_id, part in enumerate(parts):
        write(changes.filter(part).repartition(files), batch_id)
    feed = readers.change_topic(spark, "text", path=path, maxFilesPerTrigger=files)
    carts = facts.cart_adds(feed, samples.dictionary(spark, sf))
    return _drained(spark, windows.cart_users(carts, HOUR), "cart_window").drop("ts")


@query
def stream_dimension_sync(spark, sf):
    """Raw change texts from a stream to dimension tables, config re-read per micro-batch."""
    changes = samples.changes(spark, sf, "sku_info", "base_province", "not_listed")
    path = work_dir(spark, "dim_stream")
    run.drain(_topic(spark, changes.drop("pt"), "dim_topic"), f"{path}/checkpoint",
              dim.sync_batch(lambda: samples.routes(spark), path,
                             sinks.append_batch(f"{path}/bad")))
    return _dimensions(spark, path)
