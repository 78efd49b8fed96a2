"""Views over the sample tables in the shapes the warehouse reads.

The sample tables hold no clicks or change events, so each input is a fixed rule over their
columns. `events` are page views minutes apart; `orders` and `lineitem` are order changes.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.scalars import DATE_TIME
from tillstream.schemas import CODE_DICTIONARY, ROUTE_CONFIG

_MAP = "map<string,string>"
DATABASE = "shop"


# tables that grow; the others stay small enough to be read in one task
_LARGE = {"lineitem", "orders", "events", "documents"}


@lru_cache(maxsize=256)
def _table(spark: SparkSession, path: str) -> tuple[T.StructType, int]:
    """Schema and number of read tasks, looked up once per session and table."""
    df = spark.read.parquet(path)
    return df.schema, df.rdd.getNumPartitions()


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A sample table. A large one that comes as fewer splits than there are cores, such as one
    file with a single row group, is spread; with enough splits it is read as it is."""
    path = f"{sf}/{name}.parquet"
    schema, tasks = _table(spark, path)
    df = spark.read.schema(schema).parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name in _LARGE and tasks < cores else df


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _join(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _ms(c: str) -> Column:
    return F.unix_millis(F.col(c).cast("timestamp"))


def _time(c: str | Column) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, DATE_TIME)


def _money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(16,2)")


def with_k(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


# -- page views ------------------------------------------------------------

def pages_of(events: DataFrame) -> DataFrame:
    """Flat page views from an events table or stream."""
    mid, k = _text("user_id"), F.col("k")
    return with_k(events).select(
        "event_id", mid.alias("mid"), F.when(k % 7 != 0, mid).alias("uid"),
        _join("v", k % 3).alias("vc"), _join("ch", F.col("user_id") % 3).alias("ch"),
        _join("ar", F.col("user_id") % 5).alias("ar"),
        F.when(k % 2 == 0, "1").otherwise("0").alias("is_new"),
        F.when(F.col("event_type").isin("view", "signup"), "home").otherwise("good_detail")
        .alias("page_id"),
        F.when(k % 3 != 0, F.col("event_type")).alias("last_page_id"),
        k.cast("long").alias("during_time"), _ms("ts").alias("ts"))


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return pages_of(load(spark, sf, "events"))


def raw_log_of(events: DataFrame) -> DataFrame:
    """Click log texts. k = 1 is cut off, k = 2 lacks common, k = 3 lacks start and page."""
    mid, k, kind = _text("user_id"), F.col("k"), F.col("event_type")

    def items(count: Column, *fields: Column) -> Column:
        made = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
                           lambda i: F.struct(i.cast("string").alias("pos_id"), *fields))
        return F.when(count > 0, made)

    common = F.struct(mid.alias("mid"), F.when(k % 7 != 0, mid).alias("uid"),
                      _join("v", k % 3).alias("vc"), _join("ch", F.col("user_id") % 3).alias("ch"),
                      _join("ar", F.col("user_id") % 5).alias("ar"),
                      F.when(k % 2 == 0, "1").otherwise("0").alias("is_new"))
    page = F.struct(F.when(kind == "view", "home").otherwise("good_detail").alias("page_id"),
                    F.when(k % 3 != 0, kind).alias("last_page_id"),
                    _text(k).alias("item"), F.lit("sku_id").alias("item_type"),
                    k.cast("long").alias("during_time"))
    event = F.struct(
        F.when(k != 2, common).alias("common"),
        F.when((kind != "signup") & (k != 3), page).alias("page"),
        F.when((kind == "signup") & (k != 3),
               F.struct(F.lit("icon").alias("entry"), _text(k).alias("loading_time")))
        .alias("start"),
        F.when(kind == "error", F.struct(_text(k).alias("error_code"), F.lit("x").alias("msg")))
        .alias("err"),
        items(k % 4, _text("event_id").alias("item")).alias("displays"),
        items(k % 3, F.lit("cart_add").alias("action_id")).alias("actions"),
        _ms("ts").alias("ts"))
    text = F.to_json(event)
    return with_k(events).select(F.when(k == 1, F.substring(text, 1, 25)).otherwise(text)
                                 .alias("value"))


def raw_log(spark: SparkSession, sf: str) -> DataFrame:
    return raw_log_of(load(spark, sf, "events"))


def searches(spark: SparkSession, sf: str) -> DataFrame:
    """Search result views whose searched text is a whole document, seven seconds apart."""
    docs = load(spark, sf, "documents")
    return docs.select(
        F.col("text").alias("item"),
        F.when(F.length("text") % 3 != 0, "search").otherwise("home").alias("last_page_id"),
        F.when(F.col("lang") != "de", "keyword").otherwise("sku_id").alias("item_type"),
        (F.lit(1704067200000) + F.col("doc_id") * 7000).alias("ts"))


# -- change events -----------------------------------------------------------

def _map(**values: Column | str | None) -> Column:
    pairs = []
    for key, value in values.items():
        value = F.lit(value) if value is None or isinstance(value, str) else value
        pairs += [F.lit(key), value.cast("string")]
    return F.create_map(*pairs)


def _event(df: DataFrame, table: str, type_: Column | str, data: Column, old: Column | None,
           seconds: Column) -> DataFrame:
    return df.select(
        F.lit(DATABASE).alias("database"), F.lit(table).alias("table"),
        (F.lit(type_) if isinstance(type_, str) else type_).alias("type"), data.alias("data"),
        (F.lit(None).cast(_MAP) if old is None else old.cast(_MAP)).alias("old"),
        seconds.cast("string").alias("ts"))


def _sec(c: str) -> Column:
    return F.unix_timestamp(F.col(c).cast("timestamp"))


def line_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _order_details(lines: DataFrame) -> DataFrame:
    price, off, tax = (_money(c) for c in ("l_extendedprice", "l_discount", "l_tax"))
    data = _map(id=line_id(), order_id=F.col("l_orderkey"), sku_id=F.col("l_partkey"),
                sku_name=_join("sku ", F.col("l_partkey")), order_price=price,
                sku_num=F.col("l_quantity").cast("int"), create_time=_time("l_shipdate"),
                source_type=F.col("l_returnflag"), source_id=F.col("l_suppkey"),
                split_total_amount=price, split_activity_amount=_money(price * off),
                split_coupon_amount=_money(price * tax))
    return _event(lines, "order_detail", "insert", data, None, _sec("l_shipdate"))


def _activities(lines: DataFrame) -> DataFrame:
    rows = lines.filter("l_discount >= 0.05")
    data = _map(id=line_id(), order_id=F.col("l_orderkey"), order_detail_id=line_id(),
                activity_id=F.round(F.col("l_discount") * 100).cast("int"),
                activity_rule_id=F.col("l_linenumber"), sku_id=F.col("l_partkey"),
                create_time=_time("l_shipdate"))
    return _event(rows, "order_detail_activity", "insert", data, None, _sec("l_shipdate"))


def _coupons(lines: DataFrame) -> DataFrame:
    rows = lines.filter("l_tax >= 0.04")
    data = _map(id=line_id(), order_id=F.col("l_orderkey"), order_detail_id=line_id(),
                coupon_id=F.round(F.col("l_tax") * 100).cast("int"),
                coupon_use_id=F.col("l_suppkey"), sku_id=F.col("l_partkey"),
                create_time=_time("l_shipdate"))
    return _event(rows, "order_detail_coupon", "insert", data, None, _sec("l_shipdate"))


def _order_data(status: Column | str, operate: Column | None) -> Column:
    amount = _money("o_totalprice")
    return _map(
        id=F.col("o_orderkey"), consignee=_join("user ", F.col("o_custkey")), consignee_tel=None,
        total_amount=amount, order_status=status, user_id=F.col("o_custkey"),
        payment_way=F.col("o_orderpriority"), out_trade_no=_join("no", F.col("o_orderkey")),
        trade_body=None, operate_time=operate, expire_time=None, process_status=None,
        tracking_no=None, parent_order_id=None, province_id=F.col("o_custkey") % 25,
        activity_reduce_amount=F.lit("5.00"),
        coupon_reduce_amount=F.when(F.col("o_orderpriority") == "1-URGENT", "2.50"),
        original_total_amount=amount, feight_fee=F.lit("9.90"), feight_fee_reduce=F.lit("0.00"))


def _order_inserts(orders: DataFrame) -> DataFrame:
    return _event(orders, "order_info", "insert", _order_data("1001", None), None,
                  _sec("o_orderdate"))


def _order_updates(orders: DataFrame) -> DataFrame:
    """F is cancelled, P is refunded, O only gets a new operate time."""
    status = (F.when(F.col("o_orderstatus") == "F", "1003")
              .when(F.col("o_orderstatus") == "P", "1005").otherwise("1001"))
    old = (F.when(F.col("o_orderstatus") == "F", _map(order_status="1001"))
           .when(F.col("o_orderstatus") == "P", _map(order_status="1002"))
           .otherwise(_map(operate_time=None)))
    return _event(orders, "order_info", "update", _order_data(status, _time("o_orderdate")), old,
                  _sec("o_orderdate") + 60)


def _callback() -> Column:
    return F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_custkey") % 30).cast("int"))


def _payments(orders: DataFrame) -> DataFrame:
    """Status O stays unpaid; P was paid from no former status and does not count."""
    paid = F.col("o_orderstatus") != "O"
    data = _map(user_id=F.col("o_custkey"), order_id=F.col("o_orderkey"),
                payment_type=F.col("o_orderpriority"), callback_time=_time(_callback()),
                payment_status=F.when(paid, "1602").otherwise("1601"))
    old = F.when(F.col("o_orderstatus") == "P", _map(payment_status=None)) \
        .otherwise(_map(payment_status="1601"))
    return _event(orders, "payment_info", "update", data, old, _sec("o_orderdate"))


def _refunds(lines: DataFrame) -> DataFrame:
    rows = lines.filter("l_returnflag = 'R'")
    data = _map(id=line_id(), user_id=F.col("l_suppkey"), order_id=F.col("l_orderkey"),
                sku_id=F.col("l_partkey"), refund_type=F.col("l_returnflag"),
                refund_num=F.col("l_quantity").cast("int"),
                refund_amount=_money("l_extendedprice"), refund_reason_type=F.col("l_linestatus"),
                refund_reason_txt=_join("line ", F.col("l_linenumber")),
                create_time=_time("l_shipdate"))
    return _event(rows, "order_refund_info", "insert", data, None, _sec("l_shipdate"))


def _carts(events: DataFrame) -> DataFrame:
    """Clicks are new cart rows, views change the quantity from 50 to k, purchases tick a row.

    k = 99 is no number.
    """
    kind, k = F.col("event_type"), F.col("k")
    type_ = F.when(kind == "click", "insert").otherwise("update")
    data = _map(id=F.col("event_id"), user_id=F.col("user_id"), sku_id=k,
                cart_price=_money("value"),
                sku_num=F.when(k == 99, "many").otherwise(_text(k)), sku_name=_join("sku ", k),
                is_checked=F.lit("1"), create_time=_time("ts"),
                operate_time=F.when(kind != "click", _time(F.col("ts") + F.expr(
                    "interval 3 hours"))),
                is_ordered=F.lit("0"), order_time=None,
                source_type=F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), k % 3 + 1),
                source_id=None)
    old = F.when(kind == "view", _map(sku_num="50")) \
        .when(kind == "purchase", _map(is_checked="0"))
    return _event(events.filter("event_type in ('click', 'view', 'purchase')"), "cart_info",
                  type_, data, old, _sec("ts"))


def _favours(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    type_ = F.when(kind == "click", "insert").otherwise("update")
    data = _map(id=F.col("event_id"), user_id=F.col("user_id"), sku_id=F.col("k"),
                create_time=_time("ts"),
                is_cancel=F.when(kind == "view", "1").otherwise("0"))
    old = F.when(kind == "view", _map(is_cancel="0")).when(kind == "purchase",
                                                           _map(is_cancel="1"))
    return _event(events.filter("event_type in ('click', 'view', 'purchase')"), "favor_info",
                  type_, data, old, _sec("ts"))


def _comments(events: DataFrame) -> DataFrame:
    data = _map(id=F.col("event_id"), user_id=F.col("user_id"), sku_id=F.col("k"),
                order_id=F.col("event_id"), create_time=_time("ts"),
                appraise=F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")),
                                      F.col("k") % 3 + 1))
    return _event(events.filter("event_type = 'purchase'"), "comment_info", "insert", data, None,
                  _sec("ts"))


def _coupon_uses(orders: DataFrame) -> list[DataFrame]:
    def data(using: Column | None, used: Column | None) -> Column:
        return _map(id=F.col("o_orderkey"), coupon_id=F.col("o_custkey") % 10,
                    user_id=F.col("o_custkey"), order_id=F.col("o_orderkey"),
                    get_time=_time("o_orderdate"), using_time=using, used_time=used)
    using, used = _time(F.col("o_orderdate") + F.expr("interval 2 hours")), \
        _time(F.col("o_orderdate") + F.expr("interval 26 hours"))
    sec = _sec("o_orderdate")
    ordered = orders.filter("o_orderpriority in ('1-URGENT', '2-HIGH')")
    paid = orders.filter("o_orderpriority = '1-URGENT'")
    other = orders.filter("o_orderpriority = '5-LOW'")
    return [_event(orders, "coupon_use", "insert", data(None, None), None, sec),
            _event(ordered, "coupon_use", "update", data(using, None), _map(using_time=None),
                   sec + 7200),
            _event(paid, "coupon_use", "update", data(using, used), _map(used_time=None),
                   sec + 93600),
            _event(other, "coupon_use", "update", data(None, None), _map(get_time="x"), sec)]


def _users(customers: DataFrame) -> DataFrame:
    at = F.lit(1704067200) + F.col("c_custkey") * 37
    return _event(customers, "user_info", "insert",
                  _map(id=F.col("c_custkey"), create_time=_time(F.timestamp_seconds(at))), None,
                  at)


def _skus(part: DataFrame) -> list[DataFrame]:
    """Parts loaded at first, and some of them changed later."""
    def sku(name: Column) -> Column:
        return _map(id=F.col("p_partkey"), sku_name=name, tm_id=F.col("p_brand"),
                    price=_money("p_retailprice"))
    return [_event(part, "sku_info", "bootstrap-insert", sku(F.col("p_name")), None, F.lit(100)),
            _event(part.filter("p_size > 25"), "sku_info", "update", sku(F.upper("p_name")),
                   _map(sku_name="x"), F.lit(200))]


def _places(nation: DataFrame) -> list[DataFrame]:
    data = _map(id=F.col("n_nationkey"), name=F.col("n_name"), area=F.col("n_regionkey"))
    return [_event(nation, "base_province", "insert", data, None, F.lit(100)),
            _event(nation, "base_province", "delete", data, None, F.lit(300))]


def changes(spark: SparkSession, sf: str, *tables: str) -> DataFrame:
    """The change topic, or only the part of it that holds some tables."""
    def of(name: str) -> DataFrame:
        return load(spark, sf, name)

    makers = {
        "order_detail": lambda: [_order_details(of("lineitem"))],
        "order_detail_activity": lambda: [_activities(of("lineitem"))],
        "order_detail_coupon": lambda: [_coupons(of("lineitem"))],
        "order_info": lambda: [_order_inserts(of("orders")), _order_updates(of("orders"))],
        "payment_info": lambda: [_payments(of("orders"))],
        "order_refund_info": lambda: [_refunds(of("lineitem"))],
        "cart_info": lambda: [_carts(with_k(of("events")))],
        "favor_info": lambda: [_favours(with_k(of("events")))],
        "comment_info": lambda: [_comments(with_k(of("events")))],
        "coupon_use": lambda: _coupon_uses(of("orders")),
        "user_info": lambda: [_users(of("customer"))],
        "sku_info": lambda: _skus(of("part")),
        "base_province": lambda: _places(of("nation")),
        "not_listed": lambda: [_event(of("part"), "not_listed", "insert",
                                      _map(id=F.col("p_partkey")), None, F.lit(100))],
    }
    parts = [part for table in (tables or makers) for part in makers[table]()]
    topic = parts[0]
    for part in parts[1:]:
        topic = topic.unionByName(part)
    return topic.withColumn("pt", F.current_timestamp())


# -- lookups -----------------------------------------------------------------

def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of priority, return flag and line status; one code of each is left out."""
    def codes(rows: DataFrame, column: str, parent: str, without: str) -> DataFrame:
        codes = rows.select(F.col(column).alias("dic_code")).distinct()
        return codes.filter(F.col("dic_code") != without).select(
            "dic_code", _join("name of ", F.col("dic_code")).alias("dic_name"),
            F.lit(parent).alias("parent_code"), F.lit(None).cast("timestamp").alias("create_time"),
            F.lit(None).cast("timestamp").alias("operate_time"))
    flags = load(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()
    priorities = load(spark, sf, "orders")
    rows = (codes(priorities, "o_orderpriority", "priority", "4-NOT SPECIFIED")
            .unionByName(codes(flags, "l_returnflag", "flag", "N"))
            .unionByName(codes(flags, "l_linestatus", "status", "O")))
    return rows.select(*CODE_DICTIONARY.fieldNames())


def dimensions(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All-text dimension tables: parts are skus, suppliers, nations and regions categories."""
    part, supplier = load(spark, sf, "part"), load(spark, sf, "supplier")
    nation, region = load(spark, sf, "nation"), load(spark, sf, "region")
    return {
        "sku_info": part.select(_text("p_partkey").alias("id"), F.col("p_type").alias("spu_id"),
                                F.col("p_brand").alias("tm_id"),
                                _text("p_size").alias("category3_id")),
        "spu_info": part.select(F.col("p_type").alias("id"),
                                _join("spu ", F.col("p_type")).alias("spu_name")).distinct(),
        "base_trademark": part.select(F.col("p_brand").alias("id"),
                                      _join("tm ", F.col("p_brand")).alias("tm_name")).distinct(),
        "base_category3": supplier.select(_text("s_suppkey").alias("id"),
                                          F.col("s_name").alias("name"),
                                          _text("s_nationkey").alias("category2_id")),
        "base_category2": nation.select(_text("n_nationkey").alias("id"),
                                        F.col("n_name").alias("name"),
                                        _text("n_regionkey").alias("category1_id")),
        "base_category1": region.select(_text("r_regionkey").alias("id"),
                                        F.col("r_name").alias("name")),
        "base_province": nation.select(_text("n_nationkey").alias("id"),
                                       F.col("n_name").alias("name")),
    }


def routes(spark: SparkSession) -> DataFrame:
    """The control table that says which change events feed which dimension."""
    rows = [("sku_info", "dim_sku_info", "id,sku_name,tm_id", None, None),
            ("base_province", "dim_base_province", "id,name", "id", None)]
    return spark.createDataFrame(rows, ROUTE_CONFIG)


def route_versions(spark: SparkSession) -> DataFrame:
    """Routes with the second from which they hold: parts move to another table, and a late one."""
    rows = [("sku_info", "dim_sku_first", "id,sku_name", None, None, 50),
            ("sku_info", "dim_sku_info", "id,sku_name,tm_id", None, None, 150),
            ("base_province", "dim_base_province", "id,name", "id", None, 100),
            ("not_listed", "dim_too_late", "id", "id", None, 101)]
    return spark.createDataFrame(rows, T.StructType(ROUTE_CONFIG.fields + [T.StructField("version", T.LongType())]))


# -- order lines with versions -------------------------------------------------

def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Placed order lines as the wide fact has them; ship date is the version of a line."""
    lines = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_shipdate")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    price = _money("l_extendedprice")
    return (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(_text(line_id()).alias("order_detail_id"),
                    _text("o_orderkey").alias("order_id"), _text("l_partkey").alias("sku_id"),
                    _text("o_custkey").alias("user_id"), _text("c_nationkey").alias("province_id"),
                    _time("o_orderdate").alias("order_create_time"), F.lit("insert").alias("type"),
                    price.alias("split_original_amount"), price.alias("split_total_amount"),
                    _money(price * _money("l_discount")).alias("split_activity_amount"),
                    _money(price * _money("l_tax")).alias("split_coupon_amount"),
                    F.lit("5.00").alias("activity_reduce_amount"),
                    F.lit(None).cast("string").alias("coupon_reduce_amount"),
                    price.alias("original_total_amount"),
                    _ms("l_shipdate").alias("ts"), "l_suppkey"))


# a line's versions in order; the last columns leave no ties
VERSION = ("ts", "sku_id", "l_suppkey", "split_total_amount")
