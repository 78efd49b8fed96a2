"""Transaction, coupon and interaction facts from change events.

On tables the fact joins are unbounded equi-joins. On streams, and on tables when `span` is
given, matching rows must lie within `span` of each other in event time; a stream has no default,
as rows further apart are lost to an inner join and unmatched in a left one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.scalars import date_text, money, times
from tillstream.operators import filters
from tillstream.operators.filters import payload, route
from tillstream.operators.joins import decode, known_codes
from tillstream.schemas import PAYLOAD, STATUS_PAID, STATUS_REFUNDING
from tillstream.streaming.joins import interval_join, watermarked

# Fixed columns of the wide order fact.
ORDER_DETAIL = [
    "order_detail_id", "order_id", "sku_id", "sku_name", "order_price", "sku_num",
    "order_create_time", "source_type", "source_id", "split_original_amount",
    "split_total_amount", "split_activity_amount", "split_coupon_amount", "pt", "consignee",
    "consignee_tel", "total_amount", "order_status", "user_id", "payment_way", "out_trade_no",
    "trade_body", "operate_time", "expire_time", "process_status", "tracking_no",
    "parent_order_id", "province_id", "activity_reduce_amount", "coupon_reduce_amount",
    "original_total_amount", "feight_fee", "feight_fee_reduce", "type", "old", "activity_id",
    "activity_rule_id", "activity_create_time", "coupon_id", "coupon_use_id",
    "coupon_create_time", "dic_name", "ts"]
LINE_AMOUNTS = ["order_price", "split_total_amount", "split_activity_amount",
                "split_coupon_amount"]
ORDER_AMOUNTS = ["total_amount", "activity_reduce_amount", "coupon_reduce_amount",
                 "original_total_amount", "feight_fee", "feight_fee_reduce"]

# Fixed columns of the paid order fact.
PAYMENT = [
    "order_detail_id", "order_id", "user_id", "sku_id", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "payment_type_code", "payment_type_name", "callback_time",
    "source_id", "source_type", "sku_num", "split_original_amount", "split_activity_amount",
    "split_coupon_amount", "split_payment_amount", "pt"]

# Fixed columns of the refund fact.
REFUND = [
    "id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time",
    "refund_type_code", "refund_type_name", "refund_reason_type_code",
    "refund_reason_type_name", "refund_reason_txt", "refund_num", "refund_amount", "ts",
    "row_op_ts"]


def _seconds(column: str = "ts") -> Column:
    return F.timestamp_seconds(F.col(column).try_cast("long"))


def _near(left: DataFrame, right: DataFrame, on: tuple[str, str], how: str,
          span: str | None, times: tuple[str, str] = ("_lt", "_rt")) -> DataFrame:
    """Equi-join, bounded in time on streams; the right key and time are dropped. Each input
    stream was given its watermark before its first join."""
    if left.isStreaming and not span:
        raise ValueError("a join of streams needs `span`: rows further apart than it don't meet")
    if span:
        joined = interval_join(left, right, on, times, span, span, how, delay=None)
    else:
        joined = left.join(right, F.col(on[0]) == F.col(on[1]), how)
    return joined.drop(on[1], times[1])


def joined_lines(changes: DataFrame, database: str | None = None, span: str | None = None,
                 one_pass: bool = False, dictionary: DataFrame | None = None) -> DataFrame:
    """Order lines with their order, activity and coupon, not yet with their source's name.

    Amounts become decimals before anything meets, once per line and per order. `one_pass` reads the
    events once instead of once for each of their four tables: for a topic of texts, whose parse
    costs more than the grouping. Streams and tables that are cheap to read join the four. Given the
    `dictionary`, lines get their source's name first, so one of an unknown source is never moved.
    """
    if one_pass and changes.isStreaming:
        raise ValueError("a stream joins its tables: there is no last event of a group")
    return (_grouped_lines if one_pass else _lines_by_joins)(changes, database, span, dictionary)


def _named(lines: DataFrame, dictionary: DataFrame) -> DataFrame:
    return decode(lines, dictionary, {"source_type": "dic_name"}, how="inner")


def _renamed_line(df: DataFrame) -> DataFrame:
    return (df.withColumnsRenamed({"id": "order_detail_id", "create_time": "order_create_time"})
            .withColumns({c: money(c) for c in LINE_AMOUNTS})
            .withColumn("split_original_amount", times(F.col("sku_num"), F.col("order_price"))))


def _grouped_lines(changes: DataFrame, database: str | None, span: str | None,
                   dictionary: DataFrame | None) -> DataFrame:
    """The topic is read and parsed once. Each event goes to the group of its line, or of its order
    if it is the order's own; a line's group holds what belongs to it, a few events. Lines then meet
    their orders in one join, whose skewed orders adaptive execution splits.

    Both sides of that join are taken from the groups, so Spark makes the groups once.
    """
    is_order, is_line = F.col("table") == "order_info", F.col("table") == "order_detail"
    line = F.when(is_line, F.col("data")["id"]).otherwise(F.col("data")["order_detail_id"])
    of_line = F.col("table").isin("order_detail_activity", "order_detail_coupon") & line.isNotNull()
    keep = (is_order & F.col("type").isin("insert", "update") & F.col("data")["id"].isNotNull()) \
        | ((is_line | of_line) & (F.col("type") == "insert"))
    if database is not None:
        keep &= F.col("database") == database
    changes = changes.filter(keep)
    known = None if dictionary is None else known_codes(dictionary, "_known")
    if known is not None:  # a line of an unknown source is not moved
        source = F.when(is_line, F.col("data")["source_type"])
        changes = changes.join(known, source == F.col("_known"), "left").filter(~is_line | F.col("_known").isNotNull())
    # an order's own events, and a line without an id, which nothing can belong to, have groups apart
    group = F.when(is_order, F.concat(F.lit("o"), F.col("data")["id"])) \
        .otherwise(F.coalesce(F.concat(F.lit("l"), line), F.concat(F.lit("n"), F.xxhash64(_list("order_detail")).cast("string"))))
    values = F.when(is_order, _list("order_info")).when(is_line, _list("order_detail")) \
        .when(F.col("table") == "order_detail_activity", _list("order_detail_activity")).otherwise(_list("order_detail_coupon"))
    change = F.when(is_order, F.struct("type", "old"))
    tables = {name: F.lit(n).cast("tinyint") for n, name in enumerate(
        ("order_info", "order_detail", "order_detail_activity", "order_detail_coupon"))}
    kind = F.coalesce(*[F.when(F.col("table") == name, n) for name, n in tables.items()])
    event = F.struct(kind.alias("table"), values.alias("v"), change.alias("change"), _seconds().alias("at"))
    groups = changes.groupBy(group.alias("group")).agg(F.collect_list(event).alias("events"))

    def of(table: str):
        return F.filter("events", lambda e: e["table"] == tables[table])

    def near(events, at: Column):
        if not span:
            return events
        away = F.expr(f"interval {span}")
        return F.filter(events, lambda e: (e["at"] >= at - away) & (e["at"] <= at + away))

    def field(event: str, table: str, name: str) -> Column:
        return F.col(event)["v"][PAYLOAD[table].index(name)]
    # only lines with an id have activities and coupons
    named = F.col("line")["v"][0].isNotNull()
    lines = groups.select(F.explode(of("order_detail")).alias("line"), "events")
    for event, table in (("activity", "order_detail_activity"), ("coupon", "order_detail_coupon")):
        mine = F.when(named, near(of(table), F.col("line")["at"]))
        lines = lines.select("*", F.explode_outer(mine).alias(event))
    lines = _renamed_line(lines.select(
        *[field("line", "order_detail", c).alias(c) for c in PAYLOAD["order_detail"]],
        *[field("activity", "order_detail_activity", c).alias(c) for c in ("activity_id", "activity_rule_id")],
        field("activity", "order_detail_activity", "create_time").alias("activity_create_time"),
        *[field("coupon", "order_detail_coupon", c).alias(c) for c in ("coupon_id", "coupon_use_id")],
        field("coupon", "order_detail_coupon", "create_time").alias("coupon_create_time"),
        F.col("line")["at"].alias("_lt")))
    if dictionary is not None:
        lines = _named(lines, dictionary)
    orders = groups.select(F.explode(of("order_info")).alias("order")).select(
        field("order", "order_info", "id").alias("_order"),
        *[(money(field("order", "order_info", c)) if c in ORDER_AMOUNTS else field("order", "order_info", c)).alias(c)
          for c in PAYLOAD["order_info"] if c != "id"],
        F.col("order")["change"]["type"].alias("type"), F.col("order")["change"]["old"].alias("old"),
        F.col("order")["at"].alias("_ot"))
    return _near(lines, orders, ("order_id", "_order"), "inner", span, ("_lt", "_ot")).drop("_lt")


def _list(table: str) -> Column:
    """A table's payload as an array of texts, in the order of its columns."""
    return F.array(*[F.col("data")[c] for c in PAYLOAD[table]])


def _lines_by_joins(changes: DataFrame, database: str | None, span: str | None,
                    dictionary: DataFrame | None) -> DataFrame:
    """Activity and coupon come first: they share the line key, so the lines are shuffled once for
    both while they are still narrow, and once more for the order."""
    def of(table: str, *types: str) -> DataFrame:
        return route(changes, table, *types, database=database)

    lines = _renamed_line(watermarked(payload(of("order_detail", "insert"), "order_detail",
                                              _seconds().alias("_lt")), "_lt"))
    if dictionary is not None:
        lines = _named(lines, dictionary)
    activity = watermarked(payload(of("order_detail_activity", "insert"),
                                   "order_detail_activity", _seconds().alias("_at")), "_at") \
        .select(F.col("order_detail_id").alias("_activity_line"), "activity_id",
                "activity_rule_id", F.col("create_time").alias("activity_create_time"), "_at")
    coupon = watermarked(payload(of("order_detail_coupon", "insert"), "order_detail_coupon",
                                 _seconds().alias("_ct")), "_ct") \
        .select(F.col("order_detail_id").alias("_coupon_line"), "coupon_id", "coupon_use_id",
                F.col("create_time").alias("coupon_create_time"), "_ct")
    orders = watermarked(payload(of("order_info", "insert", "update"), "order_info", "type",
                                 "old", _seconds().alias("_ot")), "_ot") \
        .withColumnRenamed("id", "_order").withColumns({c: money(c) for c in ORDER_AMOUNTS})

    wide = _near(lines, activity, ("order_detail_id", "_activity_line"), "left", span,
                 ("_lt", "_at"))
    wide = _near(wide, coupon, ("order_detail_id", "_coupon_line"), "left", span, ("_lt", "_ct"))
    wide = _near(wide, orders, ("order_id", "_order"), "inner", span, ("_lt", "_ot"))
    return wide.drop("_lt")


def named_lines(wide: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Joined lines with their source's name; a line of an unknown source is dropped."""
    return _stamped(_named(wide, dictionary))


def _stamped(named: DataFrame) -> DataFrame:
    return (named.withColumn("pt", F.current_timestamp()).withColumn("ts", F.current_timestamp())
            .select(*ORDER_DETAIL))


def order_detail(changes: DataFrame, dictionary: DataFrame, database: str | None = None,
                 span: str | None = None, one_pass: bool = False) -> DataFrame:
    """The wide order fact. A table's lines meet the dictionary first, a stream's when they are
    joined; a stream whose dictionary changes should write `joined_lines` through
    sinks.with_lookup and `named_lines`."""
    if changes.isStreaming:
        return named_lines(joined_lines(changes, database, span, one_pass), dictionary)
    return _stamped(joined_lines(changes, database, span, one_pass, dictionary))


def placed_orders(fact: DataFrame) -> DataFrame:
    return filters.placed(fact)


def cancelled_orders(fact: DataFrame) -> DataFrame:
    return filters.cancelled(fact)


def cart_adds(changes: DataFrame, dictionary: DataFrame,
              database: str | None = None) -> DataFrame:
    """Items put in carts: new cart rows, and quantity rises with the rise as quantity."""
    keep, quantity = filters.grown("sku_num")
    rows = route(changes, "cart_info", database=database).filter(keep)
    rows = rows.withColumn("_quantity", quantity)
    cart = payload(rows, "cart_info", "_quantity").withColumn("sku_num", F.col("_quantity")) \
        .drop("_quantity").withColumn("cart_price", money("cart_price"))
    return decode(cart, dictionary, {"source_type": "dic_name"}, how="inner")


def payments(changes: DataFrame, details: DataFrame, dictionary: DataFrame,
             span: str | None = None, database: str | None = None) -> DataFrame:
    """Paid order lines. `details` is the wide order fact."""
    paid = route(changes, "payment_info", "update", database=database) \
        .filter((F.col("data")["payment_status"] == STATUS_PAID)
                & filters.changed("payment_status"))
    # the payment's own columns get names of their own, the lines keep theirs
    paid = payload(paid, "payment_info").select(
        F.col("order_id").alias("_paid_order"), F.col("payment_type").alias("payment_type_code"),
        "callback_time", F.try_to_timestamp("callback_time").alias("_paid"))
    paid = watermarked(paid, "_paid")
    lines = watermarked(details.drop("pt", "ts").withColumn(
        "_made", F.try_to_timestamp("order_create_time")), "_made") \
        .withColumnRenamed("split_total_amount", "split_payment_amount")
    joined = _near(paid, lines, ("_paid_order", "order_id"), "inner", span, ("_paid", "_made")) \
        .withColumnRenamed("_paid_order", "order_id")
    named = decode(joined, dictionary, {"payment_type_code": "payment_type_name"}, how="inner")
    return (named.withColumn("pt", F.current_timestamp()).select(*PAYMENT))


def refunds(changes: DataFrame, dictionary: DataFrame, span: str | None = None,
            database: str | None = None) -> DataFrame:
    """Refunded order lines with their order's province and both code names."""
    asked = watermarked(payload(route(changes, "order_refund_info", "insert", database=database),
                                "order_refund_info", "ts", _seconds().alias("_lt")), "_lt")
    orders = route(changes, "order_info", "update", database=database).filter(
        (F.col("data")["order_status"] == STATUS_REFUNDING) & filters.in_old("order_status"))
    orders = orders.select(F.col("data")["id"].alias("_order"),
                           F.col("data")["province_id"].alias("province_id"),
                           _seconds().alias("_rt"))
    orders = watermarked(orders, "_rt")
    wide = _near(asked, orders, ("order_id", "_order"), "left", span)
    wide = wide.withColumnsRenamed({"refund_type": "refund_type_code",
                                    "refund_reason_type": "refund_reason_type_code"})
    wide = decode(wide, dictionary, {"refund_type_code": "refund_type_name",
                                     "refund_reason_type_code": "refund_reason_type_name"})
    return (wide.withColumn("date_id", date_text(F.col("create_time")))
            .withColumn("refund_amount", money("refund_amount"))
            .withColumn("row_op_ts", F.current_timestamp()).select(*REFUND))


# -- coupons and interactions: no join on their key, upserted by it ----------

def coupons_received(changes: DataFrame, database: str | None = None) -> DataFrame:
    rows = payload(route(changes, "coupon_use", "insert", database=database), "coupon_use", "ts")
    return rows.select("id", "coupon_id", "user_id",
                       date_text(F.col("get_time")).alias("date_id"), "get_time", "ts")


def _coupons_used(changes: DataFrame, key: str, out: str, database: str | None) -> DataFrame:
    rows = route(changes, "coupon_use", "update", database=database).filter(filters.in_old(key))
    return payload(rows, "coupon_use", "ts").select(
        "id", "coupon_id", "user_id", "order_id", date_text(F.col(key)).alias("date_id"),
        F.col(key).alias(out), "ts")


def coupons_ordered(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Coupons put to an order: using_time was touched, from null as a rule."""
    return _coupons_used(changes, "using_time", "order_time", database)


def coupons_paid(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Coupons spent in a payment: used_time was touched."""
    return _coupons_used(changes, "used_time", "payment_time", database)


def favours(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Favourites added, or taken up again after a cancel; of this table only."""
    rows = route(changes, "favor_info", "insert", "update", database=database).filter(
        (F.col("type") == "insert") | filters.moved("is_cancel", "1", "0"))
    return payload(rows, "favor_info", "ts").select(
        "id", "user_id", "sku_id", date_text(F.col("create_time")).alias("date_id"),
        "create_time", "ts")


def comments(changes: DataFrame, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    rows = payload(route(changes, "comment_info", "insert", database=database), "comment_info",
                   "ts")
    named = decode(rows, dictionary, {"appraise": "appraise_name"})
    return named.select("id", "user_id", "sku_id", "order_id",
                        date_text(F.col("create_time")).alias("date_id"), "create_time",
                        F.col("appraise").alias("appraise_code"), "appraise_name", "ts")


def registrations(changes: DataFrame, database: str | None = None) -> DataFrame:
    rows = payload(route(changes, "user_info", "insert", database=database), "user_info", "ts")
    return rows.select(F.col("id").alias("user_id"),
                       date_text(F.col("create_time")).alias("date_id"), "create_time", "ts")
