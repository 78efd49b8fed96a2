"""Window tables over facts and page views."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.scalars import money
from tillstream.functions.tokens import explode_words
from tillstream.operators import filters, state
from tillstream.operators.joins import FIVE_HOPS, SIX_HOPS, enrich, enrich_sku, sku_ids
from tillstream.operators.windows import (DELAY, UNION_DELAY, VERSION_DELAY, WINDOW, decimal_sum, event_time,
                                          event_time_of, total, total_money, traffic_rows, tumble)
from tillstream.schemas import WINDOW_COLUMNS


def keywords(pages: DataFrame, size: str = WINDOW, delay: str = DELAY,
             segment: Callable | None = None) -> DataFrame:
    """Searched words and how often each was searched."""
    searched = event_time(filters.keyword_searches(pages), delay=delay).select("item", "rt")
    split = explode_words(searched, "item", "keyword", segment)
    counted = tumble(split, ["keyword"], [F.count("*").alias("keyword_count")], size)
    return counted.withColumn("source", F.lit("search")).select(*WINDOW_COLUMNS["keyword"])


def traffic(pages: DataFrame, unique: DataFrame, bounced: DataFrame, size: str = WINDOW,
            delay: str = UNION_DELAY) -> DataFrame:
    """Visitors, sessions, views, duration and bounces by version, channel, area and newness."""
    rows = event_time(traffic_rows(pages, unique, bounced), delay=delay)
    measures = ["uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct"]
    out = tumble(rows.drop("ts"), ["vc", "ch", "ar", "is_new"],
                 [total(m, m) for m in measures], size)
    return out.select(*WINDOW_COLUMNS["traffic"])


def home_and_detail(pages: DataFrame, size: str = WINDOW, order: tuple[str, ...] = ("ts",),
                    delay: str = DELAY) -> DataFrame:
    """Daily unique visitors of the home page and of the detail page."""
    views = event_time(pages, delay=delay).select("mid", "page_id", *order, "rt")
    firsts = state.daily_page_counters(views, list(order), event_time="rt")
    out = tumble(firsts, [], [total("home_uv_ct", "home_uv_ct"),
                              total("good_detail_uv_ct", "good_detail_uv_ct")], size)
    return out.select(*WINDOW_COLUMNS["home_detail"])


def logins(pages: DataFrame, size: str = WINDOW, order: tuple[str, ...] = ("ts",),
           delay: str = DELAY) -> DataFrame:
    """Daily unique users and users back after eight days or more."""
    entries = event_time(filters.logged_in_entries(pages), delay=delay).select("uid", *order, "rt")
    firsts = state.daily_and_returning(entries, list(order), event_time="rt")
    out = tumble(firsts, [], [total("back_ct", "back_ct"), total("uu_ct", "uu_ct")], size)
    return out.select(*WINDOW_COLUMNS["login"])


def registrations(users: DataFrame, size: str = WINDOW, delay: str = DELAY) -> DataFrame:
    out = tumble(event_time_of(users, "create_time", delay=delay), [],
                 [F.count("*").alias("register_ct")], size)
    return out.select(*WINDOW_COLUMNS["register"])


def cart_users(carts: DataFrame, size: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """Daily unique users who put something in a cart."""
    timed = event_time_of(carts, "operate_time", "create_time", delay=delay)
    timed = timed.select("user_id", "id", "rt", F.unix_millis("rt").alias("ms"))
    firsts = state.first_per_day(timed, ["user_id"], ["ms", "id"], event_time="rt")
    out = tumble(firsts, [], [F.count("*").alias("cart_add_uu_ct")], size)
    return out.select(*WINDOW_COLUMNS["cart"])


def latest_details(details: DataFrame, order: tuple[str, ...] = ("ts",), delay: str = VERSION_DELAY,
                   keep: tuple[str, ...] | None = None) -> DataFrame:
    """The newest version of each placed order line; on a stream, with its event time `rt`.

    `keep` names the columns that are wanted of a stream's versions; others don't go into its state.

    A line's time is its order's, which no version changes, so a line is final once the watermark
    passes that: `delay` covers both late rows and the wait for newer versions.
    """
    placed = filters.placed(details)
    if details.isStreaming:
        placed = event_time_of(placed, "order_create_time", delay=delay)
        if keep is not None:
            placed = placed.select(*dict.fromkeys(["order_detail_id", *order, *keep, "rt"]))
        return state.latest_per_key(placed, "order_detail_id", list(order), event_time="rt")
    return state.latest_per_key(placed, "order_detail_id", list(order))


def _order_time(details: DataFrame, delay: str) -> DataFrame:
    """Event time of order lines; lines that come from `latest_details` of a stream have it."""
    if details.isStreaming and "rt" in details.columns:
        return details
    return event_time_of(details, "order_create_time", delay=delay)


def orders(details: DataFrame, size: str = WINDOW, delay: str = DELAY,
           compat: bool = False) -> DataFrame:
    """Ordering users, first-time users and amounts; `details` holds each line once.

    The line shares of the amounts are added. `compat` adds the order's whole amounts per line
    instead, which counts an order as often as it has lines.
    """
    amounts = (("activity_reduce_amount", "coupon_reduce_amount", "original_total_amount")
               if compat else
               ("split_activity_amount", "split_coupon_amount", "split_original_amount"))
    timed = _order_time(details, delay)
    timed = timed.select("order_detail_id", "user_id", "rt", *amounts)
    if details.isStreaming:
        flagged = state.unique_and_new(
            timed.withColumn("ms", F.unix_millis("rt")), ["ms", "order_detail_id"],
            F.to_date("rt"), "order_detail_id", event_time="rt")
    else:
        flagged = _user_windows(timed, amounts, size)
    out = tumble(flagged, [], [
        total("is_unique", "order_unique_user_count"), total("is_new", "order_new_user_count"),
        total_money(amounts[0], "order_activity_reduce_amount"),
        total_money(amounts[1], "order_coupon_reduce_amount"),
        total_money(amounts[2], "order_original_total_amount")], size)
    return out.select(*WINDOW_COLUMNS["order"])


def _user_windows(timed: DataFrame, amounts: tuple[str, ...], size: str) -> DataFrame:
    """Amounts per user, day and window, flagged on a user's first window of a day and ever.

    Lines are summed before the users are compared, so a hot user leaves one row per window.
    """
    per_user = timed.groupBy("user_id", F.to_date("rt").alias("day"),
                             F.window("rt", size).start.alias("rt")) \
        .agg(*[F.sum(money(a)).alias(a) for a in amounts])
    before = F.lag("day").over(Window.partitionBy("user_id").orderBy("day", "rt"))
    return (per_user.withColumn("_before", before)
            .withColumn("is_new", F.col("_before").isNull().cast("long"))
            .withColumn("is_unique", F.coalesce(F.col("_before") != F.col("day"), F.lit(True))
                        .cast("long")).drop("_before"))


def payments(paid: DataFrame, size: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """Paying users and first-time payers. Copies of a paid line count once."""
    timed = event_time_of(paid, "callback_time", delay=delay)
    timed = timed.select("order_detail_id", "user_id", "rt", F.unix_millis("rt").alias("ms"))
    once = state.first_per_key(timed, "order_detail_id", ["ms", "user_id"])
    firsts = state.daily_firsts(once, ["ms", "order_detail_id"], F.to_date("rt"),
                                event_time="rt")
    out = tumble(firsts, [], [total("is_unique", "payment_suc_unique_user_count"),
                              total("is_new", "payment_suc_new_user_count")], size)
    return out.select(*WINDOW_COLUMNS["payment"])


def provinces(details: DataFrame, province: DataFrame, size: str = WINDOW,
              delay: str = DELAY) -> DataFrame:
    """Order lines and amount by province; names are looked up for the few summed rows."""
    timed = _order_time(details, delay)
    out = tumble(timed, ["province_id"], [F.count("*").alias("order_count"),
                                          total_money("split_total_amount", "order_amount")], size)
    return enrich(out, province, "province_id", {"province_name": "name"}) \
        .select(*WINDOW_COLUMNS["province"])


def _summed_then_named(timed: DataFrame, dims: dict[str, DataFrame], hops: tuple, table: str, size: str,
                       measures: dict[str, Column]) -> DataFrame:
    """Measures per window, sku and user, named by the sku's dimensions and summed again by the names.

    Only sums meet the dimensions: a row for each window, sku and user, whatever the number of lines.
    A stream, where each sum is a state to write, is summed once: by the ids its skus have, whose names
    come to the closed windows.
    """
    if timed.isStreaming:
        return _summed_by_ids(timed, dims, hops, size, measures)
    sums = timed.groupBy(F.window("rt", size).alias("w"), "sku_id", "user_id") \
        .agg(*[measure.alias(name) for name, measure in measures.items()])
    keys = WINDOW_COLUMNS[table][2:-1 - len(measures)]
    return tumble(enrich_sku(sums, dims, hops), keys, [F.sum(name).alias(name) for name in measures], time="w")


def _summed_by_ids(timed: DataFrame, dims: dict[str, DataFrame], hops: tuple, size: str,
                   measures: dict[str, Column]) -> DataFrame:
    skus, names, ids = sku_ids(dims, hops)
    rows = enrich(timed, skus, "sku_id", {c: c for c in ids}, dim_key="sku_id")
    sums = tumble(rows, [*ids, "user_id"], [measure.alias(name) for name, measure in measures.items()], size)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ids]
    named = sums.join(names, reduce(and_, same), "left").drop(*[f"_{c}" for c in ids])
    # ids that have the same names several times count as often
    times = F.coalesce("_copies", F.lit(1))
    return named.withColumns({name: F.when(times > 1, F.col(name) * times).otherwise(F.col(name)) for name in measures}) \
        .drop("_copies")


def spu_orders(details: DataFrame, dims: dict[str, DataFrame], size: str = WINDOW,
               delay: str = DELAY) -> DataFrame:
    """Order lines and amount by trademark, category, user and product."""
    timed = _order_time(details, delay).select("sku_id", "user_id", "split_total_amount", "rt")
    out = _summed_then_named(timed, dims, SIX_HOPS, "spu_order", size,
                             {"order_count": F.count("*"), "order_amount": decimal_sum("split_total_amount")})
    return out.withColumn("order_amount", F.col("order_amount").cast("double")).select(*WINDOW_COLUMNS["spu_order"])


def refunds(refunded: DataFrame, dims: dict[str, DataFrame], size: str = WINDOW,
            delay: str = DELAY) -> DataFrame:
    """Refunds by trademark, category and user. A refund counts once, by its own id."""
    timed = event_time_of(refunded, "create_time", delay=delay)
    timed = timed.select("id", "sku_id", "user_id", "rt", F.unix_millis("rt").alias("ms"))
    once = state.first_per_key(timed, "id", ["ms", "sku_id", "user_id"])
    out = _summed_then_named(once, dims, FIVE_HOPS, "refund", size, {"refund_count": F.count("*")})
    return out.select(*WINDOW_COLUMNS["refund"])
