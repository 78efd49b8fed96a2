"""Fixed record shapes. Everything else is derived from config at run time."""

from pyspark.sql import types as T

_STR = T.StringType()


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _STR) for n in names])


# Fixed field names of the click log.
COMMON = strings("mid", "uid", "vc", "ch", "ar", "is_new")
PAGE = (strings("page_id", "last_page_id", "item", "item_type")
        .add("during_time", T.LongType()))
LOG_EVENT = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("page", PAGE),
    T.StructField("start", T.MapType(_STR, _STR)),
    T.StructField("err", T.MapType(_STR, _STR)),
    T.StructField("displays", T.ArrayType(T.MapType(_STR, _STR))),
    T.StructField("actions", T.ArrayType(T.MapType(_STR, _STR))),
    T.StructField("ts", T.LongType()),
])

# Fixed envelope of a database change event.
CHANGE_EVENT = T.StructType([
    T.StructField("database", _STR),
    T.StructField("table", _STR),
    T.StructField("type", _STR),
    T.StructField("data", T.MapType(_STR, _STR)),
    T.StructField("old", T.MapType(_STR, _STR)),
    T.StructField("ts", _STR),
])

# Routing config: which source table feeds which dimension table.
ROUTE_CONFIG = strings("source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend")

# Code dictionary.
CODE_DICTIONARY = T.StructType([
    T.StructField("dic_code", _STR),
    T.StructField("dic_name", _STR),
    T.StructField("parent_code", _STR),
    T.StructField("create_time", T.TimestampType()),
    T.StructField("operate_time", T.TimestampType()),
])

# Fixed payload keys of each change event table, in the order the facts list them.
PAYLOAD = {
    "order_detail": [
        "id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time",
        "source_type", "source_id", "split_total_amount", "split_activity_amount",
        "split_coupon_amount"],
    "order_info": [
        "id", "consignee", "consignee_tel", "total_amount", "order_status", "user_id",
        "payment_way", "out_trade_no", "trade_body", "operate_time", "expire_time",
        "process_status", "tracking_no", "parent_order_id", "province_id",
        "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
        "feight_fee", "feight_fee_reduce"],
    "order_detail_activity": [
        "id", "order_id", "order_detail_id", "activity_id", "activity_rule_id", "sku_id",
        "create_time"],
    "order_detail_coupon": [
        "id", "order_id", "order_detail_id", "coupon_id", "coupon_use_id", "sku_id",
        "create_time"],
    "cart_info": [
        "id", "user_id", "sku_id", "cart_price", "sku_num", "sku_name", "is_checked",
        "create_time", "operate_time", "is_ordered", "order_time", "source_type", "source_id"],
    "payment_info": ["user_id", "order_id", "payment_type", "callback_time", "payment_status"],
    "order_refund_info": [
        "id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
        "refund_reason_type", "refund_reason_txt", "create_time"],
    "coupon_use": ["id", "coupon_id", "user_id", "order_id", "get_time", "using_time",
                   "used_time"],
    "favor_info": ["id", "user_id", "sku_id", "create_time", "is_cancel"],
    "comment_info": ["id", "user_id", "sku_id", "order_id", "create_time", "appraise"],
    "user_info": ["id", "create_time"],
}

# Fixed status codes.
STATUS_CANCELLED = "1003"
STATUS_REFUNDING = "1005"
STATUS_PAID = "1602"

# Fixed column order of the window tables; `ts` is the emission time.
WINDOW_COLUMNS = {
    "keyword": ["stt", "edt", "source", "keyword", "keyword_count", "ts"],
    "traffic": ["stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum",
                "uj_ct", "ts"],
    "home_detail": ["stt", "edt", "home_uv_ct", "good_detail_uv_ct", "ts"],
    "login": ["stt", "edt", "back_ct", "uu_ct", "ts"],
    "register": ["stt", "edt", "register_ct", "ts"],
    "cart": ["stt", "edt", "cart_add_uu_ct", "ts"],
    "order": ["stt", "edt", "order_unique_user_count", "order_new_user_count",
              "order_activity_reduce_amount", "order_coupon_reduce_amount",
              "order_original_total_amount", "ts"],
    "payment": ["stt", "edt", "payment_suc_unique_user_count", "payment_suc_new_user_count",
                "ts"],
    "province": ["stt", "edt", "province_id", "province_name", "order_count", "order_amount",
                 "ts"],
    "spu_order": ["stt", "edt", "trademark_id", "trademark_name", "category1_id",
                  "category1_name", "category2_id", "category2_name", "category3_id",
                  "category3_name", "user_id", "spu_id", "spu_name", "order_count",
                  "order_amount", "ts"],
    "refund": ["stt", "edt", "trademark_id", "trademark_name", "category1_id",
               "category1_name", "category2_id", "category2_name", "category3_id",
               "category3_name", "user_id", "refund_count", "ts"],
}
