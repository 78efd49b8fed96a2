"""The same results as plain SQL for another engine, written from the rules, not from the code.

Per-key rules use group-by, self-joins and struct maxima here, where the queries use windows.
"""

from __future__ import annotations


def _text(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR)"


def _time(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def _cents(expression: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(16,2)) AS DOUBLE)"


def _sum(expression: str) -> str:
    return f"CAST(CAST(sum(CAST({expression} AS DECIMAL(16,2))) AS DECIMAL(18,2)) AS DOUBLE)"


def _bounds(ms: str, size_ms: int) -> str:
    start = f"(({ms}) // {size_ms}) * {size_ms}"
    return (f"{_time(f'make_timestamp(({start}) * 1000)')} AS stt, "
            f"{_time(f'make_timestamp(({start} + {size_ms}) * 1000)')} AS edt")


TEN_S, TEN_MIN, HOUR, DAY = 10_000, 600_000, 3_600_000, 86_400_000

# -- page views ------------------------------------------------------------------

K = """ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""

PAGES = K + """,
page_log AS (SELECT event_id, CAST(user_id AS VARCHAR) AS mid,
  CASE WHEN k % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
  'v' || (k % 3) AS vc, 'ch' || (user_id % 3) AS ch, 'ar' || (user_id % 5) AS ar,
  CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS is_new,
  CASE WHEN event_type IN ('view', 'signup') THEN 'home' ELSE 'good_detail' END AS page_id,
  CASE WHEN k % 3 <> 0 THEN event_type END AS last_page_id,
  CAST(k AS BIGINT) AS during_time, epoch_us(ts) // 1000 AS ts, CAST(ts AS DATE) AS d FROM ev)"""

VISITORS = """visitors AS (SELECT min(struct_pack(ts := ts, event_id := event_id)) AS v, mid, d
  FROM page_log WHERE last_page_id IS NULL GROUP BY mid, d),
visits AS (SELECT p.* FROM page_log p JOIN visitors ON p.event_id = visitors.v.event_id)"""

BOUNCED = """numbered AS (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ts, event_id) AS n
  FROM page_log),
bounced AS (SELECT a.* FROM numbered a LEFT JOIN numbered b ON a.mid = b.mid AND b.n = a.n + 1
  WHERE a.last_page_id IS NULL
    AND (b.mid IS NULL OR b.last_page_id IS NULL OR b.ts - a.ts >= 21600000))"""

UNION = """rows AS (
  SELECT vc, ch, ar, is_new, CAST(0 AS BIGINT) AS uv_ct,
    CAST(last_page_id IS NULL AS BIGINT) AS sv_ct, CAST(1 AS BIGINT) AS pv_ct,
    during_time AS dur_sum, CAST(0 AS BIGINT) AS uj_ct, ts FROM page_log
  UNION ALL SELECT vc, ch, ar, is_new, 1, 0, 0, 0, 0, ts FROM visits
  UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 0, 0, 1, ts FROM bounced)"""

PAGE_FIRSTS = """firsts AS (SELECT mid, page_id, d,
    min(struct_pack(ts := ts, event_id := event_id)) AS v FROM page_log GROUP BY ALL)"""

LOGINS = """entries AS (SELECT * FROM page_log WHERE uid IS NOT NULL AND last_page_id IS NULL),
days AS (SELECT uid, d, min(struct_pack(ts := ts, event_id := event_id)) AS v
  FROM entries GROUP BY uid, d),
logins AS (SELECT a.uid, a.v.event_id AS event_id, a.v.ts AS ts, CAST(1 AS BIGINT) AS uu_ct,
    CAST(coalesce(max(a.d - b.d = (SELECT min(a.d - c.d) FROM days c
      WHERE c.uid = a.uid AND c.d < a.d) AND a.d - b.d >= 8), false) AS BIGINT) AS back_ct
  FROM days a LEFT JOIN days b ON a.uid = b.uid AND b.d < a.d GROUP BY a.uid, a.v)"""

# -- raw log ---------------------------------------------------------------------

LOG = K + """,
good AS (SELECT *, CAST(user_id AS VARCHAR) AS mid, epoch_us(ts) // 1000 AS ms, CAST(ts AS DATE) AS d,
    CASE WHEN k % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
    'v' || (k % 3) AS vc, 'ch' || (user_id % 3) AS ch, 'ar' || (user_id % 5) AS ar,
    CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS flag,
    CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'view' THEN 'home'
      ELSE 'good_detail' END AS page_id,
    CASE WHEN event_type <> 'signup' AND k % 3 <> 0 THEN event_type END AS last_page_id
  FROM ev WHERE k NOT IN (1, 2, 3)),
oldest AS (SELECT mid, min(ms) AS ms FROM good GROUP BY mid),
since AS (SELECT mid, min(CASE WHEN flag = '1' THEN d ELSE d - 1 END) AS fd
  FROM good JOIN oldest USING (mid, ms) GROUP BY mid),
log AS (SELECT good.*, CASE WHEN flag = '1' AND d <> fd THEN '0' ELSE flag END AS is_new
  FROM good JOIN since USING (mid)),
texts AS (SELECT *, '{"mid":"' || mid || '"' || coalesce(',"uid":"' || uid || '"', '')
    || ',"vc":"' || vc || '","ch":"' || ch || '","ar":"' || ar || '","is_new":"' || is_new
    || '"}' AS common FROM log WHERE event_type <> 'signup')"""

# -- change events ---------------------------------------------------------------

DIC = """dic AS (
  SELECT DISTINCT o_orderpriority AS code, 'name of ' || o_orderpriority AS name FROM orders
    WHERE o_orderpriority <> '4-NOT SPECIFIED'
  UNION SELECT DISTINCT l_returnflag, 'name of ' || l_returnflag FROM lineitem
    WHERE l_returnflag <> 'N'
  UNION SELECT DISTINCT l_linestatus, 'name of ' || l_linestatus FROM lineitem
    WHERE l_linestatus <> 'O')"""

ORDER_COLUMNS = f"""{_text('o_orderkey')} AS id, 'user ' || o_custkey AS consignee,
  CAST(NULL AS VARCHAR) AS consignee_tel, {_cents('o_totalprice')} AS total_amount,
  {_text('o_custkey')} AS user_id, o_orderpriority AS payment_way,
  'no' || o_orderkey AS out_trade_no, CAST(NULL AS VARCHAR) AS trade_body,
  CAST(NULL AS VARCHAR) AS expire_time, CAST(NULL AS VARCHAR) AS process_status,
  CAST(NULL AS VARCHAR) AS tracking_no, CAST(NULL AS VARCHAR) AS parent_order_id,
  {_text('o_custkey % 25')} AS province_id, CAST(5.0 AS DOUBLE) AS activity_reduce_amount,
  CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(2.5 AS DOUBLE) END AS coupon_reduce_amount,
  {_cents('o_totalprice')} AS original_total_amount, CAST(9.9 AS DOUBLE) AS feight_fee,
  CAST(0.0 AS DOUBLE) AS feight_fee_reduce"""

LINE_COLUMNS = f"""{_text('l_orderkey * 10 + l_linenumber')} AS order_detail_id,
  {_text('l_orderkey')} AS order_id, {_text('l_partkey')} AS sku_id,
  'sku ' || l_partkey AS sku_name, {_cents('l_extendedprice')} AS order_price,
  {_text('CAST(l_quantity AS INTEGER)')} AS sku_num, {_time('l_shipdate')} AS order_create_time,
  l_returnflag AS source_type, {_text('l_suppkey')} AS source_id,
  CAST(CAST(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(16,2)) AS DECIMAL(16,2))
    AS DOUBLE) AS split_original_amount,
  {_cents('l_extendedprice')} AS split_total_amount,
  {_cents('CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(16,2))')}
    AS split_activity_amount,
  {_cents('CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(16,2))')}
    AS split_coupon_amount, l_shipdate"""

DETAILS = DIC + f""",
oi AS (
  SELECT {ORDER_COLUMNS}, '1001' AS order_status, CAST(NULL AS VARCHAR) AS operate_time,
    'insert' AS type, CAST(NULL AS VARCHAR) AS old FROM orders
  UNION ALL
  SELECT {ORDER_COLUMNS},
    CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'P' THEN '1005' ELSE '1001' END,
    {_time('o_orderdate')}, 'update',
    CASE o_orderstatus WHEN 'F' THEN '{{"order_status":"1001"}}'
      WHEN 'P' THEN '{{"order_status":"1002"}}' ELSE '{{"operate_time":null}}' END FROM orders),
od AS (SELECT {LINE_COLUMNS} FROM lineitem),
oa AS (SELECT {_text('l_orderkey * 10 + l_linenumber')} AS line,
  {_text('CAST(round(l_discount * 100) AS INTEGER)')} AS activity_id,
  {_text('l_linenumber')} AS activity_rule_id, {_time('l_shipdate')} AS activity_create_time
  FROM lineitem WHERE l_discount >= 0.05),
oc AS (SELECT {_text('l_orderkey * 10 + l_linenumber')} AS line,
  {_text('CAST(round(l_tax * 100) AS INTEGER)')} AS coupon_id,
  {_text('l_suppkey')} AS coupon_use_id, {_time('l_shipdate')} AS coupon_create_time
  FROM lineitem WHERE l_tax >= 0.04),
wide AS (SELECT od.* EXCLUDE (l_shipdate), l_shipdate, oi.* EXCLUDE (id), activity_id,
    activity_rule_id, activity_create_time, coupon_id, coupon_use_id, coupon_create_time,
    dic.name AS dic_name
  FROM od JOIN oi ON od.order_id = oi.id LEFT JOIN oa ON od.order_detail_id = oa.line
    LEFT JOIN oc ON od.order_detail_id = oc.line JOIN dic ON od.source_type = dic.code)"""

PAID = DETAILS + f""",
pay AS (SELECT {_text('o_orderkey')} AS paid_order, o_orderpriority AS payment_type_code,
    o_orderdate + to_minutes(CAST(o_custkey % 30 AS INTEGER)) AS paid_at FROM orders
  WHERE o_orderstatus = 'F'),
paid AS (SELECT order_detail_id, order_id, user_id, sku_id, province_id, activity_id,
    activity_rule_id, coupon_id, payment_type_code, d.name AS payment_type_name,
    {_time('paid_at')} AS callback_time, source_id, source_type, sku_num, split_original_amount,
    split_activity_amount, split_coupon_amount, split_total_amount AS split_payment_amount,
    paid_at, l_shipdate
  FROM pay JOIN wide ON paid_order = order_id JOIN dic d ON payment_type_code = d.code)"""

CARTS = K + "," + DIC + f""",
touched AS (SELECT *, CASE WHEN k = 99 THEN NULL ELSE k END AS n,
    list_extract(['A', 'N', 'R'], k % 3 + 1) AS source_type,
    CASE WHEN event_type <> 'click' THEN ts + INTERVAL 3 HOUR END AS operated FROM ev),
carts AS (SELECT {_text('event_id')} AS id, {_text('user_id')} AS user_id, {_text('k')} AS sku_id,
    {_cents('value')} AS cart_price,
    CAST(CASE WHEN event_type = 'click' THEN n ELSE n - 50 END AS INTEGER) AS sku_num,
    'sku ' || k AS sku_name, '1' AS is_checked, {_time('ts')} AS create_time,
    {_time('operated')} AS operate_time, '0' AS is_ordered, CAST(NULL AS VARCHAR) AS order_time,
    source_type, CAST(NULL AS VARCHAR) AS source_id, name AS dic_name,
    coalesce(operated, ts) AS moment
  FROM touched JOIN dic ON source_type = code
  WHERE event_type = 'click' OR (event_type = 'view' AND n > 50))"""

REFUNDS = DIC + f""",
refunded AS (SELECT {_text('l_orderkey * 10 + l_linenumber')} AS id, {_text('l_suppkey')} AS user_id,
    {_text('l_orderkey')} AS order_id, {_text('l_partkey')} AS sku_id,
    CASE WHEN o_orderstatus = 'P' THEN {_text('o_custkey % 25')} END AS province_id,
    strftime(l_shipdate, '%Y-%m-%d') AS date_id, {_time('l_shipdate')} AS create_time,
    l_returnflag AS refund_type_code, a.name AS refund_type_name,
    l_linestatus AS refund_reason_type_code, b.name AS refund_reason_type_name,
    'line ' || l_linenumber AS refund_reason_txt,
    {_text('CAST(l_quantity AS INTEGER)')} AS refund_num, {_cents('l_extendedprice')} AS refund_amount,
    {_text('CAST(epoch(l_shipdate) AS BIGINT)')} AS ts, l_shipdate, l_partkey
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN dic a ON l_returnflag = a.code LEFT JOIN dic b ON l_linestatus = b.code
  WHERE l_returnflag = 'R')"""

# On a stream a refund meets its order's update within 400 days, or comes without one when the
# watermark, the lesser of both sides', is past that.
REFUNDS_IN_SPAN = """marked AS (SELECT r.* REPLACE (CASE WHEN o.o_orderkey IS NOT NULL THEN province_id END AS province_id),
    o.o_orderkey IS NOT NULL AS met
  FROM refunded r LEFT JOIN orders o ON r.order_id = CAST(o.o_orderkey AS VARCHAR) AND o.o_orderstatus = 'P'
    AND r.l_shipdate BETWEEN o.o_orderdate + INTERVAL 60 SECOND - INTERVAL 400 DAY
      AND o.o_orderdate + INTERVAL 60 SECOND + INTERVAL 400 DAY),
come AS (SELECT * FROM marked WHERE met OR l_shipdate + INTERVAL 400 DAY < least(
    (SELECT max(l_shipdate) FROM lineitem WHERE l_returnflag = 'R'),
    (SELECT max(o_orderdate) + INTERVAL 60 SECOND FROM orders WHERE o_orderstatus = 'P')) - INTERVAL 2 SECOND)"""

# -- lookups ---------------------------------------------------------------------

SKU = """sku AS (SELECT CAST(p_partkey AS VARCHAR) AS sku_id, p_type AS spu_id,
    'spu ' || p_type AS spu_name, p_brand AS trademark_id, 'tm ' || p_brand AS trademark_name,
    CAST(p_size AS VARCHAR) AS category3_id, s_name AS category3_name,
    CAST(s_nationkey AS VARCHAR) AS category2_id, n_name AS category2_name,
    CAST(n_regionkey AS VARCHAR) AS category1_id, r_name AS category1_name
  FROM part LEFT JOIN supplier ON p_size = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey)"""

CHAIN = """trademark_id, trademark_name, category1_id, category1_name, category2_id,
  category2_name, category3_id, category3_name"""

# -- order lines -----------------------------------------------------------------

LATEST = f"""lines AS (SELECT {_text('l_orderkey * 10 + l_linenumber')} AS order_detail_id,
    {_text('l_partkey')} AS sku_id, l_suppkey, {_text('o_custkey')} AS user_id,
    {_text('c_nationkey')} AS province_id, CAST(o_orderdate AS DATE) AS d,
    epoch_ms(o_orderdate) AS ms, epoch_ms(l_shipdate) AS ts,
    CAST(l_extendedprice AS DECIMAL(16,2)) AS amount,
    CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(16,2))
      AS DECIMAL(16,2)) AS activity,
    CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(16,2))
      AS DECIMAL(16,2)) AS coupon
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
best AS (SELECT max(struct_pack(ts := ts, sku_id := sku_id, l_suppkey := l_suppkey,
    amount := amount, user_id := user_id, province_id := province_id, d := d, ms := ms,
    activity := activity, coupon := coupon)) AS v, order_detail_id
  FROM lines GROUP BY order_detail_id),
latest AS (SELECT order_detail_id, unnest(v) FROM best)"""

USERS = """by_day AS (SELECT user_id, d, min(order_detail_id) AS head FROM latest
  GROUP BY user_id, d),
by_user AS (SELECT user_id, min(d) AS d FROM latest GROUP BY user_id),
flagged AS (SELECT l.*, CAST(h.head IS NOT NULL AS BIGINT) AS is_unique,
    CAST(h.head IS NOT NULL AND f.user_id IS NOT NULL AS BIGINT) AS is_new
  FROM latest l LEFT JOIN by_day h ON l.order_detail_id = h.head
    LEFT JOIN by_user f ON l.user_id = f.user_id AND l.d = f.d)"""

PROVINCES = f"""provinces AS (SELECT {_bounds('ms', TEN_S)}, province_id, n_name AS province_name,
    count(*) AS order_count, {_sum('amount')} AS order_amount
  FROM latest JOIN nation ON province_id = CAST(n_nationkey AS VARCHAR)
  GROUP BY ALL)"""

# newest lines at their orders' times, as a stream has them
OPEN = "open AS (SELECT ms AS ts, * EXCLUDE (ts) FROM latest)"
THIRTY_DAYS = 30 * 86_400_000

# -- words -----------------------------------------------------------------------

# fixed patterns, as the word rule states them
_CJK = r"\x{4e00}-\x{9fff}"


def _words(text: str) -> str:
    runs = (f"regexp_extract_all(lower({text}), "
            rf"'[{_CJK}]+|(?:[^\P{{L}}{_CJK}]|\p{{N}})+')")
    pairs = (f"list_transform({runs}, lambda r: CASE WHEN regexp_full_match(r, '[{_CJK}]{{2,}}') "
             "THEN list_transform(range(1, length(r)), lambda i: substr(r, i, 2)) ELSE [r] END)")
    return f"CASE WHEN len({runs}) > 0 THEN flatten({pairs}) ELSE [{text}] END"


SEARCHES = """searched AS (SELECT text AS item, 1704067200000 + doc_id * 7000 AS ts FROM documents
  WHERE length(text) % 3 <> 0 AND lang <> 'de' AND text IS NOT NULL)"""


def _closed(size_ms: int, delay_ms: int, rows: str) -> str:
    """Windows that end at or before the watermark."""
    return (f"(ts // {size_ms} + 1) * {size_ms} <= (SELECT max(ts) - {delay_ms} FROM {rows})")


def oracle_sql() -> dict[str, str]:
    tables = _table_sql()
    same = {"stream_new_flag_repair": "new_flag_repair",
            "stream_unique_visitors": "unique_visitors",
            "stream_daily_page_firsts": "daily_page_firsts",
            "stream_returning_users": "returning_users", "stream_log_pages": "log_pages",
            "stream_paid_orders": "paid_orders_in_span", "stream_topic_sink": "favourites_added",
            "stream_dimension_sync": "dimension_sync",
            "daily_gmv_stored": "daily_gmv", "order_detail_topic": "order_detail_wide"}
    return {**tables, **{stream: tables[name] for stream, name in same.items()}, **_stream_sql()}


def _stream_sql() -> dict[str, str]:
    """Streams whose last rows stay open until the watermark passes them."""
    return {
        "stream_ordering_users": """WITH o AS (SELECT o_orderkey, o_custkey AS user_id,
              CAST(o_orderdate AS DATE) AS d FROM orders),
            h AS (SELECT user_id, d, min(o_orderkey) AS head FROM o GROUP BY ALL),
            f AS (SELECT user_id, min(d) AS d FROM o GROUP BY ALL)
            SELECT o_orderkey, o.user_id, CAST(h.head IS NOT NULL AS BIGINT) AS is_unique,
              CAST(h.head IS NOT NULL AND f.d IS NOT NULL AS BIGINT) AS is_new
            FROM o LEFT JOIN h ON o_orderkey = h.head
              LEFT JOIN f ON o.user_id = f.user_id AND o.d = f.d""",
        "stream_latest_lines": """WITH b AS (SELECT l_orderkey * 10 + l_linenumber AS id,
              max(struct_pack(ts := epoch_ms(l_shipdate), l_partkey := l_partkey,
                l_suppkey := l_suppkey, l_extendedprice := l_extendedprice)) AS v
              FROM lineitem GROUP BY ALL HAVING min(epoch_ms(l_shipdate)) + 2000
                <= (SELECT max(epoch_ms(l_shipdate)) - 2000 FROM lineitem))
            SELECT id AS order_detail_id, unnest(v) FROM b""",
        "stream_first_copies": """SELECT DISTINCT l_orderkey * 10 + l_linenumber AS order_detail_id
            FROM lineitem""",
        "stream_bounced_visits": f"""WITH {PAGES}, {BOUNCED} SELECT event_id, mid, ts FROM bounced
            WHERE ts + 21600000 <= (SELECT max(ts) - 2000 FROM page_log)""",
        "stream_keyword_window": f"""WITH {SEARCHES}, w AS (SELECT unnest({_words('item')}) AS keyword,
              ts FROM searched WHERE {_closed(TEN_S, 2000, 'searched')})
            SELECT {_bounds('ts', TEN_S)}, 'search' AS source, keyword, count(*) AS keyword_count
            FROM w GROUP BY ALL""",
        "stream_login_window": f"""WITH {PAGES}, {LOGINS} SELECT {_bounds('ts', HOUR)},
            CAST(sum(back_ct) AS BIGINT) AS back_ct, CAST(sum(uu_ct) AS BIGINT) AS uu_ct
            FROM logins WHERE {_closed(HOUR, 2000, 'entries')} GROUP BY ALL""",
        "stream_traffic_window": f"""WITH {PAGES}, {VISITORS}, {BOUNCED}, {UNION}
            SELECT {_bounds('ts', HOUR)}, vc, ch, ar, is_new, CAST(sum(uv_ct) AS BIGINT) AS uv_ct,
            CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
            CAST(sum(dur_sum) AS BIGINT) AS dur_sum, CAST(sum(uj_ct) AS BIGINT) AS uj_ct
            FROM rows WHERE {_closed(HOUR, 13000, 'rows')} GROUP BY ALL""",
        "stream_province_window": f"""WITH {LATEST}, {OPEN}
            SELECT {_bounds('ts', TEN_S)}, province_id, n_name AS province_name,
              count(*) AS order_count, {_sum('amount')} AS order_amount
            FROM open JOIN nation ON province_id = CAST(n_nationkey AS VARCHAR)
            WHERE {_closed(TEN_S, 2000, 'open')} GROUP BY ALL""",
        "stream_province_versions": f"""WITH {LATEST}, {OPEN}
            SELECT {_bounds('ts', TEN_S)}, province_id, n_name AS province_name,
              count(*) AS order_count, {_sum('amount')} AS order_amount
            FROM open JOIN nation ON province_id = CAST(n_nationkey AS VARCHAR)
            WHERE {_closed(TEN_S, THIRTY_DAYS, 'open')} GROUP BY ALL""",
        "stream_spu_order_window": f"""WITH {LATEST}, {OPEN}, {SKU}
            SELECT {_bounds('ts', TEN_S)}, {CHAIN}, user_id, spu_id, spu_name, count(*) AS order_count,
              {_sum('amount')} AS order_amount
            FROM open LEFT JOIN sku ON open.sku_id = sku.sku_id
            WHERE {_closed(TEN_S, THIRTY_DAYS, 'open')} GROUP BY ALL""",
        "stream_order_window": f"""WITH {LATEST}, {USERS}, open AS (SELECT ms AS ts, * EXCLUDE (ts) FROM flagged)
            SELECT {_bounds('ts', TEN_S)}, CAST(sum(is_unique) AS BIGINT) AS order_unique_user_count,
              CAST(sum(is_new) AS BIGINT) AS order_new_user_count, {_sum('activity')} AS order_activity_reduce_amount,
              {_sum('coupon')} AS order_coupon_reduce_amount, {_sum('amount')} AS order_original_total_amount
            FROM open WHERE {_closed(TEN_S, THIRTY_DAYS, 'open')} GROUP BY ALL""",
        "stream_home_detail_window": f"""WITH {PAGES}, {PAGE_FIRSTS}, f AS (SELECT v.ts AS ts, page_id FROM firsts)
            SELECT {_bounds('ts', HOUR)}, count(*) FILTER (page_id = 'home') AS home_uv_ct,
              count(*) FILTER (page_id <> 'home') AS good_detail_uv_ct
            FROM f WHERE {_closed(HOUR, 2000, 'page_log')} GROUP BY ALL""",
        "stream_cart_window": f"""WITH {CARTS}, m AS (SELECT user_id, epoch_ms(date_trunc('second', moment)) AS ts,
              CAST(moment AS DATE) AS d FROM carts), f AS (SELECT user_id, min(ts) AS ts FROM m GROUP BY user_id, d)
            SELECT {_bounds('ts', HOUR)}, count(*) AS cart_add_uu_ct
            FROM f WHERE {_closed(HOUR, 2000, 'm')} GROUP BY ALL""",
        "stream_payment_window": f"""WITH {PAID}, p AS (SELECT user_id, CAST(paid_at AS DATE) AS d,
              epoch_ms(paid_at) AS ts FROM paid
              WHERE l_shipdate BETWEEN paid_at - INTERVAL 400 DAY AND paid_at + INTERVAL 400 DAY),
            u AS (SELECT user_id, d, min(ts) AS ts FROM p GROUP BY ALL),
            n AS (SELECT user_id, min(d) AS d FROM u GROUP BY user_id)
            SELECT {_bounds('ts', DAY)}, count(*) AS payment_suc_unique_user_count,
              count(n.d) AS payment_suc_new_user_count
            FROM u LEFT JOIN n ON u.user_id = n.user_id AND u.d = n.d
            WHERE {_closed(DAY, 2000, 'p')} GROUP BY ALL""",
        "stream_order_refunds": f"""WITH {REFUNDS}, {REFUNDS_IN_SPAN}
            SELECT * EXCLUDE (l_shipdate, l_partkey, met) FROM come""",
        "stream_refund_window": f"""WITH {REFUNDS}, {REFUNDS_IN_SPAN}, {SKU},
            f AS (SELECT DISTINCT epoch_ms(l_shipdate) AS ts, id, sku_id AS sku, user_id FROM come)
            SELECT {_bounds('ts', DAY)}, {CHAIN}, user_id, count(*) AS refund_count
            FROM f LEFT JOIN sku ON f.sku = sku.sku_id
            WHERE {_closed(DAY, 2000, 'f')} GROUP BY ALL""",
        "stream_late_rows": f"""WITH {PAGES} SELECT {_bounds('ts', HOUR)}, count(*) AS pv_ct
            FROM page_log WHERE {_closed(HOUR, 2000, 'page_log')} GROUP BY ALL""",
    }


def _table_sql() -> dict[str, str]:
    return {
        "scalar_amounts": f"""SELECT l_orderkey, l_linenumber, l_partkey,
            CAST(CAST(CAST(l_quantity AS DECIMAL(16,2)) * CAST(l_extendedprice AS DECIMAL(16,2))
              AS DECIMAL(16,2)) AS DOUBLE) AS original_amount,
            TRY_CAST(l_returnflag AS INTEGER) AS flag_number,
            CAST(0 AS DOUBLE) AS status_amount,
            CASE WHEN l_quantity > 25 THEN 'many' ELSE 'few' END AS size FROM lineitem""",
        "time_texts": f"""SELECT event_id, epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y-%m-%d') AS day,
            {_time('ts')} AS time, epoch_ms(date_trunc('second', ts)) AS time_ms,
            epoch_ms(date_trunc('day', ts)) AS day_ms, strftime(ts, '%Y-%m-%d') AS time_day,
            strftime(ts, '%Y%m%d') AS day_number FROM events""",
        "zoned_millis": f"""WITH {K}, t AS (SELECT event_id, k % 3 + 1 AS n,
              (epoch_us(ts) // 1000) % 1000 AS ms, ts FROM ev)
            SELECT event_id, {_time('ts')} || '.' || substr(lpad(CAST(ms AS VARCHAR), 3, '0'), 1, n)
              || 'Z' AS text, epoch_ms(date_trunc('second', ts))
              + (ms // CAST(pow(10, 3 - n) AS BIGINT)) * CAST(pow(10, 3 - n) AS BIGINT) AS ms
            FROM t""",
        "camel_names": """SELECT o_orderkey AS "oOrderkey", o_custkey AS "oCustkey",
            o_orderstatus AS "oOrderstatus", o_totalprice AS "oTotalprice",
            o_orderpriority AS "oOrderpriority" FROM orders""",
        "keyword_words": f"""WITH w AS (SELECT unnest({_words('text')}) AS word FROM documents)
            SELECT word, count(*) AS n FROM w GROUP BY word""",
        "log_unreadable": f"""WITH {K} SELECT CASE WHEN k = 1 THEN 'cut' ELSE 'incomplete' END AS kind,
            CASE WHEN k = 3 THEN CAST(user_id AS VARCHAR) END AS mid, count(*) AS n
            FROM ev WHERE k IN (1, 2, 3) GROUP BY ALL""",
        "stream_log_job": f"""WITH {K}, t AS (SELECT *, CASE WHEN k = 1 THEN 'value' WHEN k = 2 THEN 'common.mid'
              WHEN k = 3 THEN 'page' WHEN k = 4 AND event_type <> 'signup' THEN 'ts' END AS field FROM ev),
            o AS (SELECT 'bad' AS output, field, CASE WHEN field IS NULL THEN 0 ELSE 1 END AS n FROM t
              UNION ALL SELECT 'page', NULL, CASE WHEN field IS NULL AND event_type <> 'signup' THEN 1 ELSE 0 END FROM t
              UNION ALL SELECT 'start', NULL, CASE WHEN field IS NULL AND event_type = 'signup' THEN 1 ELSE 0 END FROM t
              UNION ALL SELECT 'error', NULL, CASE WHEN field IS NULL AND event_type = 'error' THEN 1 ELSE 0 END FROM t
              UNION ALL SELECT 'display', NULL, CASE WHEN field IS NULL AND event_type <> 'signup' THEN k % 4 ELSE 0 END FROM t
              UNION ALL SELECT 'action', NULL, CASE WHEN field IS NULL AND event_type <> 'signup' THEN k % 3 ELSE 0 END FROM t)
            SELECT output, field, CAST(sum(n) AS BIGINT) AS n FROM o GROUP BY ALL HAVING sum(n) > 0""",
        "log_readable": f"""WITH {LOG} SELECT mid, uid, vc, ch, ar, flag AS is_new, page_id,
            last_page_id, CASE WHEN event_type <> 'signup' THEN CAST(k AS BIGINT) END AS during_time,
            CASE WHEN event_type = 'signup' THEN 'icon' END AS entry,
            CASE WHEN event_type = 'error' THEN CAST(k AS VARCHAR) END AS error_code,
            CAST(k % 4 AS INTEGER) AS displays, CAST(k % 3 AS INTEGER) AS actions, ms AS ts
            FROM good""",
        "change_route": f"""WITH t AS (SELECT {ORDER_COLUMNS}, o_orderdate FROM orders)
            SELECT * EXCLUDE (o_orderdate) REPLACE (
                CAST(CAST(total_amount AS DECIMAL(16,2)) AS VARCHAR) AS total_amount,
                CAST(CAST(original_total_amount AS DECIMAL(16,2)) AS VARCHAR)
                  AS original_total_amount,
                '5.00' AS activity_reduce_amount,
                CASE WHEN coupon_reduce_amount IS NOT NULL THEN '2.50' END
                  AS coupon_reduce_amount, '9.90' AS feight_fee, '0.00' AS feight_fee_reduce),
              '1001' AS order_status, CAST(NULL AS VARCHAR) AS operate_time,
              {_text('CAST(epoch(o_orderdate) AS BIGINT)')} AS ts FROM t""",
        "changed_fields": _payments("o_orderstatus <> 'P'"),
        "touched_fields": _payments("true"),
        "entry_pages": f"""WITH {PAGES} SELECT event_id, mid, ts FROM page_log
            WHERE last_page_id IS NULL""",
        "page_set": f"""WITH {PAGES} SELECT event_id, page_id, ts FROM page_log
            WHERE page_id = 'home'""",
        "logged_in_entries": f"""WITH {PAGES}, {LOGINS} SELECT event_id, uid, ts FROM entries""",
        "keyword_searches": f"WITH {SEARCHES} SELECT item, ts FROM searched",
        "live_records": """SELECT event_id, props AS value FROM events
            WHERE event_type <> 'error'""",
        "routed_changes": """
            SELECT 'sku_info' AS "table", 'bootstrap-insert' AS type, 'dim_sku_info' AS sink_table,
              '100' AS ts, CAST(p_partkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS name,
              'id,sku_name,tm_id' AS keys FROM part
            UNION ALL SELECT 'sku_info', 'update', 'dim_sku_info', '200',
              CAST(p_partkey AS VARCHAR), NULL, 'id,sku_name,tm_id' FROM part WHERE p_size > 25
            UNION ALL SELECT 'base_province', 'insert', 'dim_base_province', '100',
              CAST(n_nationkey AS VARCHAR), n_name, 'id,name' FROM nation""",
        "log_pages": f"""WITH {LOG} SELECT mid, uid, vc, ch, ar, is_new, page_id, last_page_id,
            CAST(k AS VARCHAR) AS item, 'sku_id' AS item_type, CAST(k AS BIGINT) AS during_time,
            CASE WHEN event_type = 'error' THEN CAST(k AS VARCHAR) END AS error_code, ms AS ts
            FROM log WHERE event_type <> 'signup'""",
        "log_starts": f"""WITH {LOG} SELECT mid, uid, vc, ch, ar, is_new, 'icon' AS entry,
            CAST(k AS VARCHAR) AS loading_time, ms AS ts FROM log WHERE event_type = 'signup'""",
        "log_displays": f"""WITH {LOG}, x AS (SELECT *, unnest(range(1, k % 4 + 1)) AS pos FROM texts)
            SELECT CAST(pos AS VARCHAR) AS pos_id, CAST(event_id AS VARCHAR) AS item, page_id,
            ms AS ts, common FROM x""",
        "log_actions": f"""WITH {LOG}, x AS (SELECT *, unnest(range(1, k % 3 + 1)) AS pos FROM texts)
            SELECT CAST(pos AS VARCHAR) AS pos_id, 'cart_add' AS action_id, page_id, ms AS ts,
            common FROM x""",
        "log_errors": f"""WITH {LOG} SELECT mid, uid, vc, ch, ar, is_new, page_id,
            CAST(k AS VARCHAR) AS error_code, 'x' AS msg, ms AS ts FROM log
            WHERE event_type = 'error'""",
        "order_detail_wide": f"WITH {DETAILS} SELECT * EXCLUDE (l_shipdate) FROM wide",
        "placed_orders": f"""WITH {DETAILS} SELECT * EXCLUDE (l_shipdate) FROM wide
            WHERE type = 'insert'""",
        "cancelled_orders": f"""WITH {DETAILS} SELECT * EXCLUDE (l_shipdate) FROM wide
            WHERE type = 'update' AND order_status = '1003'""",
        "cart_adds": f"WITH {CARTS} SELECT * EXCLUDE (moment) FROM carts",
        "paid_orders": f"WITH {PAID} SELECT * EXCLUDE (paid_at, l_shipdate) FROM paid",
        "paid_orders_in_span": f"""WITH {PAID} SELECT * EXCLUDE (paid_at, l_shipdate) FROM paid
            WHERE l_shipdate BETWEEN paid_at - INTERVAL 400 DAY AND paid_at + INTERVAL 400 DAY""",
        "order_refunds": f"""WITH {REFUNDS} SELECT * EXCLUDE (l_shipdate, l_partkey)
            FROM refunded""",
        "coupons_received": f"""SELECT {_text('o_orderkey')} AS id, {_text('o_custkey % 10')} AS coupon_id,
            {_text('o_custkey')} AS user_id, strftime(o_orderdate, '%Y-%m-%d') AS date_id,
            {_time('o_orderdate')} AS get_time, {_text('CAST(epoch(o_orderdate) AS BIGINT)')} AS ts
            FROM orders""",
        "coupons_ordered": _coupons("order_time", 2, "o_orderpriority IN ('1-URGENT', '2-HIGH')"),
        "coupons_paid": _coupons("payment_time", 26, "o_orderpriority = '1-URGENT'"),
        "favourites_added": f"""WITH {K} SELECT {_text('event_id')} AS id, {_text('user_id')} AS user_id,
            {_text('k')} AS sku_id, strftime(ts, '%Y-%m-%d') AS date_id, {_time('ts')} AS create_time,
            {_text('epoch_us(ts) // 1000000')} AS ts FROM ev
            WHERE event_type IN ('click', 'purchase')""",
        "comment_facts": f"""WITH {K}, {DIC}, c AS (SELECT *,
              list_extract(['A', 'N', 'R'], k % 3 + 1) AS code_of FROM ev)
            SELECT {_text('event_id')} AS id, {_text('user_id')} AS user_id, {_text('k')} AS sku_id,
              {_text('event_id')} AS order_id, strftime(ts, '%Y-%m-%d') AS date_id,
              {_time('ts')} AS create_time, code_of AS appraise_code, name AS appraise_name,
              {_text('epoch_us(ts) // 1000000')} AS ts
            FROM c LEFT JOIN dic ON code_of = code WHERE event_type = 'purchase'""",
        "registered_users": f"""WITH u AS (SELECT c_custkey, 1704067200 + c_custkey * 37 AS s
              FROM customer), t AS (SELECT *, make_timestamp(s * 1000000) AS moment FROM u)
            SELECT {_text('c_custkey')} AS user_id, strftime(moment, '%Y-%m-%d') AS date_id,
              {_time('moment')} AS create_time, {_text('s')} AS ts FROM t""",
        "lines_with_orders": f"""SELECT {_text('l_orderkey * 10 + l_linenumber')} AS id,
            {_text('l_orderkey')} AS order_id, {_text('l_partkey')} AS sku_id,
            {_time('l_shipdate')} AS create_time, {_text('o_custkey')} AS user_id,
            {_text('o_custkey % 25')} AS province_id
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "customer_provinces": f"""SELECT c_custkey, {_text('c_nationkey')} AS province_id,
            n_name AS province_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
        "coded_priorities": f"""WITH {DIC} SELECT o_orderkey, o_orderpriority, o_orderstatus,
            a.name AS priority_name, b.name AS status_name FROM orders
            JOIN dic a ON o_orderpriority = a.code LEFT JOIN dic b ON o_orderstatus = b.code""",
        "sku_chain_six": f"""WITH {SKU} SELECT l_orderkey, l_linenumber,
            {_text('l_partkey')} AS sku_id, spu_id, spu_name, {CHAIN}
            FROM lineitem LEFT JOIN sku ON sku.sku_id = {_text('l_partkey')}""",
        "sku_chain_five": f"""WITH {SKU} SELECT l_orderkey, l_linenumber,
            {_text('l_partkey')} AS sku_id, {CHAIN}
            FROM lineitem LEFT JOIN sku ON sku.sku_id = {_text('l_partkey')}""",
        "new_flag_repair": f"""WITH {PAGES}, oldest AS (SELECT mid,
              min(struct_pack(ts := ts, is_new := is_new, d := d)) AS v FROM page_log GROUP BY mid),
            since AS (SELECT mid, CASE WHEN v.is_new = '1' THEN v.d ELSE v.d - 1 END AS fd
              FROM oldest)
            SELECT event_id, p.mid, CASE WHEN is_new = '1' AND d = fd THEN '1' ELSE '0' END AS is_new,
              ts FROM page_log p JOIN since s ON p.mid = s.mid""",
        "unique_visitors": f"WITH {PAGES}, {VISITORS} SELECT event_id, mid, ts FROM visits",
        "daily_page_firsts": f"""WITH {PAGES}, {PAGE_FIRSTS} SELECT v.event_id AS event_id, mid,
            CAST(page_id = 'home' AS BIGINT) AS home_uv_ct,
            CAST(page_id <> 'home' AS BIGINT) AS good_detail_uv_ct FROM firsts""",
        "returning_users": f"""WITH {PAGES}, {LOGINS} SELECT event_id, uid, uu_ct, back_ct
            FROM logins""",
        "latest_lines": f"""WITH {LATEST} SELECT order_detail_id, sku_id, l_suppkey, user_id,
            CAST(amount AS DOUBLE) AS split_total_amount, ts FROM latest""",
        "ordering_users": f"""WITH {LATEST}, {USERS} SELECT order_detail_id, user_id, is_unique,
            is_new FROM flagged""",
        "first_copies": f"""WITH {LATEST}, f AS (SELECT order_detail_id, min(struct_pack(ts := ts,
              sku_id := sku_id, l_suppkey := l_suppkey, amount := amount)) AS v
              FROM lines GROUP BY order_detail_id)
            SELECT order_detail_id, v.sku_id AS sku_id, v.l_suppkey AS l_suppkey, v.ts AS ts
            FROM f""",
        "bounced_visits": f"WITH {PAGES}, {BOUNCED} SELECT event_id, mid, ts FROM bounced",
        "traffic_union": f"WITH {PAGES}, {VISITORS}, {BOUNCED}, {UNION} SELECT * FROM rows",
        "traffic_window": f"""WITH {PAGES}, {VISITORS}, {BOUNCED}, {UNION}
            SELECT {_bounds('ts', HOUR)}, vc, ch, ar, is_new, CAST(sum(uv_ct) AS BIGINT) AS uv_ct,
            CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
            CAST(sum(dur_sum) AS BIGINT) AS dur_sum, CAST(sum(uj_ct) AS BIGINT) AS uj_ct
            FROM rows GROUP BY ALL""",
        "keyword_window": f"""WITH {SEARCHES}, w AS (SELECT unnest({_words('item')}) AS keyword, ts
              FROM searched)
            SELECT {_bounds('ts', TEN_S)}, 'search' AS source, keyword, count(*) AS keyword_count
            FROM w GROUP BY ALL""",
        "home_detail_window": f"""WITH {PAGES}, {PAGE_FIRSTS} SELECT {_bounds('v.ts', HOUR)},
            count(*) FILTER (page_id = 'home') AS home_uv_ct,
            count(*) FILTER (page_id <> 'home') AS good_detail_uv_ct FROM firsts GROUP BY ALL""",
        "login_window": f"""WITH {PAGES}, {LOGINS} SELECT {_bounds('ts', HOUR)},
            CAST(sum(back_ct) AS BIGINT) AS back_ct, CAST(sum(uu_ct) AS BIGINT) AS uu_ct
            FROM logins GROUP BY ALL""",
        "register_window": _registers(TEN_S),
        "cart_window": f"""WITH {CARTS}, f AS (SELECT user_id, min(date_trunc('second', moment)) AS moment
              FROM carts GROUP BY user_id, CAST(moment AS DATE))
            SELECT {_bounds('epoch_ms(moment)', HOUR)}, count(*) AS cart_add_uu_ct FROM f GROUP BY ALL""",
        "order_window": _orders("activity", "coupon", "amount"),
        "order_window_compat": _orders("5.00", "0.00", "amount"),
        "payment_window": f"""WITH {PAID}, u AS (SELECT user_id, CAST(paid_at AS DATE) AS d,
              min(paid_at) AS moment FROM paid GROUP BY ALL),
            n AS (SELECT user_id, min(d) AS d FROM u GROUP BY user_id)
            SELECT {_bounds('epoch_ms(u.moment)', DAY)}, count(*) AS payment_suc_unique_user_count,
              count(n.d) AS payment_suc_new_user_count
            FROM u LEFT JOIN n ON u.user_id = n.user_id AND u.d = n.d GROUP BY ALL""",
        "province_window": f"WITH {LATEST}, {PROVINCES} SELECT * FROM provinces",
        "spu_order_window": f"""WITH {LATEST}, {SKU} SELECT {_bounds('ms', TEN_S)}, {CHAIN}, user_id,
            spu_id, spu_name, count(*) AS order_count, {_sum('amount')} AS order_amount
            FROM latest LEFT JOIN sku ON latest.sku_id = sku.sku_id GROUP BY ALL""",
        "refund_window": f"""WITH {REFUNDS}, {SKU}, f AS (SELECT id, min(struct_pack(
              moment := l_shipdate, sku_id := sku_id, user_id := user_id)) AS v FROM refunded GROUP BY id)
            SELECT {_bounds('epoch_ms(v.moment)', DAY)}, {CHAIN}, v.user_id AS user_id,
              count(*) AS refund_count FROM f LEFT JOIN sku ON f.v.sku_id = sku.sku_id
            GROUP BY ALL""",
        "daily_gmv": f"""WITH {LATEST} SELECT {_sum('amount')} AS order_amount FROM latest
            WHERE d = DATE '1998-07-04'""",
        "dimension_sync": """SELECT CAST(p_partkey AS VARCHAR) AS id,
            CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS name, 'sku' AS dim FROM part
            UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name, 'province' FROM nation""",
        "upserted_coupons": f"""WITH t AS (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 26
              WHEN '2-HIGH' THEN 2 ELSE 0 END AS h FROM orders)
            SELECT {_text('o_orderkey')} AS id, {_text('o_custkey')} AS user_id,
              strftime(o_orderdate + to_hours(h), '%Y-%m-%d') AS date_id,
              {_text('CAST(epoch(o_orderdate) AS BIGINT) + h * 3600')} AS ts FROM t""",
        "dimension_partial_rows": """SELECT CAST(p_partkey AS VARCHAR) AS id,
            CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS sku_name, p_brand AS tm_id FROM part""",
        "routed_versions": """
            SELECT 'sku_info' AS "table", 'bootstrap-insert' AS type, 'dim_sku_first' AS sink_table, '100' AS ts,
              CAST(p_partkey AS VARCHAR) AS id, 'id,sku_name' AS keys FROM part
            UNION ALL SELECT 'sku_info', 'update', 'dim_sku_info', '200', CAST(p_partkey AS VARCHAR), 'id,sku_name,tm_id'
            FROM part WHERE p_size > 25
            UNION ALL SELECT 'base_province', 'insert', 'dim_base_province', '100', CAST(n_nationkey AS VARCHAR), 'id,name'
            FROM nation""",
        "upserted_deletes": f"""SELECT {_text('o_orderkey')} AS id, {_text('o_custkey')} AS user_id,
              CASE WHEN o_orderpriority <> '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d') END AS date_id
            FROM orders WHERE o_orderpriority <> '1-URGENT' OR o_custkey % 2 = 0""",
        "upserted_by_two_streams": f"""SELECT {_text('o_orderkey')} AS id, {_text('o_custkey')} AS user_id,
              strftime(o_orderdate + to_hours(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 2 ELSE 0 END),
                       '%Y-%m-%d') AS date_id FROM orders""",
        "topic_round_trip": f"""WITH {K} SELECT {_text('event_id')} AS id, {_text('user_id')} AS user_id,
            {_text('k')} AS sku_id, {_time('ts')} AS create_time,
            CASE WHEN event_type = 'view' THEN '1' ELSE '0' END AS is_cancel,
            CASE WHEN event_type = 'click' THEN 'insert' ELSE 'update' END AS type,
            {_text('epoch_us(ts) // 1000000')} AS ts,
            CASE event_type WHEN 'view' THEN '0' WHEN 'purchase' THEN '1' END AS was_cancel
            FROM ev WHERE event_type IN ('click', 'view', 'purchase')""",
        "window_table_sink": _registers(TEN_MIN),
    }


def _payments(condition: str) -> str:
    return f"""SELECT {_text('o_custkey')} AS user_id, {_text('o_orderkey')} AS order_id,
        o_orderpriority AS payment_type,
        {_time('o_orderdate + to_minutes(CAST(o_custkey % 30 AS INTEGER))')} AS callback_time,
        CASE WHEN o_orderstatus = 'O' THEN '1601' ELSE '1602' END AS payment_status
        FROM orders WHERE {condition}"""


def _coupons(name: str, hours: int, condition: str) -> str:
    at = f"o_orderdate + INTERVAL {hours} HOUR"
    return f"""SELECT {_text('o_orderkey')} AS id, {_text('o_custkey % 10')} AS coupon_id,
        {_text('o_custkey')} AS user_id, {_text('o_orderkey')} AS order_id,
        strftime({at}, '%Y-%m-%d') AS date_id, {_time(at)} AS {name},
        {_text(f'CAST(epoch({at}) AS BIGINT)')} AS ts FROM orders WHERE {condition}"""


def _registers(size_ms: int) -> str:
    return f"""SELECT {_bounds('(1704067200 + c_custkey * 37) * 1000', size_ms)},
        count(*) AS register_ct FROM customer GROUP BY ALL"""


def _orders(activity: str, coupon: str, original: str) -> str:
    return f"""WITH {LATEST}, {USERS} SELECT {_bounds('ms', TEN_S)},
        CAST(sum(is_unique) AS BIGINT) AS order_unique_user_count,
        CAST(sum(is_new) AS BIGINT) AS order_new_user_count,
        {_sum(activity)} AS order_activity_reduce_amount,
        {_sum(coupon)} AS order_coupon_reduce_amount,
        {_sum(original)} AS order_original_total_amount FROM flagged GROUP BY ALL"""
