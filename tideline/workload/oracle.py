"""ANSI SQL, in DuckDB's dialect, that the registered queries are checked against."""

from __future__ import annotations

PAGE_LOG = """
page_log AS (
  SELECT event_id AS arrival, CAST(user_id AS VARCHAR) AS mid,
    CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS uid,
    'v' || (user_id % 3) AS vc, 'c' || (user_id % 2) AS ch, 'a' || (user_id % 5) AS ar,
    CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' ELSE event_type END AS page_id,
    CASE WHEN event_type IN ('view', 'error') THEN NULL WHEN event_type = 'signup' THEN 'login'
         ELSE 'home' END AS last_page_id,
    CAST(round(value * 1000) AS BIGINT) AS during_time, epoch_us(ts) // 1000 AS ts,
    strftime(ts, '%Y-%m-%d') AS day, event_type
  FROM events)"""

FLAT = "arrival, mid, uid, page_id, last_page_id, during_time, ts"

ORDERS = """
order_times AS (
  SELECT o.*, c_nationkey, o_orderdate + to_seconds(o_orderkey % 20) AS created
  FROM orders o JOIN customer ON o_custkey = c_custkey),
order_lines AS (
  SELECT l.*, t.*, l_orderkey || '-' || l_linenumber AS detail_id
  FROM lineitem l JOIN order_times t ON l_orderkey = o_orderkey)"""

T = "'%Y-%m-%d %H:%M:%S'"

ORDER_DETAIL = ORDERS + f""",
order_detail AS (
  SELECT detail_id AS id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
    CAST(l_partkey AS VARCHAR) AS sku_id, 'sku-' || l_partkey AS sku_name,
    CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS sku_num,
    CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS order_price,
    CAST(c_nationkey AS VARCHAR) AS province_id, CAST(NULL AS VARCHAR) AS activity_id,
    CAST(NULL AS VARCHAR) AS activity_rule_id, CAST(NULL AS VARCHAR) AS coupon_id,
    strftime(created, {T}) AS create_time, CAST(NULL AS VARCHAR) AS source_id,
    CAST(l_orderkey % 6 AS VARCHAR) AS source_type_id, CAST(NULL AS VARCHAR) AS source_type_name,
    CAST(NULL AS VARCHAR) AS split_activity_amount, CAST(NULL AS VARCHAR) AS split_coupon_amount,
    CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS split_total_amount,
    strftime(l_shipdate, {T}) || 'Z' AS row_op_ts, l_partkey AS part, l_suppkey AS supp,
    created, l_extendedprice AS amount, o_orderstatus
  FROM order_lines),
latest AS (
  SELECT * FROM order_detail
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_op_ts DESC, part DESC, supp DESC) = 1),
earliest AS (
  SELECT * FROM order_detail
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_op_ts, part, supp) = 1)"""

DETAIL_COLUMNS = """id, order_id, user_id, sku_id, sku_name, sku_num, order_price, province_id, activity_id,
  activity_rule_id, coupon_id, create_time, source_id, source_type_id, source_type_name,
  split_activity_amount, split_coupon_amount, split_total_amount"""

CHANGES = ORDERS + f""",
od AS (
  SELECT detail_id AS id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
    'sku-' || l_partkey AS sku_name, CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS order_price,
    CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS sku_num,
    strftime(created + to_seconds(l_linenumber), {T}) AS create_time,
    CAST(l_orderkey % 6 AS VARCHAR) AS source_type, CAST(l_suppkey AS VARCHAR) AS source_id,
    CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS split_total_amount,
    created + to_seconds(l_linenumber) AS t, [epoch_ms(l_shipdate), l_partkey, l_suppkey] AS seq
  FROM order_lines),
oi AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
    CAST(c_nationkey AS VARCHAR) AS province_id, o_orderstatus AS order_status,
    CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS total_amount,
    strftime(created, {T}) AS create_time, created AS t, [0, o_orderkey, 0] AS seq
  FROM order_times),
extra AS (
  SELECT detail_id || '-' || l_partkey || '-' || l_suppkey AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
    detail_id AS order_detail_id, l_partkey, l_suppkey, l_linenumber, l_returnflag,
    CAST(l_partkey AS VARCHAR) AS sku_id, created + to_seconds(l_linenumber + l_suppkey % 8) AS t,
    [epoch_ms(l_shipdate), l_partkey, l_suppkey] AS seq
  FROM order_lines),
oa AS (
  SELECT id, order_id, order_detail_id, CAST(l_suppkey AS VARCHAR) AS activity_id,
    CAST(l_suppkey % 10 AS VARCHAR) AS activity_rule_id, sku_id, strftime(t, {T}) AS create_time, t, seq
  FROM extra WHERE l_linenumber % 3 = 0),
oc AS (
  SELECT id, order_id, order_detail_id, CAST(l_partkey AS VARCHAR) AS coupon_id,
    CAST(l_partkey % 10 AS VARCHAR) AS coupon_use_id, sku_id, strftime(t, {T}) AS create_time, t, seq
  FROM extra WHERE l_returnflag = 'R'),
dic AS (
  SELECT DISTINCT substr(o_orderpriority, 1, 1) AS dic_code, o_orderpriority AS dic_name FROM orders),
pay AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_orderkey AS VARCHAR) AS order_id,
    CAST(o_orderkey % 7 AS VARCHAR) AS payment_type,
    created + to_seconds(o_orderkey % 1800) AS t,
    strftime(created + to_seconds(o_orderkey % 1800), {T}) AS callback_time
  FROM order_times WHERE o_orderstatus = 'F')"""

WIDE = CHANGES + """,
versions AS (
  SELECT od.id, od.order_id, oi.user_id, od.sku_id, od.sku_name, od.sku_num, od.order_price, oi.province_id,
    oa.activity_id, oa.activity_rule_id, oc.coupon_id, od.create_time, od.source_id,
    od.source_type AS source_type_id, dic.dic_name AS source_type_name,
    CAST(NULL AS VARCHAR) AS split_activity_amount, CAST(NULL AS VARCHAR) AS split_coupon_amount,
    od.split_total_amount,
    [greatest(od.seq, oi.seq, coalesce(oa.seq, [0]), coalesce(oc.seq, [0])), od.seq, oi.seq, oa.seq, oc.seq] AS version
  FROM od
  JOIN oi ON od.order_id = oi.id AND abs(epoch_ms(od.t) - epoch_ms(oi.t)) <= 5000
  LEFT JOIN oa ON od.id = oa.order_detail_id AND abs(epoch_ms(od.t) - epoch_ms(oa.t)) <= 5000
  LEFT JOIN oc ON od.id = oc.order_detail_id AND abs(epoch_ms(od.t) - epoch_ms(oc.t)) <= 5000
  JOIN dic ON od.source_type = dic.dic_code),
wide AS (SELECT * EXCLUDE (version) FROM versions)"""

SPU_DIMS = """
sku_info AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, CAST(p_size AS VARCHAR) AS spu_id, p_brand AS tm_id,
    CAST(p_partkey % 100 AS VARCHAR) AS category3_id FROM part WHERE p_partkey % 11 <> 4),
spu_info AS (
  SELECT DISTINCT CAST(p_size AS VARCHAR) AS id, 'spu-' || p_size AS spu_name FROM part WHERE p_size <> 13),
trademark AS (SELECT DISTINCT p_brand AS id, upper(p_brand) AS tm_name FROM part WHERE p_brand <> 'Brand#7'),
category3 AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS category2_id
  FROM supplier WHERE s_suppkey % 10 <> 3),
category2 AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, CAST(n_regionkey AS VARCHAR) AS category1_id
  FROM nation WHERE n_nationkey % 7 <> 3),
category1 AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS id, r_name AS name FROM region WHERE r_regionkey <> 4)"""


def _window(time, seconds):
    """Epoch-aligned window bounds of a timestamp, as text columns stt and edt."""
    width = f"{seconds * 1_000_000}"
    start = f"(epoch_us({time}) - epoch_us({time}) % CAST({width} AS BIGINT))"
    return (f"strftime(make_timestamp({start}), {T}) AS stt, "
            f"strftime(make_timestamp({start} + CAST({width} AS BIGINT)), {T}) AS edt")


def _window_ms(time, seconds):
    return _window(f"make_timestamp({time} * 1000)", seconds)


DAY, MONTH = 86_400, 30 * 86_400

FIRST_VISIT = """
visitor AS (
  SELECT * FROM page_log WHERE last_page_id IS NULL
  QUALIFY row_number() OVER (PARTITION BY mid, day ORDER BY ts, arrival) = 1)"""


def _bounced(within):
    return f"""
followed AS (
  SELECT *, lead(ts) OVER w AS next_ts, lead(last_page_id IS NULL) OVER w AS next_start
  FROM page_log WINDOW w AS (PARTITION BY mid ORDER BY ts, arrival)),
bounced AS (
  SELECT * FROM followed WHERE last_page_id IS NULL
    AND (next_ts IS NULL OR next_start OR next_ts - ts >= {within}))"""


def _visit_summary(seconds):
    return f"""WITH {PAGE_LOG}, {FIRST_VISIT}, {_bounced(10_000)},
metric AS (
  SELECT vc, ch, ar, ts, 1 AS uv, 0 AS sv, 0 AS pv, 0 AS dur, 0 AS uj FROM visitor
  UNION ALL SELECT vc, ch, ar, ts, 0, 0, 0, 0, 1 FROM bounced
  UNION ALL SELECT vc, ch, ar, ts, 0, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END, 1, during_time, 0
    FROM page_log)
SELECT {_window_ms('ts', seconds)}, ar, ch, vc, CAST(sum(uv) AS BIGINT) AS uv_ct,
  CAST(sum(sv) AS BIGINT) AS sv_ct, CAST(sum(pv) AS BIGINT) AS pv_ct, CAST(sum(dur) AS BIGINT) AS dur_sum,
  CAST(sum(uj) AS BIGINT) AS uj_ct
FROM metric GROUP BY 1, 2, ar, ch, vc"""


def _home_detail(seconds):
    return f"""WITH {PAGE_LOG}, firsts AS (
  SELECT * FROM page_log WHERE page_id IN ('home', 'good_detail')
  QUALIFY row_number() OVER (PARTITION BY mid, page_id, day ORDER BY ts, arrival) = 1)
SELECT {_window_ms('ts', seconds)}, count(*) FILTER (WHERE page_id = 'home') AS home_uv_ct,
  count(*) FILTER (WHERE page_id = 'good_detail') AS good_detail_uv_ct
FROM firsts GROUP BY 1, 2"""


def _login_flags(gap):
    return f"""WITH {PAGE_LOG}, firsts AS (
  SELECT * FROM page_log WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login')
  QUALIFY row_number() OVER (PARTITION BY uid, day ORDER BY ts, arrival) = 1),
flags AS (
  SELECT *, CASE WHEN date_diff('day', CAST(lag(day) OVER (PARTITION BY uid ORDER BY day) AS DATE),
    CAST(day AS DATE)) >= {gap} THEN 1 ELSE 0 END AS back FROM firsts)"""


def _login(gap):
    return f"""{_login_flags(gap)}
SELECT {_window_ms('ts', 10)}, CAST(sum(back) AS BIGINT) AS back_ct, count(*) AS uu_ct
FROM flags GROUP BY 1, 2"""


def _province(seconds, join="LEFT JOIN"):
    return f"""WITH {ORDER_DETAIL}, totals AS (
  SELECT {_window('created', seconds)}, province_id, count(DISTINCT order_id) AS order_count,
    CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS order_amount
  FROM latest GROUP BY 1, 2, province_id)
SELECT t.*, coalesce(n_name, '') AS province_name
FROM totals t {join} (SELECT * FROM nation WHERE n_nationkey % 7 <> 3) n
  ON t.province_id = CAST(n_nationkey AS VARCHAR)"""


def _user_spu(seconds):
    return f"""WITH {ORDER_DETAIL}, {SPU_DIMS}, totals AS (
  SELECT {_window('created', seconds)}, user_id, spu_id, tm_id, category3_id,
    count(DISTINCT order_id) AS order_count,
    CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS order_amount
  FROM earliest LEFT JOIN sku_info s ON sku_id = s.id GROUP BY 1, 2, user_id, spu_id, tm_id, category3_id)
SELECT stt, edt, user_id, spu_id, spu_name, t.tm_id AS trademark_id, tm_name AS trademark_name,
  category3_id, c3.name AS category3_name, category2_id, c2.name AS category2_name, category1_id,
  c1.name AS category1_name, order_count, order_amount
FROM totals t LEFT JOIN spu_info ON spu_id = spu_info.id LEFT JOIN trademark ON t.tm_id = trademark.id
LEFT JOIN category3 c3 ON category3_id = c3.id LEFT JOIN category2 c2 ON category2_id = c2.id
LEFT JOIN category1 c1 ON category1_id = c1.id"""


PAYERS = f"""WITH {ORDERS}, versions AS (
  SELECT detail_id, CAST(o_custkey AS VARCHAR) AS user_id, created + to_seconds(o_orderkey % 1800) AS t
  FROM order_lines WHERE o_orderstatus = 'F'
  QUALIFY row_number() OVER (PARTITION BY detail_id ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1),
firsts AS (
  SELECT *, strftime(t, '%Y-%m-%d') AS day FROM versions
  QUALIFY row_number() OVER (PARTITION BY user_id, strftime(t, '%Y-%m-%d') ORDER BY t, detail_id) = 1),
flags AS (
  SELECT *, CASE WHEN day = min(day) OVER (PARTITION BY user_id) THEN 1 ELSE 0 END AS is_new FROM firsts)"""


def _payers(seconds):
    return f"""{PAYERS}
SELECT {_window('t', seconds)}, count(*) AS unique_user_ct, CAST(sum(is_new) AS BIGINT) AS new_user_ct
FROM flags GROUP BY 1, 2"""


RAW = PAGE_LOG + """,
raw AS (
  SELECT *, CASE WHEN arrival % 17 = 0 THEN 'oops-' || arrival WHEN arrival % 23 = 0 THEN '' END AS bad
  FROM page_log)"""

SKU = """
sku AS (
  SELECT 'dim_sku_info' AS sink_table, CAST(p_partkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS name,
    CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS sku_name,
    CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS tm_id, CAST(p_size AS VARCHAR) AS spu_id
  FROM part),
supp AS (
  SELECT 'dim_supplier' AS sink_table, CAST(s_suppkey AS VARCHAR) AS id,
    CASE WHEN s_suppkey % 2 = 0 THEN s_name || '''s' ELSE s_name END AS name,
    CAST(NULL AS VARCHAR) AS sku_name, CAST(NULL AS VARCHAR) AS tm_id, CAST(NULL AS VARCHAR) AS spu_id
  FROM supplier)"""

SNAPSHOT = f"WITH {SKU} SELECT * FROM sku UNION ALL SELECT * FROM supp"


def _lookup(join):
    return f"""WITH {SPU_DIMS}
SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) AS category2_id, c2.name AS nation, c2.category1_id,
  c1.name AS region
FROM supplier {join} category2 c2 ON CAST(s_nationkey AS VARCHAR) = c2.id
{join} category1 c1 ON c2.category1_id = c1.id"""


def _nulls(*names):
    return ", ".join(f"CAST(NULL AS VARCHAR) AS {n}" for n in names)


SQL = {
    "parse_and_split_dirty": f"""WITH {RAW}
SELECT CASE WHEN bad IS NULL THEN 'good' ELSE 'dirty' END AS kind,
  coalesce(bad, mid || '@' || ts) AS text FROM raw""",
    "page_view_log": f"""WITH {RAW}
SELECT arrival, CAST(NULL AS VARCHAR) AS displays, CAST(NULL AS VARCHAR) AS actions, mid, uid, page_id,
  last_page_id, during_time, ts FROM raw WHERE bad IS NULL AND event_type <> 'error'""",
    "page_view_typed": f"""WITH {RAW}
SELECT mid, page_id, ts FROM raw WHERE bad IS NULL AND event_type <> 'error'""",
    "session_starts": f"WITH {PAGE_LOG} SELECT {FLAT} FROM page_log WHERE last_page_id IS NULL",
    "filter_pages": f"WITH {PAGE_LOG} SELECT {FLAT} FROM page_log WHERE page_id IN ('home', 'good_detail')",
    "login_events": f"""WITH {PAGE_LOG} SELECT {FLAT} FROM page_log
WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login')""",
    "visit_metric_rows": f"""WITH {PAGE_LOG}
SELECT vc, ch, ar, CAST(0 AS BIGINT) AS uv_ct,
  CAST(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS BIGINT) AS sv_ct, CAST(1 AS BIGINT) AS pv_ct,
  during_time AS dur_sum, CAST(0 AS BIGINT) AS uj_ct, ts FROM page_log
UNION ALL SELECT vc, ch, ar, 0, 0, 0, 0, 1, ts FROM page_log WHERE last_page_id IS NULL""",
    "unique_visitor_daily": f"WITH {PAGE_LOG}, {FIRST_VISIT} SELECT {FLAT} FROM visitor",
    "bounces_10s": f"WITH {PAGE_LOG}, {_bounced(10_000)} SELECT {FLAT} FROM bounced",
    "bounces_1h": f"WITH {PAGE_LOG}, {_bounced(3_600_000)} SELECT {FLAT} FROM bounced",
    "visit_summary_10s": _visit_summary(10),
    "visit_summary_1d": _visit_summary(DAY),
    "home_detail_uv_10s": _home_detail(10),
    "home_detail_uv_1d": _home_detail(DAY),
    "login_returning_10s": _login(8),
    "login_returning_gap3_10s": _login(3),
    "daily_login_flags": f"""{_login_flags(3)}
SELECT uid, day, ts, arrival, CAST(back AS BIGINT) AS back_ct, CAST(1 AS BIGINT) AS uu_ct FROM flags""",
    "cdc_order_detail": f"""WITH {CHANGES}
SELECT id, order_id, sku_id, sku_name, order_price, sku_num, create_time, source_type, source_id,
  split_total_amount, {_nulls('split_activity_amount', 'split_coupon_amount')} FROM od""",
    "cdc_order_info": f"""WITH {CHANGES}
SELECT id, {_nulls('consignee', 'consignee_tel')}, total_amount, order_status, user_id,
  {_nulls('payment_way', 'delivery_address', 'order_comment', 'out_trade_no', 'trade_body')}, create_time,
  {_nulls('operate_time', 'expire_time', 'process_status', 'tracking_no', 'parent_order_id')}, province_id,
  {_nulls('activity_reduce_amount', 'coupon_reduce_amount', 'original_total_amount', 'feight_fee',
          'feight_fee_reduce', 'refundable_time')} FROM oi""",
    "cdc_order_activity": f"""WITH {CHANGES}
SELECT id, order_id, order_detail_id, activity_id, activity_rule_id, sku_id, create_time FROM oa""",
    "cdc_order_coupon": f"""WITH {CHANGES}
SELECT id, order_id, order_detail_id, coupon_id, coupon_use_id, sku_id, create_time FROM oc""",
    "payment_success_view": f"""WITH {CHANGES} SELECT user_id, order_id, payment_type, callback_time FROM pay""",
    "order_detail_wide": f"WITH {WIDE} SELECT * FROM wide",
    "order_detail_upsert": f"""WITH {WIDE} SELECT * EXCLUDE (version) FROM versions
QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1""",
    "pay_detail_success": f"""WITH {ORDER_DETAIL}, {CHANGES[len(ORDERS) + 1:]}
SELECT d.id AS order_detail_id, d.order_id, d.user_id, d.sku_id, d.sku_name, d.province_id, d.activity_id,
  d.activity_rule_id, d.coupon_id, payment_type AS payment_type_code, dic_name AS payment_type_name,
  callback_time, d.source_id, d.source_type_id, d.source_type_name, d.sku_num, d.order_price,
  d.split_activity_amount, d.split_coupon_amount, d.split_total_amount AS split_payment_amount, row_op_ts
FROM pay JOIN order_detail d ON pay.order_id = d.order_id AND abs(epoch_ms(pay.t) - epoch_ms(d.created)) <= 905000
JOIN dic ON payment_type = dic_code""",
    "latest_per_detail": f"WITH {ORDER_DETAIL} SELECT {DETAIL_COLUMNS}, row_op_ts FROM latest",
    "first_per_detail": f"WITH {ORDER_DETAIL} SELECT {DETAIL_COLUMNS}, row_op_ts FROM earliest",
    "left_join_upsert": """
SELECT id AS id_a, b.id_b, name_a, name_b
FROM (SELECT CAST(o_custkey AS VARCHAR) AS id, printf('%012d', 999999999999 - max(o_orderkey)) AS name_a FROM orders GROUP BY 1) a
LEFT JOIN (SELECT CAST(c_custkey AS VARCHAR) AS id_b, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS name_b
           FROM customer WHERE c_acctbal > 0) b
  ON a.id = b.id_b""",
    "order_metric_rows": f"""WITH {ORDER_DETAIL}
SELECT id, province_id, order_id, CAST(split_total_amount AS DOUBLE) AS order_amount,
  epoch_ms(created) AS ts FROM order_detail""",
    "window_sums": f"""WITH {ORDER_DETAIL}
SELECT {_window('created', MONTH)}, province_id, CAST(sum(CAST(sku_num AS BIGINT)) AS BIGINT) AS qty
FROM order_detail GROUP BY 1, 2, province_id""",
    "distinct_orders": f"""WITH {ORDER_DETAIL}
SELECT {_window('created', MONTH)}, province_id, count(DISTINCT order_id) AS order_count,
  CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS order_amount
FROM order_detail GROUP BY 1, 2, province_id""",
    "province_orders_10s": _province(10),
    "province_orders_30d": _province(MONTH),
    "province_orders_drop_30d": _province(MONTH, "JOIN"),
    "user_spu_orders_10s": _user_spu(10),
    "user_spu_orders_30d": _user_spu(MONTH),
    "daily_payer_flags": f"""{PAYERS}
SELECT user_id, day, strftime(t, {T}) AS callback_time, CAST(1 AS BIGINT) AS unique_user_ct,
  CAST(is_new AS BIGINT) AS new_user_ct FROM flags""",
    "paying_users_10s": _payers(10),
    "paying_users_1d": _payers(DAY),
    "config_routing": """
SELECT 'dim_sku_info' AS sink_table, 'insert' AS type, 'id=' || p_partkey || ';sku_name=' || p_name
  || ';spu_id=' || p_size || ';tm_id=' || p_brand AS data FROM part
UNION ALL SELECT 'dim_sku_info', 'update', 'id=' || p_partkey || ';sku_name=' || upper(p_name)
  FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT 'dim_sku_info', 'update', 'id=' || p_partkey || ';tm_id=' FROM part WHERE p_partkey % 5 = 0
UNION ALL SELECT 'dim_supplier', 'bootstrap-insert', 'id=' || s_suppkey || ';name=' || s_name FROM supplier
UNION ALL SELECT 'dim_supplier', 'update', 'id=' || s_suppkey || ';name=' || s_name || '''s'
  FROM supplier WHERE s_suppkey % 2 = 0""",
    "dimension_snapshot": SNAPSHOT,
    "dimension_compacted": SNAPSHOT,
    "nation_region_lookup": _lookup("LEFT JOIN"),
    "nation_region_lookup_drop": _lookup("JOIN"),
    "compare_row_time": f"""WITH {ORDERS}, stamps AS (
  SELECT *, epoch_ms(l_shipdate) + CASE l_linenumber % 4 WHEN 0 THEN 0 WHEN 1 THEN 410 WHEN 2 THEN 41
    ELSE 302 END AS a FROM order_lines)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(sign(a - (epoch_ms(created) + 41)) AS BIGINT) AS against_order,
  CAST(sign(a - (epoch_ms(l_shipdate) + 41)) AS BIGINT) AS against_same_second FROM stamps""",
    "time_text": f"""WITH {ORDERS}
SELECT o_orderkey, epoch_ms(created) AS ms, strftime(created, {T}) AS date_time,
  strftime(created, '%Y-%m-%d') AS date, strftime(created, '%Y-%m-%d') AS date_part,
  epoch_ms(created) AS full_ms, epoch_ms(date_trunc('day', created)) AS day_ms,
  CAST(NULL AS BIGINT) AS bad_ms, date_diff('day', DATE '1995-01-01', CAST(created AS DATE)) AS days
FROM order_times""",
    "summary_sink_columns": f"SELECT * FROM ({_user_spu(MONTH)})",
    "json_scalars": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS DOUBLE) AS not_a_number,
  event_type AS kind, CAST(NULL AS VARCHAR) AS absent,
  CAST(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END AS BIGINT) AS listed,
  CAST(CASE WHEN event_type IN ('view', 'click') THEN 2 ELSE 3 END AS BIGINT) AS members,
  upper(event_type) AS upper_name FROM events""",
    "topic_roundtrip": f"WITH {ORDER_DETAIL} SELECT {DETAIL_COLUMNS}, row_op_ts FROM order_detail",
    "changelog_roundtrip": f"""WITH {CHANGES}
SELECT 'order_detail' AS "table", 'insert' AS type, id, order_id, create_time, id AS old_id FROM od
UNION ALL SELECT 'order_info', 'insert', id, NULL, create_time, id FROM oi
UNION ALL SELECT 'order_detail_activity', 'insert', id, order_id, create_time, id FROM oa
UNION ALL SELECT 'order_detail_coupon', 'insert', id, order_id, create_time, id FROM oc
UNION ALL SELECT 'payment_info', 'update', CAST(o_orderkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), NULL,
  CAST(o_orderkey AS VARCHAR) FROM orders""",
}
