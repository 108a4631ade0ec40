"""The registered queries as plain SQL over the same tables, for the comparison in DuckDB."""

from __future__ import annotations


def money(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(16,2)) AS VARCHAR)"


def moment(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def seconds(column: str) -> str:
    return f"CAST(epoch({column}) AS BIGINT)"


LINE_ID = ("md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, "
           + ", ".join(money(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
           + f", l_returnflag, l_linestatus, {moment('l_shipdate')}))")

# Order lines as the change log's text values.
LINES = f"""
lines AS (
  SELECT {LINE_ID} AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(l_partkey AS VARCHAR) AS sku_id, 'sku-' || l_partkey AS sku_name,
    {money('l_extendedprice')} AS order_price,
    CAST(CAST(l_quantity AS INT) AS VARCHAR) AS sku_num,
    {moment('l_shipdate')} AS create_time, 'N' || (l_suppkey % 30) AS source_type,
    CAST(l_suppkey AS VARCHAR) AS source_id, {money('l_extendedprice')} AS split_total_amount,
    {money('l_discount')} AS split_activity_amount, {money('l_tax')} AS split_coupon_amount,
    CAST(CAST(CAST(l_quantity AS INT) AS DECIMAL(16,2)) * CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR)
      AS split_original_amount,
    CAST({seconds('l_shipdate')} AS VARCHAR) AS ts,
    CASE WHEN l_discount >= 0.05 THEN CAST(l_partkey % 100 AS VARCHAR) END AS activity_id,
    CASE WHEN l_discount >= 0.05 THEN CAST(l_suppkey % 10 AS VARCHAR) END AS activity_rule_id,
    CASE WHEN l_returnflag = 'R' THEN CAST(l_partkey % 50 AS VARCHAR) END AS coupon_id,
    CASE WHEN l_returnflag = 'R' THEN CAST(l_suppkey AS VARCHAR) END AS coupon_use_id,
    l_linestatus, l_returnflag, l_orderkey, l_partkey, l_suppkey, l_linenumber
  FROM lineitem)"""

PLACED = f"""
placed AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'buyer-' || o_custkey AS consignee,
    '13' || o_custkey AS consignee_tel, {money('o_totalprice')} AS total_amount,
    '1001' AS order_status, CAST(o_custkey AS VARCHAR) AS user_id,
    o_orderpriority AS delivery_address, CAST(NULL AS VARCHAR) AS order_comment,
    'T' || o_orderkey AS out_trade_no, CAST(NULL AS VARCHAR) AS trade_body,
    CAST(NULL AS VARCHAR) AS process_status, CAST(NULL AS VARCHAR) AS tracking_no,
    CAST(NULL AS VARCHAR) AS parent_order_id, CAST(o_custkey % 34 AS VARCHAR) AS province_id,
    '0.00' AS activity_reduce_amount, '0.00' AS coupon_reduce_amount,
    {money('o_totalprice')} AS original_total_amount, '8.00' AS feight_fee,
    CAST(NULL AS VARCHAR) AS feight_fee_reduce
  FROM orders)"""

# Of an order's two changes in one second the second stays.
CHANGED = f"""
changed AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
    CAST((o_custkey + 1) % 34 AS VARCHAR) AS province_id, {moment('o_orderdate')} AS operate_time,
    CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'P' THEN '1005' ELSE '1006' END AS code,
    CAST({seconds('o_orderdate')} AS VARCHAR) AS ts
  FROM orders)"""

CHANGED_ONCE = CHANGED.replace("(o_custkey + 1) % 34", "o_custkey % 34")

DICTIONARY = """
dictionary AS (
  SELECT 'N' || n_nationkey AS dic_code, n_name AS dic_name FROM nation
  UNION ALL SELECT 'R' || r_regionkey, r_name FROM region)"""

NUMBER = "CAST(json_extract_string(props, '$.k') AS INT)"

PAYMENTS = f"""
payments AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
    CAST(user_id AS VARCHAR) AS order_id, 'N' || ({NUMBER} % 30) AS payment_type,
    {moment('ts')} AS callback_time,
    CASE WHEN {NUMBER} % 3 = 0 THEN '1601' ELSE '1602' END AS payment_status,
    CAST(floor(epoch(ts)) AS BIGINT) AS s
  FROM events WHERE event_type = 'purchase')"""

SEEN = f"""
seen AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS order_id,
    CAST({NUMBER} AS VARCHAR) AS sku_id, event_type AS sku_name,
    CAST(user_id % 34 AS VARCHAR) AS province_id, {money('value')} AS split_total_amount,
    CAST(floor(epoch(ts)) AS BIGINT) AS s
  FROM events WHERE event_type IN ('view', 'click'))"""

# Changes of the dimension tables: identity and payload of each message.
DIMENSIONS = """
dimensions AS (
  SELECT 'base_region' AS tbl, unnest(['bootstrap-start', 'bootstrap-insert', 'bootstrap-complete']) AS kind,
    1700000000 AS ts, CAST(r_regionkey AS VARCHAR) AS id, CAST(r_regionkey AS VARCHAR) AS pk,
    '{"id":"' || r_regionkey || '","region_name":"' || r_name || '"}' AS dim,
    '{"id":' || r_regionkey || '}' AS fact, 0 AS place FROM region
  UNION ALL SELECT 'base_province', 'bootstrap-insert', 1700000000, CAST(n_nationkey AS VARCHAR),
    CAST(n_nationkey AS VARCHAR),
    '{"id":"' || n_nationkey || '","name":"' || n_name || '","region_id":"' || n_regionkey || '"}',
    NULL, 0 FROM nation
  UNION ALL SELECT 'user_info', 'insert', 1700000000 + c_custkey, CAST(c_custkey AS VARCHAR),
    CAST(c_custkey AS VARCHAR),
    '{"id":"' || c_custkey || '","name":"' || c_name || '","province_id":"' || c_nationkey || '"}',
    '{"id":' || c_custkey || ',"name":"' || c_name || '","segment":"' || c_mktsegment || '"}', 0 FROM customer
  UNION ALL SELECT 'shop_info', 'insert', 1700000000 + s_suppkey, CAST(s_suppkey AS VARCHAR),
    CAST(s_suppkey AS VARCHAR),
    '{"id":"' || s_suppkey || '","name":"' || s_name || '"}', NULL, 0 FROM supplier
  UNION ALL SELECT 'base_brand', 'update', 1700000000 + p_partkey // 100, NULL, p_brand,
    '{"tm_id":"' || p_brand || '","tm_name":"' || p_name || '"}', NULL, p_partkey FROM part)"""

# Dimension rows with the destination that held at their time.
AS_OF = f"""WITH {DIMENSIONS}, halves AS (
  SELECT 1700000000 + (SELECT max(c_custkey) // 2 FROM customer) AS users,
    1700000000 + (SELECT max(s_suppkey) // 2 FROM supplier) AS shops),
routed AS (
  SELECT CASE WHEN tbl = 'user_info' AND ts >= users THEN 'dim_user_new' ELSE 'dim_' || tbl END AS sink_table, pk AS row_key,
    CASE WHEN tbl = 'user_info' AND ts >= users THEN left(dim, len(dim) - 1) || ',"segment"' || split_part(fact, ',"segment"', 2)
      ELSE dim END AS payload, ts, place
  FROM dimensions, halves
  WHERE kind NOT IN ('bootstrap-start', 'bootstrap-complete') AND (tbl <> 'shop_info' OR ts < shops))"""

COMMENT_FACT = """SELECT 'dwd_comment' AS sink_table, '{"id":' || o_orderkey || ',"user_id":' || o_custkey
    || ',"appraise":"N' || (o_custkey % 30) || '"}' AS payload, CAST(epoch(o_orderdate) AS BIGINT) AS ts
  FROM orders"""
FACT_ROWS = f"""
  SELECT CASE tbl WHEN 'user_info' THEN 'dwd_user_register' END AS sink_table, fact AS payload,
    CAST(ts AS BIGINT) AS ts FROM dimensions WHERE tbl = 'user_info' AND kind = 'insert'
  UNION ALL {COMMENT_FACT}"""

# Page log: the parts of each record as text, as sent (raw) and as text maps.
RECORDS = f"""
events_k AS (SELECT *, {NUMBER} AS k, epoch_us(ts) // 1000 AS ms FROM events),
parts AS (
  SELECT event_id, k, ms, user_id, 'mid_' || user_id AS mid, event_type = 'signup' AS started,
    event_type = 'error' AS failed, CAST(ts AS DATE) AS day,
    '{{"ar":"' || (user_id % 34) || '","is_new":"' AS common_head,
    '","mid":"mid_' || user_id || '","uid":"' || user_id || '"}}' AS common_tail,
    '"page":{{"page_id":"' || event_type || '","last_page_id":"home","item":"' || k
      || '","item_type":"sku_id","during_time":' AS page_head,
    '"start":{{"entry":"icon","loading_time":' AS start_head,
    list_transform(range(k % 4), lambda j:
      '{{"item":"' || j || '","item_type":"sku_id","pos_id":4,"pos_seq":' || j || '}}') AS displays,
    list_transform(range(k % 3), lambda j:
      '{{"action_id":"favor_add","item":"' || (k + j) || '","ts":' || ms || '}}') AS actions,
    CASE WHEN k % 5 = 0 THEN '"trace":"t-' || event_id || '"' END AS trace
  FROM events_k),
dirty AS (
  SELECT CASE WHEN k = 13
    THEN left('{{"common":' || common_head || CASE WHEN started THEN '1' ELSE '0' END || common_tail, 30)
    ELSE '{{' || CASE WHEN started THEN start_head || k || '}},'
        ELSE page_head || k || '}},"displays":[' || array_to_string(displays, ',')
          || '],"actions":[' || array_to_string(actions, ',') || '],' END
      || CASE WHEN failed THEN '"err":{{"error_code":' || (k + 1000) || ',"msg":"timeout"}},' ELSE '' END
      || '"ts":' || ms || coalesce(',' || trace, '') || '}}' END AS value
  FROM parts WHERE k IN (13, 27)),
good AS (SELECT * FROM parts WHERE k NOT IN (13, 27)),
first_day AS (
  SELECT mid, arg_min(CASE WHEN started THEN day ELSE day - INTERVAL 1 DAY END, event_id) AS d0
  FROM good GROUP BY mid),
flagged AS (
  SELECT good.*, CASE WHEN started AND CAST(d0 AS DATE) = day THEN '1' ELSE '0' END AS is_new
  FROM good JOIN first_day USING (mid)),
fixed AS (
  SELECT *, '"common":' || common_head || is_new || common_tail AS common,
    CASE WHEN started THEN NULL ELSE page_head || k || '}}' END AS page,
    CASE WHEN started THEN start_head || k || '}}' END AS start,
    '"err":{{"error_code":' || (k + 1000) || ',"msg":"timeout"}}' AS err
  FROM flagged)"""

SPLIT = """
SELECT 'error' AS output, '{' || concat_ws(',', common, page, start,
    CASE WHEN NOT started THEN '"displays":[' || array_to_string(displays, ',') || ']' END,
    CASE WHEN NOT started THEN '"actions":[' || array_to_string(actions, ',') || ']' END,
    err, '"ts":' || ms, trace) || '}' AS value FROM fixed WHERE failed
UNION ALL SELECT 'start', '{' || concat_ws(',', common, start, '"ts":' || ms, trace) || '}' FROM fixed WHERE started
UNION ALL SELECT 'page', '{' || concat_ws(',', common, page,
    CASE WHEN len(displays) = 0 THEN '"displays":[]' END,
    CASE WHEN len(actions) = 0 THEN '"actions":[]' END, '"ts":' || ms, trace) || '}' FROM fixed WHERE NOT started
UNION ALL SELECT 'display', '{' || concat_ws(',', common, page, '"display":' || item, '"ts":' || ms) || '}'
  FROM (SELECT *, unnest(displays) AS item FROM fixed WHERE NOT started)
UNION ALL SELECT 'action', '{' || concat_ws(',', common, page, '"action":' || item) || '}'
  FROM (SELECT *, unnest(actions) AS item FROM fixed WHERE NOT started)"""

SEARCHES = f"""
views AS (
  SELECT 'mid_' || conv_id AS mid, text AS item, CASE WHEN role = 'user' THEN 'search' ELSE 'home' END AS last_page_id,
    conv_id * 3000 + turn * 1000 AS ts
  FROM conversations)"""

WORDS = r"list_filter(string_split_regex(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"

# One change record per part of the routing table; each key belongs to several parts.
ROUTE_IMAGES = """
images AS (
  SELECT p_partkey, p_partkey % 4 AS op, p_brand || '_' || p_size AS base,
    CASE WHEN p_size % 5 = 0 THEN 'dwd' ELSE 'dim' END AS sink_type, lower(p_type) AS kind,
    p_size % 2 = 1 AS moves FROM part),
written AS (
  SELECT p_partkey, base || CASE WHEN op = 2 AND moves THEN '_b' ELSE '' END AS source_table,
    'dim_' || kind || CASE WHEN op = 2 AND moves THEN '_b' ELSE '' END AS sink_table, sink_type
  FROM images WHERE op <> 3)"""

KEYWORD_COUNTS = f"""
WITH {SEARCHES}, words AS (
  SELECT unnest({WORDS.format(text='item')}) AS keyword, ts // 10000 AS slot
  FROM views WHERE last_page_id = 'search')
SELECT {moment("make_timestamp(slot * 10000000)")} AS stt,
  {moment("make_timestamp((slot + 1) * 10000000)")} AS edt, keyword, count(*) AS keyword_count
FROM words GROUP BY slot, keyword"""

PAY_COLUMNS = """
SELECT id AS order_detail_id, order_id, order_id AS user_id, sku_id, sku_name, province_id,
  CAST(NULL AS VARCHAR) AS activity_id, CAST(NULL AS VARCHAR) AS activity_rule_id,
  CAST(NULL AS VARCHAR) AS coupon_id, payment_type AS payment_type_code,
  dic_name AS payment_type_name, callback_time, CAST(NULL AS VARCHAR) AS source_id,
  CAST(NULL AS VARCHAR) AS source_type_code, CAST(NULL AS VARCHAR) AS source_type_name,
  CAST(NULL AS VARCHAR) AS sku_num, CAST(NULL AS VARCHAR) AS split_original_amount,
  CAST(NULL AS VARCHAR) AS split_activity_amount, CAST(NULL AS VARCHAR) AS split_coupon_amount,
  split_total_amount AS split_payment_amount, CAST(s AS VARCHAR) AS ts
FROM paired WHERE place = 1"""


def pay_query(success: bool, lower: int) -> str:
    status = "AND payment_status = '1602'" if success else ""
    return f"""WITH {PAYMENTS}, {SEEN}, {DICTIONARY}, paired AS (
  SELECT seen.* EXCLUDE (s), payment_type, dic_name, callback_time, payments.s,
    row_number() OVER (PARTITION BY seen.id
      ORDER BY payments.s DESC, CAST(payments.id AS BIGINT) DESC) AS place
  FROM seen JOIN payments ON seen.order_id = payments.order_id {status}
    AND seen.s BETWEEN payments.s - {lower} AND payments.s + 5
  JOIN dictionary ON payment_type = dic_code)
{PAY_COLUMNS}"""


def emp_dept(seconds_apart: int, columns: str) -> str:
    return f"""
SELECT {columns} FROM
  (SELECT event_id AS empno, event_type AS ename, user_id AS deptno, epoch_us(ts) // 1000 AS ts
   FROM events WHERE event_type = 'purchase') e
JOIN (SELECT user_id AS dept_deptno, 'view-' || event_id AS dname, epoch_us(ts) // 1000 AS dept_ts
   FROM events WHERE event_type = 'view') d
ON deptno = dept_deptno AND abs(dept_ts - ts) <= {seconds_apart * 1000}"""


ORDER_DETAIL = f"""WITH {LINES}, {PLACED}, {DICTIONARY}
SELECT id, lines.order_id, sku_id, sku_name, order_price, sku_num, create_time, source_type, source_id,
  split_total_amount, split_activity_amount, split_coupon_amount, consignee, consignee_tel, total_amount,
  order_status, user_id, delivery_address, order_comment, out_trade_no, trade_body, process_status,
  tracking_no, parent_order_id, province_id, activity_reduce_amount, coupon_reduce_amount,
  original_total_amount, feight_fee, feight_fee_reduce, activity_id, activity_rule_id, coupon_id,
  coupon_use_id, left(create_time, 10) AS date_id, dic_name AS source_type_name, split_original_amount, ts
FROM lines JOIN placed USING (order_id) LEFT JOIN dictionary ON source_type = dic_code"""

ORDER_CANCEL = f"""WITH {LINES}, {CHANGED}
SELECT lines.id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
  left(operate_time, 10) AS date_id, operate_time AS cancel_time, sku_num, split_original_amount,
  split_activity_amount, split_coupon_amount, split_total_amount, changed.ts
FROM lines JOIN changed ON order_id = changed.id AND code = '1003'"""

LOG_IDENTITY = "SELECT tbl AS \"table\", kind AS type, CAST(ts AS VARCHAR) AS ts, id FROM dimensions"
# The last refund request of each article of an order.
REQUESTS = """
requests AS (SELECT order_id, sku_id, sku_num AS refund_num FROM lines WHERE l_returnflag = 'R'
  QUALIFY row_number() OVER (PARTITION BY order_id, sku_id
    ORDER BY CAST(ts AS BIGINT) DESC, CAST(sku_num AS INT) DESC) = 1)"""
CART_ROWS = f"""
cart AS (
  SELECT *, CASE WHEN l_linenumber = 1 THEN 'insert' ELSE 'update' END AS type, CAST(sku_num AS INT) AS now,
    CASE WHEN l_linenumber <> 1 THEN l_linenumber * 7 END AS before FROM lines)"""
CART_KEPT = "FROM cart WHERE type = 'insert' OR now > before"
CART_DELTA = "CASE WHEN type = 'insert' THEN sku_num ELSE CAST(now - before AS VARCHAR) END AS sku_num"

SQL: dict[str, str] = {
    # Sources
    "read_text_stream": f"""
SELECT '{{"database":"shop","table":"comment_info","type":"insert","ts":' || {seconds('o_orderdate')}
  || ',"data":{{"id":' || o_orderkey || ',"user_id":' || o_custkey || ',"sku_id":' || (o_orderkey % 100)
  || ',"appraise":"N' || (o_custkey % 30) || '","comment_txt":"' || o_orderpriority || '"}}}}' AS value
FROM orders WHERE o_orderpriority <> '5-LOW'""",
    "read_change_log": f"""WITH {CHANGED}
SELECT 'shop' AS "database", 'order_info' AS "table", 'update' AS type, ts, id, code AS now,
  '1001' AS before FROM changed""",
    "read_change_log_with_event_time":
        f"SELECT CAST(o_orderkey AS VARCHAR) AS id, {moment('o_orderdate')} AS row_time FROM orders",
    "read_page_view": f"""WITH {SEARCHES}
SELECT mid, item, last_page_id, ts, {moment('make_timestamp(ts * 1000)')} AS rt FROM views""",
    "read_fact_stream": f"""WITH {SEEN}
SELECT id, order_id, sku_id, province_id, split_total_amount, CAST(NULL AS VARCHAR) AS source_id,
  CAST(s AS VARCHAR) AS ts, {moment('make_timestamp(s * 1000000)')} AS row_time FROM seen""",
    "read_table_changes": """
SELECT CASE WHEN event_type <> 'signup' THEN CAST(user_id AS INT) END AS before_id,
  CASE WHEN event_type <> 'error' THEN CAST(user_id AS INT) END AS after_id,
  CASE WHEN event_type <> 'error' THEN event_type END AS after_name,
  CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op, event_id AS ts_ms
FROM events""",
    "snapshot_changelog_table": f"""
SELECT CAST(user_id AS INT) AS id, event_type AS name, {NUMBER} AS age FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND event_type <> 'error'""",
    "read_lookup_table": "SELECT CAST(s_suppkey AS VARCHAR) AS dic_code, s_name AS dic_name FROM supplier",
    "read_config_table": f"""WITH {ROUTE_IMAGES}
SELECT source_table, 'insert' AS source_type, sink_table, sink_type, 'id,name' AS sink_columns,
  CAST(p_partkey AS VARCHAR) AS sink_pk, CAST(NULL AS VARCHAR) AS sink_extend
FROM written WHERE sink_type = 'dim'""",
    "read_csv_lines": """
SELECT CAST(event_id AS INT) AS empno, event_type AS ename, CAST(user_id AS INT) AS deptno, epoch_us(ts) // 1000 AS ts
FROM events WHERE event_type = 'purchase'""",
    "read_olap_table": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",

    # Parsing, filters, projections
    "parse_json_with_dirty_split": f"""WITH {RECORDS}
SELECT 'main' AS output, mid, ms AS ts, CAST(NULL AS VARCHAR) AS value FROM good
UNION ALL SELECT 'dirty', NULL, NULL, value FROM dirty""",
    "filter_bootstrap_markers": f"""WITH {DIMENSIONS}
{LOG_IDENTITY} WHERE kind NOT IN ('bootstrap-start', 'bootstrap-complete')""",
    "filter_bootstrap_all": f"WITH {DIMENSIONS} {LOG_IDENTITY} WHERE kind NOT LIKE 'bootstrap%'",
    "map_field_project": f"""WITH {PLACED}
SELECT order_id AS id, consignee, total_amount, user_id, order_comment, province_id FROM placed""",
    "select_table_event": f"""WITH {CHANGED}
SELECT 'order_info' AS "table", 'update' AS type, ts, id FROM changed""",
    "status_transition_filter":
        f"WITH {CHANGED_ONCE} SELECT code, id, user_id, province_id, operate_time, ts FROM changed",
    "payment_success_filter": f"""WITH {PAYMENTS}
SELECT id, user_id, order_id, payment_type, callback_time, payment_status, CAST(s AS VARCHAR) AS ts
FROM payments WHERE payment_status = '1602'""",
    "payment_filter_any_status": f"""WITH {PAYMENTS}
SELECT id, user_id, order_id, payment_type, callback_time, payment_status, CAST(s AS VARCHAR) AS ts
FROM payments""",
    "cart_change_filter": f"""WITH {LINES}, {CART_ROWS}
SELECT type, id, sku_num, CAST(before AS VARCHAR) AS old_sku_num {CART_KEPT}""",
    "search_filter": f"""WITH {SEARCHES}
SELECT item, {moment('make_timestamp(ts * 1000)')} AS rt FROM views WHERE last_page_id = 'search'""",
    "column_prune_by_config":
        f"""WITH {DIMENSIONS} SELECT 'dim_' || tbl AS sink_table, pk AS row_key, dim AS payload FROM dimensions""",
    "remove_json_field": f"""WITH {RECORDS}
SELECT '{{' || concat_ws(',', '"common":' || common_head || CASE WHEN started THEN '1' ELSE '0' END || common_tail,
  page, start, '"ts":' || ms) || '}}' AS value FROM fixed""",

    # Scalar functions
    "cart_delta": f"WITH {LINES}, {CART_ROWS} SELECT id, {CART_DELTA} FROM cart",
    "decimal_mul_to_string": f"WITH {LINES} SELECT id, split_original_amount FROM lines",
    "date_format_day": f"WITH {LINES} SELECT id, left(create_time, 10) AS date_id FROM lines",
    "window_bounds_format": f"""WITH {SEARCHES}
SELECT {moment('make_timestamp(ts // 10000 * 10000000)')} AS stt,
  {moment('make_timestamp((ts // 10000 + 1) * 10000000)')} AS edt, ts FROM views""",
    "epoch_to_timestamp": f"""
SELECT event_id, {moment('ts')} AS from_seconds, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS from_ms FROM events""",
    "epoch_ms_to_date":
        f"SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, {moment('ts')} AS moment FROM events",
    "date_to_epoch_ms": """
SELECT o_orderkey, epoch_ms(date_trunc('day', o_orderdate)) - 28800000 AS day_ms,
  epoch_ms(date_trunc('second', o_orderdate)) - 28800000 AS moment_ms FROM orders""",
    "processing_stamps": "SELECT event_id, TRUE AS second_after, TRUE AS time_after FROM events",
    "json_to_string": """
SELECT '{"id":"' || o_orderkey || '","user_id":"' || o_custkey || '","sku_id":"' || (o_orderkey % 100)
  || '","appraise":"N' || (o_custkey % 30) || '","comment_txt":"' || o_orderpriority || '"}' AS value FROM orders""",
    "string_to_json": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "route_key":
        f"WITH {DIMENSIONS} SELECT id, tbl AS dim_key, tbl || '_' || kind AS fact_key FROM dimensions",

    # Joins
    "lookup_join": f"""WITH {DICTIONARY}
SELECT CAST(o_orderkey AS VARCHAR) AS id, dic_code AS appraise, dic_name AS appraise_name
FROM orders JOIN dictionary ON dic_code = 'N' || (o_custkey % 30)""",
    "double_lookup_join": f"""WITH {LINES}, {DICTIONARY}
SELECT id, t.dic_code AS refund_type, r.dic_code AS refund_reason_type, t.dic_name AS type_name,
  r.dic_name AS reason_name
FROM lines JOIN dictionary t ON t.dic_code = 'N' || (l_suppkey % 30)
JOIN dictionary r ON r.dic_code = 'R' || (l_partkey % 6) WHERE l_returnflag = 'R'""",
    "stream_inner_join": f"""WITH {LINES}, {PLACED}
SELECT id, order_id, sku_id, user_id, total_amount FROM lines JOIN placed USING (order_id)""",
    "multi_key_join": f"""WITH {LINES}, {REQUESTS}
SELECT order_id, sku_id, id, refund_num FROM lines JOIN requests USING (order_id, sku_id)
WHERE l_returnflag = 'R'""",
    "stream_left_join_retracting": f"""WITH {LINES}
SELECT id, sku_id, activity_id, activity_rule_id, coupon_id, coupon_use_id FROM lines""",
    "interval_join": f"""WITH {PAYMENTS}, {SEEN}
SELECT seen.id, seen.order_id, payments.id AS payment_id,
  {moment('make_timestamp(seen.s * 1000000)')} AS row_time,
  {moment('make_timestamp(payments.s * 1000000)')} AS pay_time
FROM seen JOIN payments ON seen.order_id = payments.order_id AND payment_status = '1602'
  AND seen.s BETWEEN payments.s - 900 AND payments.s + 5""",
    "interval_join_symmetric": emp_dept(
        3600, "CAST(empno AS INT) AS empno, CAST(deptno AS INT) AS deptno, dname, dept_ts - ts AS gap_ms"),
    "config_broadcast_join": f"""WITH {DIMENSIONS}
SELECT tbl AS "table", kind AS type, id, 'dim_' || tbl AS sink_table, CASE tbl
  WHEN 'base_region' THEN 'id,region_name' WHEN 'base_province' THEN 'id,name,region_id,area_code'
  WHEN 'user_info' THEN 'id,name,province_id' WHEN 'shop_info' THEN 'id,name'
  ELSE 'tm_id,tm_name' END AS sink_columns FROM dimensions""",

    # Aggregations, windows, state
    "keyword_tumbling_count": KEYWORD_COUNTS,
    "visitor_flag_repair": f"""WITH {RECORDS}
SELECT event_id AS arrival, mid, is_new, is_new AS common_is_new, ms AS ts FROM fixed""",
    # Before the repair a record's flag is as it was sent.
    "log_split": f"WITH {RECORDS} {SPLIT}".replace(
        "CASE WHEN started AND CAST(d0 AS DATE) = day", "CASE WHEN started"),
    "explode_displays": f"""WITH {RECORDS}
SELECT mid, page_id, CAST(j AS VARCHAR) AS item, CAST(j AS VARCHAR) AS pos_seq, ms AS ts FROM (
  SELECT 'mid_' || user_id AS mid, event_type AS page_id, ms, unnest(range(k % 4)) AS j FROM events_k
  WHERE event_type <> 'signup' AND k NOT IN (13, 27))""",
    "explode_actions": f"""WITH {RECORDS}
SELECT mid, page_id, 'favor_add' AS action_id, CAST(k + j AS VARCHAR) AS item,
  CAST(ms AS VARCHAR) AS action_ts FROM (
  SELECT 'mid_' || user_id AS mid, event_type AS page_id, ms, k, unnest(range(k % 3)) AS j FROM events_k
  WHERE event_type <> 'signup' AND k NOT IN (13, 27))""",
    "apply_config_changes": f"""WITH {ROUTE_IMAGES}, writes AS (
  SELECT p_partkey, source_table, sink_table, FALSE AS removed FROM written WHERE sink_type = 'dim'
  UNION ALL SELECT p_partkey, base, NULL, TRUE FROM images
  WHERE sink_type = 'dim' AND (op = 3 OR (op = 2 AND moves)))
SELECT source_table, 'insert' AS source_type, sink_table, 'dim' AS sink_type, 'id,name' AS sink_columns,
  CAST(p_partkey AS VARCHAR) AS sink_pk, CAST(NULL AS VARCHAR) AS sink_extend FROM writes
QUALIFY row_number() OVER (PARTITION BY source_table ORDER BY p_partkey DESC) = 1 AND NOT removed""",
    "dim_route": f"""WITH {DIMENSIONS}
SELECT 'dim_' || tbl AS sink_table, pk AS row_key, kind AS operation, dim AS payload, CAST(ts AS BIGINT) AS ts
FROM dimensions WHERE kind NOT IN ('bootstrap-start', 'bootstrap-complete')""",
    "fact_route": f"WITH {DIMENSIONS} {FACT_ROWS}",

    # Fact and dimension jobs
    "dwd_traffic_log": f"WITH {RECORDS} {SPLIT} UNION ALL SELECT 'dirty', value FROM dirty",
    "dwd_comment_info": f"""WITH {DICTIONARY}
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
  CAST(o_orderkey % 100 AS VARCHAR) AS sku_id, dic_code AS appraise, dic_name AS appraise_name,
  o_orderpriority AS comment_txt, CAST({seconds('o_orderdate')} AS VARCHAR) AS ts
FROM orders JOIN dictionary ON dic_code = 'N' || (o_custkey % 30)""",
    "dwd_cart_add": f"""WITH {LINES}, {CART_ROWS}
SELECT id, CAST(l_suppkey AS VARCHAR) AS user_id, sku_id, order_price AS cart_price, {CART_DELTA}, sku_name,
  '0' AS is_checked, create_time, CAST(NULL AS VARCHAR) AS operate_time, l_returnflag AS source_type, source_id
{CART_KEPT}""",
    "dwd_order_detail": ORDER_DETAIL,
    "dwd_order_cancel": ORDER_CANCEL,
    "landed_log": ORDER_CANCEL,
    "dwd_pay_success": pay_query(True, 900),
    "dwd_pay_any_status_day": pay_query(False, 86400),
    "dwd_order_refund": f"""WITH {LINES}, {CHANGED}, {DICTIONARY}
SELECT lines.id, CAST(l_suppkey AS VARCHAR) AS user_id, order_id, sku_id, province_id,
  left(create_time, 10) AS date_id, create_time, t.dic_code AS refund_type_code,
  t.dic_name AS refund_type_name, r.dic_code AS refund_reason_type_code,
  r.dic_name AS refund_reason_type_name, l_linestatus AS refund_reason_txt, sku_num AS refund_num,
  order_price AS refund_amount, lines.ts
FROM lines JOIN changed ON order_id = changed.id AND code = '1005'
JOIN dictionary t ON t.dic_code = 'N' || (l_suppkey % 30)
JOIN dictionary r ON r.dic_code = 'R' || (l_partkey % 6) WHERE l_returnflag = 'R'""",
    "dwd_refund_pay_success": f"""WITH {LINES}, {CHANGED}, {DICTIONARY}, {REQUESTS}
SELECT lines.id, user_id, lines.order_id, lines.sku_id, province_id, dic_code AS payment_type_code,
  dic_name AS payment_type_name, left(create_time, 10) AS date_id, create_time AS callback_time,
  refund_num, order_price AS refund_amount, lines.ts
FROM lines JOIN changed ON lines.order_id = changed.id AND code = '1006'
JOIN requests ON lines.order_id = requests.order_id AND lines.sku_id = requests.sku_id
JOIN dictionary ON dic_code = 'N' || (l_partkey % 30) WHERE l_returnflag = 'R'""",
    "dwd_simple_facts": f"""WITH {DIMENSIONS}, rows AS ({FACT_ROWS})
SELECT sink_table, left(payload, len(payload) - 1) || ',"ts":' || ts || '}}' AS value FROM rows""",
    "dim_tables": f"""WITH {DIMENSIONS}
SELECT 'dim_' || tbl AS sink_table, pk AS row_key, dim AS payload FROM dimensions
WHERE kind NOT IN ('bootstrap-start', 'bootstrap-complete')
QUALIFY row_number() OVER (PARTITION BY tbl, pk ORDER BY ts DESC, place DESC) = 1""",
    "dws_keyword_window": KEYWORD_COUNTS,
    "emp_dept_interval": emp_dept(1800, """CAST(empno AS INT) AS empno, ename, CAST(deptno AS INT) AS deptno, ts,
  CAST(dept_deptno AS INT) AS dept_deptno, dname, dept_ts"""),

    # Keyed tables and words
    "upsert_by_key": f"""
SELECT user_id, event_id, event_type, {money('value')} AS value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    "keyword_split": f"""
SELECT conv_id, turn, unnest({WORDS.format(text='text')}) AS word FROM conversations""",
    "keyword_finest": f"""
SELECT conv_id, turn, unnest({WORDS.format(text='text')}) AS word FROM conversations WHERE role = 'user'""",
    "keyword_dictionary_match": f"""
WITH vocabulary AS (SELECT DISTINCT word FROM (
  SELECT unnest({WORDS.format(text='text')}) AS word FROM conversations WHERE role <> 'user')),
windows AS (SELECT conv_id, turn, lower(text) AS t, unnest(range(1, len(text) + 1)) AS position
  FROM conversations WHERE role = 'user'),
candidates AS (SELECT conv_id, turn, position, unnest(range(1, least((SELECT max(len(word)) FROM vocabulary), len(t) - position + 1) + 1)) AS size, t
  FROM windows)
SELECT conv_id, turn, CAST(position AS INT) AS position, word
FROM candidates JOIN vocabulary ON substr(t, position, size) = word""",
}

SQL |= {
    # Sinks give back what was written
    "write_topic": SQL["read_text_stream"].replace("WHERE o_orderpriority <> '5-LOW'", ""),
    "write_by_destination": SQL["dwd_simple_facts"],
    "write_append_table": SQL["dwd_cart_add"],
    "create_dim_if_absent": """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS province_id
FROM customer""",
    "upsert_dim": SQL["dim_tables"],
    "write_olap_json": KEYWORD_COUNTS,

    # Streams give what the batch gives
    "stream_read_text": SQL["read_text_stream"].replace("WHERE o_orderpriority <> '5-LOW'", ""),
    "stream_order_detail": ORDER_DETAIL,
    "stream_order_cancel": ORDER_CANCEL,
    "state_ttl": f"WITH {LINES} SELECT id, activity_id, coupon_id FROM lines",
    "watermark_bounded": KEYWORD_COUNTS,
    "watermark_monotonous": SQL["emp_dept_interval"],
    "stream_traffic_log": SQL["dwd_traffic_log"],
    "stream_pay_success": SQL["dwd_pay_success"],
    "stream_refund": SQL["dwd_order_refund"],
    "stream_refund_pay": SQL["dwd_refund_pay_success"],
    "stream_comment_info": SQL["dwd_comment_info"],
    "stream_changes": SQL["snapshot_changelog_table"],
    "stream_dims": SQL["dim_tables"],
    "stream_dims_as_of": f"""{AS_OF}
SELECT sink_table, row_key, payload FROM routed
QUALIFY row_number() OVER (PARTITION BY sink_table, row_key ORDER BY ts DESC, place DESC) = 1""",
    "stream_dim_catalog": f"""{AS_OF},
kept AS (SELECT sink_table, row_key, payload FROM routed
  QUALIFY row_number() OVER (PARTITION BY sink_table, row_key ORDER BY ts DESC, place DESC) = 1),
named(sink_table, columns, last) AS (VALUES
  ('dim_base_region', 'id,region_name', 'region_name'), ('dim_base_province', 'id,name,region_id,area_code', 'area_code'),
  ('dim_user_info', 'id,name,province_id', 'province_id'), ('dim_shop_info', 'id,name', 'name'),
  ('dim_base_brand', 'tm_id,tm_name', 'tm_name'), ('dim_user_new', 'id,name,province_id,segment', 'segment'))
SELECT sink_table, columns, count(row_key) AS n_rows,
  count(*) FILTER (WHERE row_key IS NOT NULL AND contains(payload, '"' || last || '"')) AS n_last
FROM named LEFT JOIN kept USING (sink_table) GROUP BY sink_table, columns, last""",
    "stream_routes": SQL["apply_config_changes"],
}
