"""Reference SQL for every driver query, in the DuckDB dialect, over the
``events`` view.  Written independently of the Spark plans (row-level
window expansion, window functions, NOT EXISTS), so agreement is a real
check.  Column names and types follow the Spark results."""

from __future__ import annotations

_US = "epoch_us(ts)"
_S = f"({_US} // 1000000)"
_MS = f"({_US} // 1000)"


def _sliding(filter_sql: str, slide_ms: int, k: int) -> str:
    return f"""
      SELECT user_id, ({_MS} // {slide_ms}) * {slide_ms} + {slide_ms} * j AS window_end,
             count(*) AS count
      FROM events CROSS JOIN generate_series(1, {k}) AS g(j)
      {filter_sql}
      GROUP BY ALL"""


def _topn(counts_sql: str, n: int) -> str:
    return f"""
      SELECT window_end, rank, user_id, count FROM (
        SELECT window_end, user_id, count,
               row_number() OVER (PARTITION BY window_end ORDER BY count DESC, user_id)::BIGINT
                 AS rank
        FROM ({counts_sql})) WHERE rank <= {n}"""


def _ts_text(ms: str) -> str:
    return (f"strftime(make_timestamp(({ms})::BIGINT * 1000), '%Y-%m-%d %H:%M:%S') || '.' || "
            f"CASE WHEN ({ms}) % 1000 = 0 THEN '0' ELSE "
            f"rtrim(lpad((({ms}) % 1000)::VARCHAR, 3, '0'), '0') END")


def _report(topn_sql: str, line: str, trailer: str) -> str:
    return f"""
      SELECT window_end,
             '时间: ' || {_ts_text('window_end')} || chr(10) ||
             string_agg({line}, '' ORDER BY rank) || '{trailer}' AS report
      FROM ({topn_sql}) GROUP BY window_end"""


_ITEM_LINE = "'no' || rank || ': 商品ID=' || user_id || '浏览量=' || count || chr(10)"
_URL_LINE = "'NO' || rank || ': URL=' || user_id || ' count=' || count || chr(10)"

_HOT_ITEMS_COUNTS = _sliding("WHERE event_type = 'view'", 300_000, 12)
_HOT_URLS_COUNTS = _sliding("", 5_000, 120)

_HOUR_END = f"({_MS} // 3600000) * 3600000 + 3600000"
_HASH = ("list_reduce(list_prepend(0::BIGINT, list_transform(string_split(user_id::VARCHAR, ''), "
         "lambda c: unicode(c)::BIGINT)), lambda a, c: (a * 61 + c) & 536870911)")

_ORDER_OUTCOMES = f"""
  SELECT user_id AS order_id, event_id AS create_event_id, t AS create_time,
         CASE WHEN nx.t - t < 86400000000 THEN nx.id END AS pay_event_id,
         CASE WHEN nx.t - t < 86400000000 THEN nx.t END AS pay_time,
         CASE WHEN nx.t - t < 86400000000 THEN 'payed successfully' ELSE 'timeout' END
           AS result_msg
  FROM (
    SELECT user_id, event_id, event_type, {_US} AS t,
           first_value(CASE WHEN event_type = 'purchase'
                            THEN struct_pack(t := {_US}, id := event_id) END IGNORE NULLS)
             OVER (PARTITION BY user_id ORDER BY ts, event_id
                   ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx
    FROM events)
  WHERE event_type = 'signup'"""

_PAYS = f"(SELECT event_id, user_id, {_US} AS t FROM events WHERE event_type = 'click')"
_RECEIPTS = f"(SELECT event_id, user_id, {_US} AS t FROM events WHERE event_type = 'purchase')"
_BAND = "r.user_id = p.user_id AND r.t BETWEEN p.t - 3600000000 AND p.t + 3600000000"
_TX_JOIN = f"""
  SELECT p.user_id, p.event_id AS pay_event_id, p.t AS pay_ts_us,
         r.event_id AS receipt_event_id, r.t AS receipt_ts_us
  FROM {_PAYS} p JOIN {_RECEIPTS} r ON {_BAND}"""
_TX_RECONCILE = f"""
  SELECT *, 'matched' AS status FROM ({_TX_JOIN})
  UNION ALL
  SELECT p.user_id, p.event_id, p.t, NULL::BIGINT, NULL::BIGINT, 'unmatched_pay'
  FROM {_PAYS} p WHERE NOT EXISTS (SELECT 1 FROM {_RECEIPTS} r WHERE {_BAND})
  UNION ALL
  SELECT r.user_id, NULL::BIGINT, NULL::BIGINT, r.event_id, r.t, 'unmatched_receipt'
  FROM {_RECEIPTS} r WHERE NOT EXISTS (SELECT 1 FROM {_PAYS} p WHERE {_BAND})"""

# two pointers a key: the rows under them match, else the earlier one stays alone
_ONE_TO_ONE = f"""
  WITH RECURSIVE p AS (SELECT user_id, list(event_id ORDER BY t, event_id) AS pid, list(t ORDER BY t, event_id) AS pt
                       FROM {_PAYS} p GROUP BY user_id),
  r AS (SELECT user_id, list(event_id ORDER BY t, event_id) AS rid, list(t ORDER BY t, event_id) AS rt
        FROM {_RECEIPTS} r GROUP BY user_id),
  k AS (SELECT user_id, coalesce(pid, []) AS pid, coalesce(pt, []) AS pt, coalesce(rid, []) AS rid, coalesce(rt, []) AS rt
        FROM p FULL JOIN r USING (user_id)),
  w AS (
    SELECT user_id, 0::BIGINT AS i, 0::BIGINT AS j, 0::BIGINT AS di, 0::BIGINT AS dj FROM k
    UNION ALL
    SELECT user_id, i + CASE WHEN i < len(pt) AND (j >= len(rt) OR pt[i + 1] <= rt[j + 1] + 3600000000) THEN 1 ELSE 0 END,
           j + CASE WHEN j < len(rt) AND (i >= len(pt) OR rt[j + 1] <= pt[i + 1] + 3600000000) THEN 1 ELSE 0 END, i, j
    FROM w JOIN k USING (user_id) WHERE i < len(pt) OR j < len(rt)),
  o AS (SELECT user_id, CASE WHEN i > di THEN pid[i] END AS pay_event_id, CASE WHEN i > di THEN pt[i] END AS pay_ts_us,
               CASE WHEN j > dj THEN rid[j] END AS receipt_event_id, CASE WHEN j > dj THEN rt[j] END AS receipt_ts_us
        FROM w JOIN k USING (user_id) WHERE i + j > 0)
  SELECT *, CASE WHEN receipt_event_id IS NULL THEN 'unmatched_pay' WHEN pay_event_id IS NULL THEN 'unmatched_receipt'
            ELSE 'matched' END AS status FROM o"""

_TX_IDS = "CASE WHEN event_type = 'purchase' THEN 'tx' || event_id ELSE '' END"

ORACLE_SQL = {
    "hot_items_counts": _HOT_ITEMS_COUNTS,
    "hot_items_topn": _topn(_HOT_ITEMS_COUNTS, 3),
    "hot_items_report": _report(_topn(_HOT_ITEMS_COUNTS, 3), _ITEM_LINE, ""),
    "hot_urls_counts": _HOT_URLS_COUNTS,
    "hot_urls_topn": _topn(_HOT_URLS_COUNTS, 5),
    "hot_urls_report": _report(_topn(_HOT_URLS_COUNTS, 5), _URL_LINE, "+" * 36),
    "page_views": f"""
      SELECT 'pv' AS key, {_HOUR_END} AS window_end, count(*) AS count
      FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "unique_visitors": f"""
      SELECT {_HOUR_END} AS window_end, count(DISTINCT user_id) AS uv_count
      FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "unique_visitors_bitmap": f"""
      SELECT {_HOUR_END} AS window_end, count(DISTINCT {_HASH}) AS uv_count
      FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "running_unique_visitors": f"""
      SELECT window_end, event_id,
             sum(is_new) OVER (PARTITION BY window_end ORDER BY t, event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT
               AS uv_count
      FROM (SELECT window_end, event_id, t,
                   (row_number() OVER (PARTITION BY window_end, h ORDER BY t, event_id) = 1)
                     ::BIGINT AS is_new
            FROM (SELECT {_HOUR_END} AS window_end, event_id, {_US} AS t, {_HASH} AS h
                  FROM events WHERE event_type = 'view'))""",
    "truncated_average": f"""
      SELECT user_id, (sum({_S}) // count(*))::DOUBLE AS avg_ts_s
      FROM events GROUP BY user_id""",
    "login_fail_pairs": f"""
      SELECT user_id, t AS first_fail_time, nt AS last_fail_time,
             user_id::VARCHAR || '连续登陆失败两次' AS warn_message
      FROM (SELECT user_id, event_type, {_US} AS t,
                   lead(event_type) OVER w AS ntype, lead({_US}) OVER w AS nt
            FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
      WHERE event_type = 'error' AND ntype = 'error' AND nt - t < 3600000000""",
    "order_results": _ORDER_OUTCOMES,
    "order_paid": f"SELECT * FROM ({_ORDER_OUTCOMES}) WHERE result_msg = 'payed successfully'",
    "order_timeout": f"SELECT * FROM ({_ORDER_OUTCOMES}) WHERE result_msg = 'timeout'",
    "tx_interval_join": _TX_JOIN,
    "tx_reconcile": _TX_RECONCILE,
    "tx_match_one_to_one": _ONE_TO_ONE,
    "tx_matched": f"SELECT * FROM ({_TX_RECONCILE}) WHERE status = 'matched'",
    "tx_unmatched_pays": f"SELECT * FROM ({_TX_RECONCILE}) WHERE status = 'unmatched_pay'",
    "tx_unmatched_receipts":
        f"SELECT * FROM ({_TX_RECONCILE}) WHERE status = 'unmatched_receipt'",
    "filter_views": f"""
      SELECT event_id, user_id, event_type, value, {_US} AS ts_us
      FROM events WHERE event_type = 'view'""",
    "filter_nonempty_key": f"""
      SELECT event_id, tx_id FROM (SELECT event_id, {_TX_IDS} AS tx_id FROM events)
      WHERE tx_id IS NOT NULL AND tx_id <> ''""",
    "event_time_seconds": f"""
      SELECT event_id, {_S} AS ts_s, {_S} * 1000 AS event_time_ms FROM events""",
    "event_time_millis": f"""
      SELECT event_id, {_MS} AS ts_ms, {_MS} * 1000 AS event_time_us FROM events""",
    "scan_behavior_log": f"""
      SELECT user_id, event_id AS item_id, length(props)::BIGINT AS category_id,
             event_type AS behavior, {_S} AS ts_s FROM events""",
    "scan_access_log": f"""
      SELECT '192.168.0.' || user_id AS ip, 'u' || user_id AS user_id,
             {_S} * 1000 AS event_ms, upper(event_type) AS method,
             '/' || event_type || '/' || event_id AS url FROM events""",
    "scan_login_log": f"""
      SELECT user_id, '10.0.0.' || user_id AS ip,
             CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type,
             {_S} AS ts_s FROM events""",
    "scan_order_log": f"""
      SELECT user_id AS order_id,
             CASE WHEN event_type = 'purchase' THEN 'pay' ELSE 'create' END AS event_type,
             {_TX_IDS} AS tx_id, {_S} AS ts_s FROM events""",
    "scan_receipt_log": f"""
      SELECT 'tx' || event_id AS tx_id,
             CASE WHEN value < 25 THEN 'wechat' ELSE 'alipay' END AS pay_channel,
             {_S} AS ts_s FROM events""",
    "window_aggregate_sliding": """
        WITH w AS (SELECT event_type, event_id, unnest(generate_series(
                epoch_us(ts::timestamp) // 900000000 * 900000 + 900000,
                epoch_us(ts::timestamp) // 900000000 * 900000 + 3600000, 900000)) AS window_end FROM events)
        SELECT event_type, window_end, count(*) AS n, min(event_id) AS first_event_id, max(event_id) AS last_event_id
        FROM w GROUP BY ALL""",
    "window_aggregate_gaps": """
        WITH w AS (SELECT event_type, event_id, epoch_us(ts::timestamp) AS t,
                          epoch_us(ts::timestamp) // 1800000000 * 1800000000 AS s FROM events)
        SELECT event_type, s // 1000 + 600000 AS window_end, count(*) AS n, min(event_id) AS first_event_id,
               max(event_id) AS last_event_id FROM w WHERE t < s + 600000000 GROUP BY ALL""",
    "window_aggregate_dense": """
        WITH w AS (SELECT event_type, event_id, value, unnest(generate_series(
                epoch_us(ts::timestamp) // 5000000 * 5000 + 5000,
                epoch_us(ts::timestamp) // 5000000 * 5000 + 600000, 5000)) AS window_end FROM events)
        SELECT event_type, window_end, count(*) AS n, sum(event_id)::BIGINT AS id_sum, min(value) AS least,
               max(value) AS most, sum(event_id)::DOUBLE / count(*) AS id_mean
        FROM w GROUP BY ALL""",
}
