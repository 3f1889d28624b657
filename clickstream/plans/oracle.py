"""DuckDB SQL for every catalogue query, written independently of the Spark plans.

Sliding windows are expanded per event with ``generate_series`` of window ends,
the direct reading of the window definition (no sweep, no chunks).
"""

VIEWS_K = """SELECT event_id, ts, user_id, event_type, value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, epoch_us(ts) AS us
FROM events"""


def _sliding(source: str, keys: str, size_us: int, slide_us: int) -> str:
    n = size_us // slide_us
    sel = f"{keys}, " if keys else ""
    return f"""SELECT {sel}make_timestamp(e * {slide_us}) AS window_end, count(*)::BIGINT AS cnt
FROM (SELECT {sel}unnest(generate_series(us // {slide_us} + 1, us // {slide_us} + {n})) AS e FROM ({source}))
GROUP BY ALL"""


HOT_ITEM_COUNTS = _sliding(f"SELECT k AS item_id, us FROM ({VIEWS_K}) WHERE event_type = 'view'",
                           "item_id", 3_600_000_000, 300_000_000)

HASH28 = ("list_reduce(list_prepend(0::BIGINT, list_transform(string_split(CAST(user_id AS VARCHAR), ''), "
          "lambda c: ascii(c)::BIGINT)), lambda a, x: (a * 61 + x) & 268435455)")

VIEWS = f"SELECT * FROM ({VIEWS_K}) WHERE event_type = 'view'"

HOUR = 3_600_000_000


def _topn(counts: str, key: str, n: int) -> str:
    return f"""SELECT window_end, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {key})::BIGINT AS "rank", {key}, cnt
FROM ({counts}) QUALIFY "rank" <= {n}"""


CHANNEL_OF_K = "['store', 'search', 'social', 'mail', 'partner', 'direct'][k % 6 + 1]"

AD_KEPT = f"""SELECT * FROM (SELECT event_id, ts, user_id, k AS ad_id, us, CAST(ts AS DATE) AS day,
       row_number() OVER (PARTITION BY user_id, k, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
FROM ({VIEWS_K}))"""

ACCESS_LINES = """SELECT concat_ws(' ',
    '10.' || ((user_id // 65536) % 256) || '.' || ((user_id // 256) % 256) || '.' || (user_id % 256),
    '-', CASE WHEN event_type = 'error' THEN '-' ELSE CAST(user_id AS VARCHAR) END,
    strftime(ts, '%d/%m/%Y:%H:%M:%S'), '+0000',
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END,
    '/item/' || CAST(json_extract_string(props, '$.k') AS INTEGER)) AS line
FROM events"""

E = f"SELECT event_id, ts, us, user_id, event_type, value, k FROM ({VIEWS_K})"


def _greedy(cands: str, key: str, cols: str) -> str:
    """Skip-past-last-event selection by following successor pointers.

    ``cands`` has ``key, s_us, s_id, e_us, e_id`` plus output columns.  Candidates
    are numbered by (end, start); the first is taken, then repeatedly the first
    whose start lies after the taken end.
    """
    pos = lambda u, i: f"({u} - 1704067200000000) * 1000000 + {i}"  # noqa: E731  time and id in one number (ids below a million)
    return f"""WITH RECURSIVE c AS (
  SELECT *, {pos('s_us', 's_id')} AS s_pos, {pos('e_us', 'e_id')} AS e_pos,
         row_number() OVER (PARTITION BY {key} ORDER BY e_us, e_id, s_us, s_id) AS ci FROM ({cands})),
later AS MATERIALIZED (SELECT {key}, s_pos, min(ci) OVER (PARTITION BY {key} ORDER BY s_pos DESC) AS nci FROM c),
nx AS MATERIALIZED (SELECT a.{key}, a.ci, b.nci FROM c a ASOF JOIN later b ON a.{key} = b.{key} AND a.e_pos < b.s_pos),
ch AS (
  SELECT {key}, 1::BIGINT AS ci FROM c GROUP BY {key}
  UNION ALL
  SELECT nx.{key}, nx.nci FROM ch JOIN nx ON nx.{key} = ch.{key} AND nx.ci = ch.ci)
SELECT {cols} FROM ch JOIN c USING ({key}, ci)"""


def _leads(n: int) -> str:
    return f"""SELECT *, lead(us, {n}) OVER w AS e_us, lead(event_id, {n}) OVER w AS e_id, lead(ts, {n}) OVER w AS e_ts
FROM ({E}) WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)"""


def _pair_fails(span_us: int) -> str:
    return f"""SELECT user_id, ts AS first_ts, nts AS last_ts FROM (
  SELECT *, lead(event_type) OVER w AS nt, lead(ts) OVER w AS nts, lead(us) OVER w AS nus
  FROM ({E}) WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
WHERE event_type = 'error' AND nt = 'error' AND nus - us < {span_us}"""


DAY = 86_400_000_000

BURST_CANDS = f"""SELECT user_id, us AS s_us, event_id AS s_id, ts AS first_ts,
       last_value(us) OVER r AS e_us, last_value(event_id) OVER r AS e_id, last_value(ts) OVER r AS last_ts,
       count(*) OVER r AS times
FROM (SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)
                  OVER (PARTITION BY user_id ORDER BY us, event_id) AS run
      FROM ({E}))
WHERE event_type = 'error'
WINDOW r AS (PARTITION BY user_id, run ORDER BY us RANGE BETWEEN CURRENT ROW AND {24 * HOUR} FOLLOWING)"""

SIG = f"SELECT k, user_id, us, ts, event_id FROM ({E}) WHERE event_type <> 'error'"


def _multi(sig: str, within: int) -> str:
    return f"""SELECT s.k, s.user_id AS start_user, s.us AS s_us, s.event_id AS s_id, s.ts AS first_ts,
       e.us AS e_us, e.event_id AS e_id, e.ts AS last_ts
FROM ({sig}) s JOIN ({sig}) e ON e.k = s.k
  AND (e.us > s.us OR (e.us = s.us AND e.event_id > s.event_id))
  AND e.us - s.us < {within} AND e.user_id <> s.user_id
QUALIFY row_number() OVER (PARTITION BY s.k, s.us, s.event_id ORDER BY e.us, e.event_id) = 4"""


# first event after x (same k) by another user = first event of the next same-user run
def _chain(sig: str, within: int) -> str:
    step = f"""WITH r AS (
  SELECT *, sum(CASE WHEN user_id IS DISTINCT FROM pu THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY us, event_id) AS run
  FROM (SELECT *, lag(user_id) OVER (PARTITION BY k ORDER BY us, event_id) AS pu FROM ({sig}))),
heads AS (SELECT k, run, us, event_id, ts, user_id FROM r QUALIFY row_number() OVER (PARTITION BY k, run ORDER BY us, event_id) = 1)
SELECT r.k, r.event_id AS id, r.us, r.ts, r.user_id, h.event_id AS nid FROM r LEFT JOIN heads h ON h.k = r.k AND h.run = r.run + 1"""

    return f"""WITH st AS ({step})
SELECT a.k, a.user_id AS start_user, a.us AS s_us, a.id AS s_id, a.ts AS first_ts,
       e.us AS e_us, e.id AS e_id, e.ts AS last_ts
FROM st a JOIN st b ON b.k = a.k AND b.id = a.nid JOIN st c ON c.k = a.k AND c.id = b.nid
  JOIN st d ON d.k = a.k AND d.id = c.nid JOIN st e ON e.k = a.k AND e.id = d.nid
WHERE e.us - a.us < {within}"""

ALL_SIG = f"SELECT * REPLACE (0 AS k) FROM ({SIG})"

CUMULATIVE = f"""SELECT *, lead(us) OVER w AS e_us, lead(event_id) OVER w AS e_id, lead(ts) OVER w AS e_ts,
       sum(value) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {2 * DAY - 1} PRECEDING AND CURRENT ROW) AS points
FROM ({E}) WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)"""

# one-slot match: an automaton over a user's views and clicks in order
ONE_SLOT = f"""WITH RECURSIVE ev AS (
  SELECT user_id, us, event_id, event_type = 'view' AS pay,
         row_number() OVER (PARTITION BY user_id ORDER BY us, event_type = 'view' DESC, event_id) AS i
  FROM ({E}) WHERE event_type IN ('view', 'click')),
st AS (
  SELECT user_id, 0::BIGINT AS i, NULL::BIGINT AS lu, NULL::BIGINT AS li, NULL::BIGINT AS ru, NULL::BIGINT AS ri,
         NULL::BIGINT AS ml, NULL::BIGINT AS mr FROM ev GROUP BY user_id
  UNION ALL
  SELECT user_id, i,
         CASE WHEN pay AND ri IS NULL THEN us WHEN NOT pay AND li IS NOT NULL THEN NULL ELSE lu END,
         CASE WHEN pay AND ri IS NULL THEN event_id WHEN NOT pay AND li IS NOT NULL THEN NULL ELSE li END,
         CASE WHEN NOT pay AND li IS NULL THEN us WHEN pay AND ri IS NOT NULL THEN NULL ELSE ru END,
         CASE WHEN NOT pay AND li IS NULL THEN event_id WHEN pay AND ri IS NOT NULL THEN NULL ELSE ri END,
         CASE WHEN pay AND ri IS NOT NULL THEN event_id WHEN NOT pay AND li IS NOT NULL THEN li END,
         CASE WHEN pay AND ri IS NOT NULL THEN ri WHEN NOT pay AND li IS NOT NULL THEN event_id END
  FROM (SELECT ev.user_id, ev.i, ev.us, ev.event_id, ev.pay,
               CASE WHEN ev.us - st.lu <= {5 * HOUR} THEN st.lu END AS lu, CASE WHEN ev.us - st.lu <= {5 * HOUR} THEN st.li END AS li,
               CASE WHEN ev.us - st.ru <= {3 * HOUR} THEN st.ru END AS ru, CASE WHEN ev.us - st.ru <= {3 * HOUR} THEN st.ri END AS ri
        FROM st JOIN ev ON ev.user_id = st.user_id AND ev.i = st.i + 1)),
m AS (SELECT user_id, ml, mr FROM st WHERE ml IS NOT NULL)
SELECT user_id, 'matched' AS status, ml AS pay_id, mr AS receipt_id FROM m
UNION ALL SELECT user_id, 'unmatched_pay', event_id, NULL FROM ev WHERE pay AND event_id NOT IN (SELECT ml FROM m)
UNION ALL SELECT user_id, 'unmatched_receipt', NULL, event_id FROM ev WHERE NOT pay AND event_id NOT IN (SELECT mr FROM m)"""

PAY_VIEWS = f"SELECT user_id, event_id AS pay_id, ts AS pay_ts, us FROM ({E}) WHERE event_type = 'view'"
PAY_CLICKS = f"SELECT user_id, event_id AS receipt_id, ts AS receipt_ts, us FROM ({E}) WHERE event_type = 'click'"


def _paid(more: str = "") -> str:
    return f"""SELECT c.user_id, c.event_id, 'success' AS status, make_timestamp(min(p.us)) AS pay_ts
FROM ({E}) c JOIN ({E}) p ON p.event_type = 'purchase' AND p.user_id = c.user_id AND p.us >= c.us AND p.us < c.us + {DAY} {more}
WHERE c.event_type = 'signup' GROUP BY c.user_id, c.event_id"""


def _payment(exists: bool) -> str:
    neg = "" if exists else "NOT "
    status = "success" if exists else "timeout"
    return f"""SELECT c.user_id, c.event_id, '{status}' AS status FROM ({E}) c
WHERE c.event_type = 'signup' AND {neg}EXISTS (
  SELECT 1 FROM ({E}) p WHERE p.event_type = 'purchase' AND p.user_id = c.user_id
    AND p.us >= c.us AND p.us < c.us + {DAY})"""


ORACLE_SQL = {
    "hot_item_counts": HOT_ITEM_COUNTS,
    "hot_items_topn": f"""SELECT window_end, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id)::BIGINT AS "rank",
       item_id, cnt
FROM ({HOT_ITEM_COUNTS}) QUALIFY "rank" <= 3""",
    "behaviour_counts_1h_10s": _sliding(f"SELECT event_type, us FROM ({VIEWS_K})", "event_type", HOUR, 10_000_000),
    "hot_urls_topn": _topn(_sliding(f"SELECT '/item/' || k AS url, us FROM ({VIEWS_K})", "url",
                                           600_000_000, 5_000_000), "url", 5),
    "hot_sale_topn": _topn(_sliding(f"SELECT k AS book, us FROM ({VIEWS_K}) WHERE event_type = 'purchase'",
                                           "book", 600_000_000, 5_000_000), "book", 3),
    "access_log_parse": f"""SELECT f[1] AS ip, TRY_CAST(NULLIF(f[3], '-') AS BIGINT) AS user_id,
       strptime(f[4], '%d/%m/%Y:%H:%M:%S') AS ts, f[6] AS method, f[7] AS url
FROM (SELECT string_split(line, ' ') AS f FROM ({ACCESS_LINES}))""",
    "page_views_hourly": f"""SELECT make_timestamp((us // {HOUR} + 1) * {HOUR}) AS window_end, count(*)::BIGINT AS pv
FROM ({VIEWS}) GROUP BY ALL""",
    "unique_visitors_hourly": f"""SELECT make_timestamp((us // {HOUR} + 1) * {HOUR}) AS window_end,
       count(DISTINCT user_id)::BIGINT AS uv
FROM ({VIEWS}) GROUP BY ALL""",
    "unique_visitors_1h_10s": f"""SELECT make_timestamp(e * 10000000) AS window_end, count(DISTINCT user_id)::BIGINT AS uv
FROM (SELECT user_id, unnest(generate_series(us // 10000000 + 1, us // 10000000 + 360)) AS e FROM ({VIEWS})) GROUP BY ALL""",
    "unique_visitors_bitmap": f"""SELECT make_timestamp((us // {HOUR} + 1) * {HOUR}) AS window_end,
       count(DISTINCT {HASH28})::BIGINT AS uv
FROM ({VIEWS}) GROUP BY ALL""",
    "unique_visitors_running": f"""SELECT make_timestamp((b + 1) * {HOUR}) AS window_end, user_id,
       row_number() OVER (PARTITION BY b ORDER BY us, event_id)::BIGINT AS uv_so_far
FROM (SELECT us // {HOUR} AS b, user_id, us, event_id, {HASH28} AS h FROM ({VIEWS})
      QUALIFY row_number() OVER (PARTITION BY b, h ORDER BY us, event_id) = 1)""",
    "marketing_by_channel": f"""SELECT window_end - INTERVAL 1 HOUR AS window_start, * FROM (
{_sliding(f"SELECT {CHANNEL_OF_K} AS channel, event_type AS behavior, us FROM ({VIEWS_K}) WHERE event_type IS DISTINCT FROM 'error'",
          "channel, behavior", HOUR, 60_000_000)})""",
    "marketing_total": f"""SELECT window_end - INTERVAL 1 HOUR AS window_start, * FROM (
{_sliding(f"SELECT us FROM ({VIEWS_K})", "", HOUR, 60_000_000)})""",
    "ad_quota_blacklist": f"SELECT user_id, ad_id, day FROM ({AD_KEPT}) WHERE rn = 2",
    "ad_clicks_by_geo": _sliding(f"""SELECT n.n_name AS province, a.us FROM ({AD_KEPT}) a
JOIN nation n ON n.n_nationkey = a.user_id % 25 WHERE a.rn <= 1""", "province", HOUR, 300_000_000),
    "login_fail_consecutive": _pair_fails(12 * HOUR),
    "seq_adjacent_fails": _pair_fails(2 * HOUR),
    "login_fail_burst": _greedy(BURST_CANDS, "user_id", "user_id, first_ts, last_ts, times") + " WHERE times >= 2",
    "seq_n_in_span": f"SELECT user_id, ts AS first_ts, e_ts AS last_ts FROM ({_leads(2)}) WHERE e_us - us < {6 * HOUR}",
    "seq_blocks": _greedy(f"""SELECT user_id, us AS s_us, event_id AS s_id, e_us, e_id, ts AS first_ts, e_ts AS last_ts
FROM ({_leads(5)}) WHERE e_us - us < {36 * HOUR}""", "user_id", "user_id, first_ts, last_ts"),
    "seq_threshold_then_next": _greedy(f"""SELECT user_id, us AS s_us, event_id AS s_id, e_us, e_id, ts AS first_ts, e_ts AS next_ts
FROM ({_leads(1)}) WHERE value > 100 AND e_us - us < {10 * HOUR}""", "user_id", "user_id, first_ts, next_ts"),
    "seq_points_cumulative": _greedy(f"""SELECT user_id, us AS s_us, event_id AS s_id, e_us, e_id, ts AS first_ts, e_ts AS next_ts
FROM ({CUMULATIVE}) WHERE points > 300 AND e_us - us < {2 * DAY}""", "user_id", "user_id, first_ts, next_ts"),
    "seq_multi_account": _greedy(_multi(SIG, DAY), "k", "k, start_user, first_ts, last_ts"),
    "seq_account_chain": _greedy(_chain(SIG, DAY), "k", "k, start_user, first_ts, last_ts"),
    "seq_multi_account_all": _greedy(_multi(ALL_SIG, HOUR // 4), "k", "start_user, first_ts, last_ts"),
    "seq_account_chain_all": _greedy(_chain(ALL_SIG, HOUR // 4), "k", "start_user, first_ts, last_ts"),
    "seq_pattern_funnel": f"""WITH e AS MATERIALIZED ({E}),
clicked AS (
  SELECT v.user_id, v.us, v.event_id AS view_id, v.value AS view_value, arg_min(c, (c.us, c.event_id)) AS c
  FROM e v JOIN e c ON c.user_id = v.user_id AND (c.us, c.event_id) > (v.us, v.event_id) AND c.value > v.value
    AND c.us - v.us < {3 * DAY} WHERE v.event_type = 'view' AND c.event_type = 'click' GROUP BY ALL)
SELECT f.user_id, f.view_id, any_value(f.c.event_id) AS click_id, arg_min(p.event_id, (p.us, p.event_id)) AS purchase_id,
       any_value(f.view_value) AS view_value, any_value(f.c.value) AS click_value, arg_min(p.k, (p.us, p.event_id)) AS bought
FROM clicked f JOIN e p ON p.user_id = f.user_id AND p.event_type = 'purchase' AND (p.us, p.event_id) > (f.c.us, f.c.event_id)
  AND p.k IS DISTINCT FROM f.c.k AND p.us - f.us < {3 * DAY}
GROUP BY f.user_id, f.view_id""",
    "tx_match_one_slot": ONE_SLOT,
    "behaviour_value_1h_10s": f"""SELECT make_timestamp(e * 10000000) AS window_end, event_type, round(sum(v), 4) AS amount,
       sum(c)::BIGINT AS n, min(lo) AS least, max(hi) AS most
FROM (SELECT event_type, v, c, lo, hi, unnest(generate_series(b + 1, b + 360)) AS e FROM (
  SELECT event_type, us // 10000000 AS b, sum(value) AS v, count(value) AS c, min(value) AS lo, max(value) AS hi
  FROM ({VIEWS_K}) GROUP BY ALL)) GROUP BY ALL""",
    "order_payment": _paid(),
    "order_payment_with_tx": _paid("AND p.k % 2 = 0"),
    "order_timeout": _payment(False),
    "tx_interval_join": f"""SELECT v.user_id, v.pay_id, c.receipt_id, v.pay_ts, c.receipt_ts
FROM ({PAY_VIEWS}) v JOIN ({PAY_CLICKS}) c ON v.user_id = c.user_id
  AND c.us BETWEEN v.us - {3 * HOUR} AND v.us + {5 * HOUR}""",
    "tx_window_join": f"""SELECT v.user_id, v.pay_id, c.receipt_id
FROM ({PAY_VIEWS}) v JOIN ({PAY_CLICKS}) c ON v.user_id = c.user_id AND v.us // {HOUR} = c.us // {HOUR}""",
    "tx_match_outer": """WITH o AS (SELECT o_orderkey AS order_key, o_orderdate AS order_ts FROM orders),
s AS (SELECT l_orderkey AS order_key, min(l_shipdate) AS ship_ts FROM lineitem GROUP BY 1)
SELECT coalesce(o.order_key, s.order_key) AS order_key,
       CASE WHEN o.order_key IS NOT NULL AND s.order_key IS NOT NULL THEN 'matched'
            WHEN o.order_key IS NOT NULL THEN 'unmatched_order' ELSE 'unmatched_shipment' END AS status,
       o.order_ts, s.ship_ts
FROM o FULL OUTER JOIN s ON o.order_key = s.order_key
  AND s.ship_ts BETWEEN o.order_ts - INTERVAL 15 DAY AND o.order_ts + INTERVAL 20 DAY""",
}
