"""The registered queries in SQL, for a side-by-side check on the same parquet tables.

Rates and averages are rounded half up from whole numbers, which has no floating-point doubt.
"""

from __future__ import annotations


def _ratio(part: str, whole: str, digits: int) -> str:
    """``part / whole`` of whole numbers, rounded half away from zero; NULL for a zero ``whole``."""
    scale = 10**digits
    p, w = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return (
        f"(CASE WHEN {w} = 0 THEN NULL ELSE"
        f" CAST(sign({p}) * ((abs({p}) * {2 * scale} + {w}) // (2 * {w})) AS DOUBLE) / {scale} END)"
    )


def _percent(part: str, whole: str) -> str:
    return _ratio(f"100 * ({part})", whole, 2)


def _average(value: str, digits: int) -> str:
    return _ratio(f"SUM({value})", f"COUNT({value})", digits)


def _seconds(start: str, end: str) -> str:
    return f"CAST(floor(epoch({end})) - floor(epoch({start})) AS BIGINT)"


_KIND = """CASE event_type WHEN 'click' THEN 'web.webpagedetails.pageViews'
        WHEN 'view' THEN 'commerce.productViews' WHEN 'signup' THEN 'commerce.productListAdds'
        WHEN 'error' THEN 'commerce.productListRemovals' WHEN 'purchase' THEN 'commerce.purchases' END"""

_STAGE_NAME = """CASE {0} WHEN 4 THEN 'purchase' WHEN 3 THEN 'add_to_cart' WHEN 2 THEN 'product_view'
        WHEN 1 THEN 'page_view' ELSE 'unknown' END"""

_FLAT = f"""flat AS (
    SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp, {_KIND} AS event_type,
        CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
        CAST(user_id * 10 + (day(ts) - 1) // 3 AS VARCHAR) AS customer_id,
        CAST(event_type = 'view' AS INTEGER) AS is_product_view,
        CAST(event_type = 'signup' AS INTEGER) AS is_add_to_cart,
        CAST(event_type = 'purchase' AS INTEGER) AS is_purchase,
        CAST(event_type = 'error' AS INTEGER) AS is_remove_from_cart,
        CAST(event_type = 'click' AS INTEGER) AS is_page_view,
        CASE WHEN event_type <> 'click' THEN CAST(k AS VARCHAR) END AS product_id,
        CASE event_type WHEN 'click' THEN NULL WHEN 'error' THEN 0.0 ELSE value END AS product_price,
        CASE event_type WHEN 'click' THEN NULL WHEN 'error' THEN '' ELSE p_brand END AS product_name,
        CASE event_type WHEN 'click' THEN '/' END AS page_url,
        CASE event_type WHEN 'purchase' THEN 4 WHEN 'signup' THEN 3 WHEN 'error' THEN 3
            WHEN 'view' THEN 2 WHEN 'click' THEN 1 ELSE 0 END AS funnel_stage
    FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events) e
    LEFT JOIN part ON p_partkey = k)"""

_SESSIONS = f"""sessions AS (
    SELECT *, {_seconds('session_start', 'session_end')} AS session_duration_seconds,
        purchases > 0 AS converted,
        {_STAGE_NAME.format('max_funnel_stage_reached')} AS funnel_stage_name
    FROM (
        SELECT session_id, customer_id, MIN(event_timestamp) AS session_start,
            MAX(event_timestamp) AS session_end, COUNT(event_id) AS total_events,
            CAST(SUM(is_page_view) AS BIGINT) AS page_views,
            CAST(SUM(is_product_view) AS BIGINT) AS product_views,
            CAST(SUM(is_add_to_cart) AS BIGINT) AS add_to_cart_events,
            CAST(SUM(is_remove_from_cart) AS BIGINT) AS remove_from_cart_events,
            CAST(SUM(is_purchase) AS BIGINT) AS purchases,
            COUNT(DISTINCT product_id) AS unique_products_viewed,
            MAX(funnel_stage) AS max_funnel_stage_reached,
            COALESCE(string_agg(product_id, ',' ORDER BY event_timestamp, event_id), '') AS products_interacted,
            CAST(SUM(CASE WHEN is_purchase = 1 THEN CAST(COALESCE(product_price, 0) AS DECIMAL(18, 2)) END)
                AS DOUBLE) AS session_revenue
        FROM flat GROUP BY session_id, customer_id) s)"""

_TRAIL = f"""trail AS (
    SELECT session_id, customer_id,
        row_number() OVER w AS event_sequence_num, event_id, event_timestamp, event_type,
        lag(event_type) OVER w AS prev_event_type,
        {_seconds('lag(event_timestamp) OVER w', 'event_timestamp')} AS seconds_since_prev_event,
        product_id, product_price, page_url, funnel_stage
    FROM flat WINDOW w AS (PARTITION BY session_id ORDER BY event_timestamp, event_id))"""

_STEP_TIMES = f"""step_times AS (
    SELECT *, {_seconds('ts_page_view', 'ts_product_view')} AS seconds_page_to_product_view,
        {_seconds('ts_product_view', 'ts_add_to_cart')} AS seconds_product_view_to_add,
        {_seconds('ts_add_to_cart', 'ts_purchase')} AS seconds_add_to_purchase,
        {_seconds('ts_page_view', 'ts_purchase')} AS seconds_page_view_to_purchase
    FROM (
        SELECT session_id,
            MIN(event_timestamp) FILTER (is_page_view = 1) AS ts_page_view,
            MIN(event_timestamp) FILTER (is_product_view = 1) AS ts_product_view,
            MIN(event_timestamp) FILTER (is_add_to_cart = 1) AS ts_add_to_cart,
            MIN(event_timestamp) FILTER (is_purchase = 1) AS ts_purchase
        FROM flat GROUP BY session_id) t)"""

_RANKED = """ranked AS (
    SELECT *, session_rank = 1 AS is_first_session, reverse_rank = 1 AS is_last_session
    FROM (
        SELECT *, row_number() OVER w AS session_rank,
            row_number() OVER (PARTITION BY customer_id ORDER BY session_start DESC, session_id DESC) AS reverse_rank,
            CAST(CAST(session_start AS DATE) - CAST(lag(session_start) OVER w AS DATE) AS INTEGER)
                AS days_since_prev_session
        FROM sessions WINDOW w AS (PARTITION BY customer_id ORDER BY session_start, session_id)) r)"""

_TOUCHES = """first_touch AS (
    SELECT customer_id, session_id AS first_session_id, session_start AS first_session_start,
        funnel_stage_name AS first_touch_stage, converted AS first_session_converted,
        unique_products_viewed AS first_session_products_viewed,
        session_duration_seconds AS first_session_duration_sec
    FROM ranked WHERE is_first_session),
last_touch AS (
    SELECT customer_id, session_id AS last_session_id, session_start AS last_session_start,
        funnel_stage_name AS last_touch_stage, converted AS last_session_converted,
        session_revenue AS last_session_revenue
    FROM ranked WHERE is_last_session)"""

_CONVERSION = """first_conversion AS (
    SELECT customer_id, MIN(session_rank) AS sessions_before_first_conversion
    FROM ranked WHERE converted GROUP BY customer_id)"""

_CUSTOMER_ORDERS = """customer_orders AS (
    SELECT CAST(o_custkey AS VARCHAR) AS customer_id, COUNT(o_orderkey) AS actual_order_count,
        MIN(o_orderdate) AS first_order_at, MAX(o_orderdate) AS last_order_at,
        COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS delivered_orders
    FROM orders GROUP BY o_custkey)"""

_JOURNEYS = f"""journeys AS (
    SELECT t.*, first_touch.* EXCLUDE (customer_id), last_touch.* EXCLUDE (customer_id),
        sessions_before_first_conversion, actual_order_count, first_order_at, last_order_at,
        delivered_orders, c_mktsegment AS customer_city, n_name AS customer_state
    FROM (
        SELECT *, CAST(CAST(last_seen_at AS DATE) - CAST(first_seen_at AS DATE) AS INTEGER)
                AS customer_lifetime_days,
            total_purchases > 0 AS ever_converted,
            {_percent('converting_sessions', 'total_sessions')} AS session_conversion_rate_pct,
            {_ratio('total_session_seconds', 'total_sessions', 1)} AS avg_session_duration_sec,
            {_STAGE_NAME.format('deepest_funnel_stage_ever')} AS deepest_funnel_stage_name
        FROM (
            SELECT customer_id, COUNT(session_id) AS total_sessions,
                CAST(SUM(total_events) AS BIGINT) AS total_events,
                CAST(SUM(product_views) AS BIGINT) AS total_product_views,
                CAST(SUM(add_to_cart_events) AS BIGINT) AS total_add_to_cart_events,
                CAST(SUM(purchases) AS BIGINT) AS total_purchases,
                CAST(SUM(page_views) AS BIGINT) AS total_page_views,
                MIN(session_start) AS first_seen_at, MAX(session_end) AS last_seen_at,
                CAST(SUM(COALESCE(session_duration_seconds, 0)) AS BIGINT) AS total_session_seconds,
                CAST(SUM(COALESCE(days_since_prev_session, 0)) AS DOUBLE) / COUNT(*)
                    AS avg_days_between_sessions,
                CAST(SUM(unique_products_viewed) AS BIGINT) AS total_unique_products_viewed,
                CAST(SUM(CAST(session_revenue AS DECIMAL(18, 2))) AS DOUBLE) AS total_behavioral_revenue,
                COUNT(*) FILTER (converted) AS converting_sessions,
                MAX(max_funnel_stage_reached) AS deepest_funnel_stage_ever
            FROM ranked GROUP BY customer_id) a) t
    LEFT JOIN first_touch USING (customer_id)
    LEFT JOIN last_touch USING (customer_id)
    LEFT JOIN first_conversion USING (customer_id)
    LEFT JOIN customer_orders USING (customer_id)
    LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = t.customer_id
    LEFT JOIN nation ON n_nationkey = c_nationkey)"""

_LINES = """lines AS (
    SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS customer_unique_id, CAST(o_orderkey AS VARCHAR) AS order_id,
        CAST(l_partkey AS VARCHAR) AS product_id, p_type AS product_category_name,
        l_extendedprice AS price, o_orderpriority AS payment_type
    FROM customer
    JOIN orders ON o_custkey = c_custkey
    JOIN lineitem ON l_orderkey = o_orderkey
    JOIN part ON p_partkey = l_partkey)"""

# Sessions that lead to the orders: which take a product out again, and what is left of the cart.
_ORDER_ITEMS = f"""{_LINES},
items AS (
    SELECT order_id, product_id, product_category_name, price, customer_unique_id,
        row_number() OVER (PARTITION BY order_id ORDER BY product_id, price) - 1 AS n, COUNT(*) OVER (PARTITION BY order_id) AS size
    FROM lines),
drawn AS (
    SELECT order_id, size, MIN(customer_unique_id) AS customer_id,
        size > 1 AND CAST('0x' || substr(md5('removal-' || order_id), 1, 8) AS BIGINT) % 100 < 15 AS takes_out,
        CAST('0x' || substr(md5('product-' || order_id), 1, 8) AS BIGINT) % size AS pick
    FROM items GROUP BY order_id, size),
removed AS (
    SELECT d.order_id, d.size, d.customer_id, d.takes_out, CASE WHEN d.takes_out THEN i.product_id END AS sku
    FROM drawn d LEFT JOIN items i ON i.order_id = d.order_id AND i.n = d.pick),
order_moves AS (
    SELECT order_id, 0 AS step, 'web.webpagedetails.pageViews' AS event_type, CAST(NULL AS VARCHAR) AS product_id, 0 AS n FROM removed
    UNION ALL SELECT order_id, n + 1, 'commerce.productViews', product_id, 0 FROM items
    UNION ALL SELECT order_id, size + n + 1, 'commerce.productListAdds', product_id, 0 FROM items
    UNION ALL SELECT order_id, 2 * size + 1, 'commerce.productListRemovals', sku, 0 FROM removed WHERE takes_out
    UNION ALL SELECT i.order_id, 2 * i.size + 1 + CAST(takes_out AS INTEGER), 'commerce.purchases', i.product_id, i.n
    FROM items i JOIN removed r USING (order_id) WHERE NOT takes_out OR i.product_id <> r.sku),
bought AS (
    SELECT r.order_id, r.customer_id, 2 * r.size + 1 + CAST(takes_out AS INTEGER) AS step, COUNT(i.order_id) AS n_items,
        COALESCE(CAST(SUM(CAST(i.price AS DECIMAL(18, 2))) AS DOUBLE), 0.0) AS total
    FROM removed r LEFT JOIN items i ON i.order_id = r.order_id AND (NOT takes_out OR i.product_id <> r.sku)
    GROUP BY r.order_id, r.customer_id, r.size, takes_out)"""

_FUNNEL_COUNTS = ", ".join(f"COUNT(*) FILTER (max_funnel_stage_reached >= {n}) AS s{n}" for n in (1, 2, 3, 4))


def _funnel_steps(source: str, by: str = "") -> str:
    steps = []
    for n, name in enumerate(("page_view", "product_view", "add_to_cart", "purchase"), start=1):
        before = f"s{n - 1}"
        step = _percent(f"s{n}", before) if n > 1 else "100.0"
        drop = _percent(f"{before} - s{n}", before) if n > 1 else "0.0"
        steps.append(
            f"SELECT {by} CAST({n} AS BIGINT) AS funnel_step, '{name}' AS step_name, s{n} AS sessions_entered,"
            f" {_percent(f's{n}', 'total')} AS overall_conversion_rate_pct,"
            f" CAST({step} AS DOUBLE) AS step_conversion_rate_pct,"
            f" CAST({drop} AS DOUBLE) AS drop_off_rate_pct FROM {source}"
        )
    return " UNION ALL ".join(steps)


_STEP_AVERAGES = f"""{_average('seconds_page_to_product_view', 1)} AS avg_sec_page_to_product_view,
    {_average('seconds_product_view_to_add', 1)} AS avg_sec_product_view_to_add,
    {_average('seconds_add_to_purchase', 1)} AS avg_sec_add_to_purchase,
    {_average('seconds_page_view_to_purchase', 1)} AS avg_sec_full_journey,
    COUNT(ts_purchase) AS converting_sessions_with_timestamps"""

_DAILY = f"""daily AS (
    SELECT *, {_percent('purchases', 'total_sessions')} AS daily_conversion_rate_pct
    FROM (
        SELECT CAST(session_start AS DATE) AS session_date, COUNT(*) AS total_sessions,
            COUNT(*) FILTER (max_funnel_stage_reached >= 2) AS product_views,
            COUNT(*) FILTER (max_funnel_stage_reached >= 3) AS add_to_carts,
            COUNT(*) FILTER (max_funnel_stage_reached >= 4) AS purchases
        FROM sessions GROUP BY 1) d)"""

_TO_SESSIONS = (_FLAT, _SESSIONS)
_TO_RANKED = (*_TO_SESSIONS, _RANKED)
_TO_JOURNEYS = (*_TO_RANKED, _TOUCHES, _CONVERSION, _CUSTOMER_ORDERS, _JOURNEYS)


def _with(parts: tuple[str, ...], body: str) -> str:
    return f"WITH {', '.join(parts)} {body}"


def _share(counts: str, key: str, count: str, name: str) -> str:
    share = _percent(count, f"(SUM({count}) OVER ())")
    return f"SELECT {key}, {count}, {share} AS {name} FROM ({counts}) c"


def oracle_sql() -> dict[str, str]:
    """Name to SQL, for every query that SQL can express."""
    flat = "SELECT * FROM flat"
    trail = "SELECT * FROM trail"
    return {
        "flatten_events": _with((_FLAT,), flat),
        "event_envelope_roundtrip": _with((_FLAT,), flat),
        "event_stream_ingest": _with((_FLAT,), flat),
        "event_batches": _with((_FLAT,), "SELECT event_id, event_timestamp, event_type, session_id FROM flat"),
        "topic_decode": """
            SELECT CAST(event_id AS VARCHAR) AS event_id, TRUE AS is_primary,
                CASE WHEN user_id % 3 = 0 THEN 'browser' ELSE 'application' END AS environment_type,
                CASE user_id % 3 WHEN 0 THEN 'Windows' WHEN 1 THEN 'iOS' ELSE 'Android' END AS operating_system,
                CASE event_id % 3 WHEN 0 THEN 'terminal' WHEN 1 THEN 'handset' ELSE 'kiosk' END AS device_category,
                CASE WHEN event_type = 'click' THEN 'homepage' END AS page_name,
                CASE WHEN event_type = 'click' THEN 'direct' END AS referrer_url,
                CASE WHEN event_type = 'click' THEN 'external' END AS referrer_type,
                CASE WHEN event_type <> 'click' THEN 1 END AS quantity,
                CASE WHEN event_type = 'view' THEN 1 END AS product_views,
                CASE WHEN event_type = 'signup' THEN 1 END AS product_list_adds,
                CASE WHEN event_type = 'error' THEN 1 END AS product_list_removals,
                CASE WHEN event_type = 'purchase' THEN 1 END AS purchases,
                CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) END AS purchase_id,
                CASE WHEN event_type = 'purchase' THEN value END AS order_total,
                CASE WHEN event_type = 'purchase' THEN 'BRL' END AS currency,
                CASE WHEN event_type = 'purchase' THEN 'credit_card' END AS payment_type
            FROM events""",
        "sessions": _with(_TO_SESSIONS, "SELECT * FROM sessions"),
        "session_products": _with(
            (_FLAT,),
            """SELECT session_id, customer_id, product_id,
                row_number() OVER (PARTITION BY session_id, customer_id ORDER BY event_timestamp, event_id) AS position
            FROM flat WHERE product_id IS NOT NULL""",
        ),
        "session_events": _with((_FLAT, _TRAIL), trail),
        "events_by_type": f"""SELECT {_KIND} AS "eventType", COUNT(*) AS event_count FROM events GROUP BY 1""",
        "session_summary": _with(
            _TO_SESSIONS,
            f"""SELECT COUNT(*) AS total_sessions, COUNT(DISTINCT customer_id) AS unique_customers,
                COUNT(*) FILTER (converted) AS converting_sessions,
                {_average('session_duration_seconds', 1)} AS avg_session_duration_sec,
                {_average('total_events', 1)} AS avg_events_per_session,
                {_average('unique_products_viewed', 2)} AS avg_products_viewed,
                {_percent('COUNT(*) FILTER (converted)', 'COUNT(*)')} AS session_conversion_rate_pct
            FROM sessions""",
        ),
        "sessions_by_stage": _with(
            _TO_SESSIONS,
            _share(
                "SELECT funnel_stage_name, COUNT(*) AS session_count FROM sessions GROUP BY 1",
                "funnel_stage_name",
                "session_count",
                "pct_of_sessions",
            ),
        ),
        "event_transitions": _with(
            (_FLAT, _TRAIL),
            """SELECT prev_event_type, event_type AS next_event_type, COUNT(*) AS transition_count
            FROM trail WHERE prev_event_type IS NOT NULL GROUP BY 1, 2""",
        ),
        "funnel_metrics": _with(
            (*_TO_SESSIONS, f"counts AS (SELECT COUNT(*) AS total, {_FUNNEL_COUNTS} FROM sessions)"),
            _funnel_steps("counts"),
        ),
        "funnel_step_times": _with((_FLAT, _STEP_TIMES), "SELECT * FROM step_times"),
        "step_time_averages": _with((_FLAT, _STEP_TIMES), f"SELECT {_STEP_AVERAGES} FROM step_times"),
        "step_time_summary": _with(
            (_FLAT, _STEP_TIMES),
            f"""SELECT {_STEP_AVERAGES},
                quantile_disc(seconds_page_view_to_purchase, 0.5) AS median_sec_full_journey,
                quantile_disc(seconds_page_view_to_purchase, 0.9) AS p90_sec_full_journey
            FROM step_times""",
        ),
        "funnel_daily": _with((*_TO_SESSIONS, _DAILY), "SELECT * FROM daily"),
        "daily_trend": _with(
            (*_TO_SESSIONS, _DAILY),
            "SELECT session_date, total_sessions, purchases, daily_conversion_rate_pct FROM daily",
        ),
        "funnel_by_category": _with(
            (
                _FLAT,
                f"""counts AS (
                    SELECT product_category_name, COUNT(*) AS total, {_FUNNEL_COUNTS}
                    FROM (SELECT COALESCE(p_type, 'unknown') AS product_category_name, session_id, customer_id,
                              MAX(funnel_stage) AS max_funnel_stage_reached
                          FROM flat LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = product_id
                          WHERE product_id IS NOT NULL GROUP BY 1, 2, 3) s
                    GROUP BY 1)""",
            ),
            _funnel_steps("counts", "product_category_name,"),
        ),
        "order_funnel_by_category": _with(
            (
                _ORDER_ITEMS,
                f"""counts AS (
                    SELECT product_category_name, COUNT(*) AS total, {_FUNNEL_COUNTS}
                    FROM (SELECT COALESCE(p_type, 'unknown') AS product_category_name, order_id,
                              MAX(CASE event_type WHEN 'commerce.purchases' THEN 4 WHEN 'commerce.productViews' THEN 2 ELSE 3 END)
                                  AS max_funnel_stage_reached
                          FROM order_moves LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = product_id
                          WHERE product_id IS NOT NULL GROUP BY 1, 2) s
                    GROUP BY 1)""",
            ),
            _funnel_steps("counts", "product_category_name,"),
        ),
        "session_carts": _with(
            (
                _FLAT,
                """moves AS (
                    SELECT *, COALESCE(COUNT(*) FILTER (is_purchase = 1) OVER before, 0) AS stretch, row_number() OVER whole AS place
                    FROM flat WHERE is_add_to_cart + is_remove_from_cart + is_purchase = 1
                    WINDOW whole AS (PARTITION BY session_id ORDER BY event_timestamp, event_id),
                        before AS (PARTITION BY session_id ORDER BY event_timestamp, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
                kept AS (
                    SELECT a.*, p.event_id AS purchase_id, p.event_timestamp AS purchased_at
                    FROM moves a JOIN moves p ON p.session_id = a.session_id AND p.stretch = a.stretch AND p.is_purchase = 1
                    WHERE a.is_add_to_cart = 1 AND NOT EXISTS (
                        SELECT 1 FROM moves r WHERE r.session_id = a.session_id AND r.stretch = a.stretch
                            AND r.product_id = a.product_id AND r.is_remove_from_cart = 1 AND r.place > a.place))""",
            ),
            """SELECT session_id, purchase_id, purchased_at, product_id, product_name, product_price AS price,
                row_number() OVER (PARTITION BY session_id, purchase_id ORDER BY place) AS position,
                CAST(SUM(CAST(product_price AS DECIMAL(18, 2))) OVER (PARTITION BY session_id, purchase_id) AS DOUBLE) AS cart_total
            FROM kept""",
        ),
        "order_session_events": _with(
            (_ORDER_ITEMS,),
            """SELECT sha256(m.order_id || '-event-' || m.step) AS event_id, sha256('session-' || m.order_id) AS session_id,
                strftime(TIMESTAMP '2024-01-31 00:00:00' + m.step * INTERVAL 50 MILLISECOND, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp,
                m.event_type, COALESCE(string_agg(m.product_id, ',' ORDER BY m.n), '') AS skus,
                MAX(b.total) AS order_total
            FROM (SELECT order_id, step, event_type, product_id, n FROM order_moves
                UNION ALL SELECT order_id, step, 'commerce.purchases', NULL, 0 FROM bought WHERE n_items = 0) m
            LEFT JOIN bought b ON b.order_id = m.order_id AND m.event_type = 'commerce.purchases'
            GROUP BY m.order_id, m.step, m.event_type""",
        ),
        "order_carts": _with(
            (_ORDER_ITEMS,),
            """SELECT sha256('session-' || order_id) AS session_id, sha256(order_id || '-event-' || step) AS purchase_id,
                n_items AS stated_items, total AS stated_total, n_items AS cart_items, total AS cart_total, TRUE AS agrees
            FROM bought""",
        ),
        "strict_funnel": _with(
            (
                _FLAT,
                """steps AS (SELECT session_id, event_timestamp AS moment, event_id AS id, funnel_stage AS stage FROM flat
                    WHERE event_type <> 'commerce.productListRemovals'),
                one AS (SELECT session_id, moment, id, moment AS begun FROM steps WHERE stage = 1),
                two AS (
                    SELECT s.session_id, s.moment, s.id, p.begun FROM steps s JOIN one p ON p.session_id = s.session_id AND (p.moment, p.id) < (s.moment, s.id)
                    WHERE s.stage = 2 AND s.moment <= p.begun + INTERVAL 6 HOUR),
                three AS (
                    SELECT s.session_id, s.moment, s.id, p.begun FROM steps s JOIN two p ON p.session_id = s.session_id AND (p.moment, p.id) < (s.moment, s.id)
                    WHERE s.stage = 3 AND s.moment <= p.begun + INTERVAL 6 HOUR),
                four AS (
                    SELECT s.session_id, s.moment, s.id, p.begun FROM steps s JOIN three p ON p.session_id = s.session_id AND (p.moment, p.id) < (s.moment, s.id)
                    WHERE s.stage = 4 AND s.moment <= p.begun + INTERVAL 6 HOUR),
                counts AS (
                    SELECT (SELECT COUNT(DISTINCT session_id) FROM flat) AS total,
                        (SELECT COUNT(DISTINCT session_id) FROM one) AS s1, (SELECT COUNT(DISTINCT session_id) FROM two) AS s2,
                        (SELECT COUNT(DISTINCT session_id) FROM three) AS s3, (SELECT COUNT(DISTINCT session_id) FROM four) AS s4)""",
            ),
            _funnel_steps("counts"),
        ),
        "step_time_quantiles": _with(
            (_FLAT, _STEP_TIMES),
            """SELECT CAST(date_trunc('week', ts_page_view) AS DATE) AS week, COUNT(*) AS journeys,
                quantile_disc(seconds_page_view_to_purchase, 0.5) AS median_sec_full_journey,
                quantile_disc(seconds_page_view_to_purchase, 0.9) AS p90_sec_full_journey
            FROM step_times WHERE seconds_page_view_to_purchase IS NOT NULL GROUP BY 1""",
        ),
        "csv_rejects": """SELECT CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey END AS order_id,
                CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS customer_id,
                CASE WHEN o_orderkey % 11 = 0 THEN 'x' || o_orderkey || ',' || o_custkey || ',' || o_orderstatus END AS rejected_line
            FROM orders""",
        "load_results": " UNION ALL ".join(
            f"SELECT '{name}.csv' AS file, '{name}' AS \"table\", '{status}' AS status, {n} AS rows, {rejected} AS rejected"
            for name, status, n, rejected in (
                *((t, "loaded", f"(SELECT COUNT(*) FROM {t})", "CAST(0 AS BIGINT)") for t in ("customer", "part", "supplier")),
                ("nation", "failed", "NULL", "NULL"),
                ("absent", "skipped", "NULL", "NULL"),
            )
        ),
        "table_versions": """WITH kept AS (
                SELECT 0 AS version, 'overwrite' AS operation, o_orderkey, o_orderkey % 3 = 0 AS fresh FROM orders WHERE o_orderkey % 3 = 0
                UNION ALL SELECT 1, 'append', o_orderkey, o_orderkey % 3 = 1 FROM orders WHERE o_orderkey % 3 < 2
                UNION ALL SELECT 2, 'replace', o_orderkey, o_orderstatus = 'F' FROM orders
                WHERE CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 3 = 2 ELSE o_orderkey % 3 < 2 END)
            SELECT version, operation, COUNT(*) FILTER (fresh) AS rows, COUNT(*) AS held, CAST(SUM(o_orderkey) AS BIGINT) AS key_sum
            FROM kept GROUP BY version, operation""",
        "event_files_any_form": _with((_FLAT,), flat),
        "event_schema_growth": """SELECT CAST(event_id AS VARCHAR) AS event_id,
                CASE event_id % 3 WHEN 0 THEN 'terminal' WHEN 1 THEN 'handset' ELSE 'kiosk' END AS device_category,
                CASE WHEN event_id % 2 = 1 THEN 'v' || length(CAST(event_id AS VARCHAR)) END AS app_version,
                CASE WHEN event_type <> 'click' THEN CASE WHEN event_id % 2 = 1 THEN 1099511627776 ELSE 1 END END AS quantity,
                CASE WHEN event_type <> 'click' AND event_id % 2 = 1 THEN CASE event_type WHEN 'error' THEN 0.0 ELSE value / 2 END END AS discount
            FROM events""",
        "late_customer_journeys": _with(_TO_JOURNEYS, "SELECT * FROM journeys"),
        "ranked_sessions": _with(
            _TO_RANKED,
            """SELECT session_id, customer_id, session_start, session_rank, is_first_session,
                is_last_session, days_since_prev_session FROM ranked""",
        ),
        "first_last_touch": _with(
            (*_TO_RANKED, _TOUCHES), "SELECT * FROM first_touch JOIN last_touch USING (customer_id)"
        ),
        "first_conversion": _with((*_TO_RANKED, _CONVERSION), "SELECT * FROM first_conversion"),
        "customer_orders": _with((_CUSTOMER_ORDERS,), "SELECT * FROM customer_orders"),
        "customer_journeys": _with(_TO_JOURNEYS, "SELECT * FROM journeys"),
        "customer_journey_sessions": _with(
            _TO_JOURNEYS,
            """SELECT session_id, customer_id, session_rank, session_start, session_end,
                session_duration_seconds, r.total_events, product_views, add_to_cart_events, purchases,
                converted, funnel_stage_name, session_revenue, is_first_session, is_last_session,
                days_since_prev_session, total_sessions AS customer_total_sessions,
                ever_converted AS customer_ever_converted,
                deepest_funnel_stage_name AS customer_deepest_stage
            FROM ranked r LEFT JOIN journeys USING (customer_id)""",
        ),
        "engagement_summary": _with(
            _TO_JOURNEYS,
            f"""SELECT COUNT(DISTINCT customer_id) AS total_customers,
                {_average('total_sessions', 2)} AS avg_sessions_per_customer,
                {_average('total_events', 1)} AS avg_events_per_customer,
                {_average('total_unique_products_viewed', 2)} AS avg_products_viewed,
                COUNT(*) FILTER (ever_converted) AS customers_who_purchased,
                {_percent('COUNT(*) FILTER (ever_converted)', 'COUNT(DISTINCT customer_id)')}
                    AS customer_conversion_rate_pct,
                {_average('customer_lifetime_days', 1)} AS avg_customer_lifetime_days
            FROM journeys""",
        ),
        "conversion_sessions": _with(
            (*_TO_RANKED, _CONVERSION),
            _share(
                """SELECT sessions_before_first_conversion, COUNT(*) AS customer_count
                FROM first_conversion GROUP BY 1""",
                "sessions_before_first_conversion",
                "customer_count",
                "pct_of_converters",
            ),
        ),
        "first_touch_distribution": _with(
            _TO_JOURNEYS,
            f"""SELECT first_touch_stage, COUNT(*) AS customer_count,
                COUNT(*) FILTER (ever_converted) AS converted_customers,
                {_percent('COUNT(*) FILTER (ever_converted)', 'COUNT(*)')}
                    AS conversion_rate_from_this_first_touch
            FROM journeys WHERE first_touch_stage IS NOT NULL GROUP BY 1""",
        ),
        "engagement_segments": _with(
            _TO_JOURNEYS,
            f"""SELECT CASE WHEN total_sessions = 1 AND NOT ever_converted THEN 'single_session_bounced'
                    WHEN total_sessions = 1 AND ever_converted THEN 'single_session_converted'
                    WHEN total_sessions > 1 AND NOT ever_converted THEN 'multi_session_not_converted'
                    WHEN total_sessions > 1 AND ever_converted THEN 'multi_session_converted'
                    ELSE 'unknown' END AS engagement_segment,
                COUNT(*) AS customer_count,
                {_average('total_sessions', 2)} AS avg_sessions,
                {_average('total_events', 1)} AS avg_events,
                {_average('CAST(total_behavioral_revenue * 100 AS BIGINT)', 0)} / 100 AS avg_revenue
            FROM journeys GROUP BY 1""",
        ),
        "reference_orders": _with((_LINES,), "SELECT * FROM lines"),
        "order_purchases": _with(
            (_LINES,),
            """SELECT order_id, MIN(customer_unique_id) AS customer_id, 0 AS part,
                CAST(COUNT(*) AS INTEGER) AS item_count,
                string_agg(product_id, ',' ORDER BY product_id, price) AS skus,
                CAST(SUM(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) AS order_total,
                COALESCE(NULLIF(MIN(payment_type), ''), 'credit_card') AS payment_type
            FROM lines GROUP BY order_id""",
        ),
        "order_purchase_events": _with(
            (_LINES,),
            """SELECT sha256(order_id || '-0') AS event_id,
                '2024-01-31T00:00:00.000000+00:00' AS timestamp,
                sha256('session-' || order_id) AS session_id,
                CAST(COUNT(*) AS INTEGER) AS item_count,
                first(product_id ORDER BY product_id, price) AS first_sku,
                first(price ORDER BY product_id, price) AS first_price,
                order_id AS purchase_id,
                CAST(SUM(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) AS order_total,
                COALESCE(NULLIF(MIN(payment_type), ''), 'credit_card') AS payment_type
            FROM lines GROUP BY order_id""",
        ),
        "purchase_items": _with(
            (_LINES,),
            """SELECT order_id, row_number() OVER (PARTITION BY order_id ORDER BY product_id, price) AS position,
                product_id AS sku, price
            FROM lines""",
        ),
        "table_counts": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {name}"
            for name in ("customer", "orders", "lineitem", "part", "supplier", "nation", "events")
        ),
        "csv_roundtrip": """SELECT CAST(o_orderkey AS INTEGER) AS order_id,
            CAST(o_custkey AS INTEGER) AS customer_id,
            CASE WHEN o_orderstatus = 'F' THEN 'delivered' ELSE o_orderstatus END AS order_status,
            o_orderdate AS order_purchase_timestamp FROM orders""",
        "csv_text_roundtrip": "SELECT conv_id, turn, NULLIF(role, '') AS role, NULLIF(text, '') AS text FROM conversations",
        "upsert_orders": """WITH held AS (
                SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
                    CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS changed_at,
                    CASE WHEN o_orderstatus = 'F' THEN 'delivered' ELSE o_orderstatus END AS order_status
                FROM orders),
            given AS (
                SELECT CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
                    'c' || o_custkey AS customer_id,
                    o_orderdate + CAST(o_orderkey % 2 * 2 - 1 AS INTEGER) * INTERVAL 1 DAY AS changed_at,
                    'returned' AS order_status
                FROM orders WHERE o_orderkey % 3 = 0),
            both_sides AS (SELECT *, 0 AS change FROM held UNION ALL SELECT *, 1 AS change FROM given)
            SELECT order_id, customer_id, changed_at, order_status FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY order_id ORDER BY changed_at DESC NULLS LAST, change DESC, customer_id DESC) AS place
                FROM both_sides)
            WHERE place = 1""",
    }
