"""The sample queries once more as plain SQL for DuckDB, written from the definitions."""

from cartpulse.plans.sample_queries import THRESHOLDS

_EVENTS = """
ev AS (
  SELECT event_id AS seq, ts AS event_time,
    CASE event_type WHEN 'click' THEN 'cart' WHEN 'error' THEN 'remove_from_cart' ELSE event_type END AS event_type,
    json_extract_string(props, '$.k') AS product_id,
    CAST(user_id AS VARCHAR) AS user_id, CAST(user_id AS VARCHAR) AS session_id,
    value AS price,
    CASE WHEN user_id % 7 = 0 THEN NULL ELSE 'run-' || (user_id % 7) END AS experiment_id,
    ts + to_microseconds(CAST(round(value * 1000) AS BIGINT) * 1000) AS processed_at
  FROM events WHERE event_type IN ('view', 'click', 'error', 'purchase'))"""

_RAW = """
raw AS (
  SELECT event_id AS seq,
    CASE event_id % 5 WHEN 1 THEN ts WHEN 3 THEN date_trunc('millisecond', ts) ELSE date_trunc('second', ts) END AS event_time,
    CASE event_type WHEN 'click' THEN 'cart' WHEN 'error' THEN 'remove_from_cart' WHEN 'signup' THEN NULL ELSE event_type END AS event_type,
    json_extract_string(props, '$.k') AS product_id,
    CAST(user_id AS VARCHAR) AS user_id,
    CASE WHEN value < 0.5 THEN '' ELSE CAST(user_id AS VARCHAR) END AS session_id,
    CASE WHEN value > 150 THEN NULL ELSE value END AS price
  FROM events),
judged AS (
  SELECT *, CASE WHEN event_type IS NULL THEN 'unsupported event_type'
                 WHEN price IS NULL THEN 'invalid price'
                 WHEN session_id = '' THEN 'session_id is required' END AS reason
  FROM raw)"""

_CATALOGUED = """
catalogued AS (
  SELECT *, CAST(2000 + CAST(product_id AS INTEGER) % 7 AS VARCHAR) AS category_id,
    CASE WHEN CAST(product_id AS INTEGER) % 7 > 0 THEN 'shop.c' || CAST(product_id AS INTEGER) % 7 ELSE '' END AS category_code,
    CASE WHEN CAST(product_id AS INTEGER) % 5 > 0 THEN 'Brand ' || CAST(product_id AS INTEGER) % 5 ELSE '' END AS brand
  FROM judged WHERE reason IS NULL)"""

_COUNTS = """count(*) FILTER (event_type = 'view') AS views,
    count(*) FILTER (event_type = 'cart') AS carts,
    count(*) FILTER (event_type = 'remove_from_cart') AS removals,
    count(*) FILTER (event_type = 'purchase') AS purchases,
    CAST(count(*) FILTER (event_type = 'view') + 3 * count(*) FILTER (event_type = 'cart')
      + 5 * count(*) FILTER (event_type = 'purchase') AS BIGINT) AS trend_score"""

_STAGES = """count(DISTINCT session_id) FILTER (event_type = 'view') AS view_sessions,
    count(DISTINCT session_id) FILTER (event_type = 'cart') AS cart_sessions,
    count(DISTINCT session_id) FILTER (event_type = 'purchase') AS purchase_sessions"""

_CLEAN = "event_time, event_type, product_id, user_id, session_id, price"


def _rounded(value: str, digits: int) -> str:
    return f"CAST(format('{{:.{digits}f}}', {value}) AS DOUBLE)"


def _drop(entered: str, continued: str) -> str:
    ratio = f"greatest(0.0, 1 - CAST({continued} AS DOUBLE) / {entered})"
    return f"CASE WHEN {entered} > 0 THEN {_rounded(ratio, 4)} END"


_DROPS = (
    f"{_drop('view_sessions', 'cart_sessions')} AS view_to_cart_dropoff, "
    f"{_drop('cart_sessions', 'purchase_sessions')} AS cart_to_purchase_dropoff"
)


def _bucket(width: str, column: str = "event_time") -> str:
    return f"time_bucket(INTERVAL '{width}', {column}, TIMESTAMP '1970-01-01')"


def _baseline(width: str, source: str = "ev", windows: str = "count(*)") -> str:
    return f"""
cells AS (SELECT product_id, {_bucket(width)} AS window_start, {_COUNTS} FROM {source} GROUP BY ALL),
activity AS (
  SELECT product_id,
    CAST(sum(views) AS DOUBLE) / {windows} AS avg_views_5m, CAST(sum(carts) AS DOUBLE) / {windows} AS avg_carts_5m,
    CAST(sum(purchases) AS DOUBLE) / {windows} AS avg_purchases_5m,
    CAST(sum(trend_score) AS DOUBLE) / {windows} AS avg_trend_score_5m,
    CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(carts) AS BIGINT) AS total_carts,
    CAST(sum(purchases) AS BIGINT) AS total_purchases, count(*) AS observed_5m_windows
  FROM cells GROUP BY product_id),
stages AS (SELECT product_id, {_STAGES} FROM {source} GROUP BY product_id),
base AS (
  SELECT activity.*, view_sessions, cart_sessions, purchase_sessions,
    CASE WHEN view_sessions > 0 THEN 1 - CAST(cart_sessions AS DOUBLE) / view_sessions END AS historical_view_to_cart_dropoff,
    CASE WHEN cart_sessions > 0 THEN 1 - CAST(purchase_sessions AS DOUBLE) / cart_sessions END AS historical_cart_to_purchase_dropoff
  FROM activity LEFT JOIN stages USING (product_id))"""


_ALL_WINDOWS = (
    "(SELECT (epoch_us(max(window_start)) - epoch_us(min(window_start))) // 300000000 + 1 FROM cells)"
)


def _recent(width: str) -> str:
    return (
        f"recent AS (SELECT * FROM ev WHERE event_time >= "
        f"(SELECT max(event_time) - INTERVAL '{width}' FROM ev))"
    )


_PRODUCTS = f"products AS (SELECT product_id, {_COUNTS} FROM recent GROUP BY product_id)"
_FUNNEL = (
    f"stage_row AS (SELECT {_STAGES}, count(DISTINCT session_id) AS active_sessions FROM recent), "
    f"funnel AS (SELECT *, {_DROPS} FROM stage_row)"
)

_COMPARED = f"""
compared AS (
  SELECT p.*,
    {_rounded('coalesce(b.avg_views_5m, 0.0)', 3)} AS normal_views_5m,
    {_rounded('coalesce(b.avg_carts_5m, 0.0)', 3)} AS normal_carts_5m,
    {_rounded('coalesce(b.avg_purchases_5m, 0.0)', 3)} AS normal_purchases_5m,
    {_rounded('coalesce(b.avg_trend_score_5m, 0.0)', 3)} AS normal_trend_score_5m,
    CASE WHEN b.avg_trend_score_5m > 0 THEN {_rounded('p.trend_score / b.avg_trend_score_5m', 3)} END AS activity_lift,
    coalesce(b.avg_trend_score_5m > 0 AND p.trend_score >= 2 * b.avg_trend_score_5m, false) AS is_unusually_trending,
    coalesce(b.avg_trend_score_5m, 0.0) AS normal_score_exact
  FROM products p LEFT JOIN base b USING (product_id))"""
_RANK = "ORDER BY activity_lift DESC NULLS LAST, trend_score DESC, product_id"

_DAY_COMPARED = f"{_EVENTS}, {_recent('1 day')}, {_PRODUCTS}, {_baseline('1 day')}, {_COMPARED}"

_MINUTES = f"""
buckets AS (
  SELECT date_trunc('minute', event_time) AS bucket, product_id, {_COUNTS},
    (epoch_us(max(event_time)) + 172800000000) // 1000000 AS expires_at, max(processed_at) AS updated_at
  FROM ev GROUP BY ALL)"""
_KEPT = """
kept AS (SELECT * FROM buckets WHERE expires_at > (SELECT epoch_us(max(updated_at)) // 1000000 FROM buckets))"""
_HEALTH = """
health AS (
  SELECT date_trunc('minute', event_time) AS bucket, experiment_id, count(*) AS event_count,
    CAST(sum((epoch_us(processed_at) - epoch_us(event_time)) // 1000) AS BIGINT) AS latency_total_ms,
    (epoch_us(max(event_time)) + 172800000000) // 1000000 AS expires_at, max(processed_at) AS updated_at
  FROM ev GROUP BY ALL)"""
_MINUTE_TOTALS = """CAST(sum(views) AS BIGINT) AS views, CAST(sum(carts) AS BIGINT) AS carts,
  CAST(sum(removals) AS BIGINT) AS removals, CAST(sum(purchases) AS BIGINT) AS purchases,
  CAST(sum(views) + 3 * sum(carts) + 5 * sum(purchases) AS BIGINT) AS trend_score"""


def _signals(width: str, flush: bool = False) -> str:
    pushed = f" + INTERVAL '{width}'" if flush else ""
    return f"""
clock AS (SELECT max(event_time){pushed} AS now FROM ev),
actions AS (
  SELECT *, lead(event_time) OVER (PARTITION BY session_id, product_id ORDER BY event_time, seq) AS next_time
  FROM ev WHERE event_type <> 'view'),
carts AS (
  SELECT session_id, product_id, event_time AS cart_time, event_time + INTERVAL '{width}' AS deadline, next_time
  FROM actions WHERE event_type = 'cart'),
overdue AS (
  SELECT session_id, product_id, cart_time, deadline FROM carts, clock
  WHERE (next_time IS NULL OR next_time >= deadline) AND deadline <= now),
signals AS (
  SELECT o.session_id, o.product_id, o.cart_time, o.deadline, coalesce(e.event_time, (SELECT now FROM clock)) AS detected_at
  FROM overdue o ASOF LEFT JOIN (SELECT event_time FROM ev) e ON o.deadline <= e.event_time),
pending AS (
  SELECT session_id, product_id, cart_time, deadline FROM carts, clock
  WHERE next_time IS NULL AND deadline > now)"""


_LATEST = "SELECT * FROM signals ORDER BY detected_at DESC, cart_time DESC, session_id DESC, product_id DESC LIMIT 10"

_RUNS = f"""
counted AS (
  SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, min(ts) AS started_at_utc, max(ts) AS completed_at_utc,
    count(*) AS sent_records,
    count(*) FILTER (event_type IN ('view', 'click', 'error', 'purchase') OR user_id % 10 > 0
      OR CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0) AS processed_records,
    min(value) AS p50_latency_ms, max(value) AS p95_latency_ms
  FROM events GROUP BY ALL),
timed AS (SELECT *, (epoch_us(completed_at_utc) - epoch_us(started_at_utc)) / 1e6 AS secs FROM counted),
runs AS (
  SELECT 'run-' || k AS experiment_id, completed_at_utc, 100 * (1 + k % 3) AS target_rate_eps, sent_records,
    processed_records, p50_latency_ms, p95_latency_ms, {_rounded('secs', 3)} AS producer_seconds,
    CASE WHEN secs > 0 THEN {_rounded('sent_records / secs', 2)} END AS producer_throughput_eps
  FROM timed),
complete AS (SELECT * FROM runs WHERE processed_records = sent_records)"""


def _median(value: str) -> str:
    """Half of each middle value, the way the percentile is interpolated."""
    return (
        f"list_sort(list({value}))[(count(*) + 1) // 2] * 0.5 "
        f"+ list_sort(list({value}))[count(*) // 2 + 1] * 0.5"
    )


def _percentile(p: str, name: str) -> str:
    return f"""
    max(CASE WHEN i = floor({p} * (n - 1)) AND floor({p} * (n - 1)) = ceil({p} * (n - 1)) THEN CAST(latency_ms AS DOUBLE) END) AS {name}_exact,
    max(CASE WHEN i = floor({p} * (n - 1)) THEN (ceil({p} * (n - 1)) - {p} * (n - 1)) * latency_ms END)
    + max(CASE WHEN i = ceil({p} * (n - 1)) THEN ({p} * (n - 1) - floor({p} * (n - 1))) * latency_ms END) AS {name}_mixed"""


_SAMPLES = """
samples AS (
  SELECT epoch_us(date_trunc('minute', ts)) // 1000000 AS elapsed_seconds, count(DISTINCT event_type) AS total_workers
  FROM events GROUP BY ALL)"""



def _hops(offsets: str, step: str, width: str) -> str:
    return f"""
hops AS (
  SELECT ev.*, {_bucket(step)} - o * INTERVAL '{step}' AS window_start,
    {_bucket(step)} - o * INTERVAL '{step}' + INTERVAL '{width}' AS window_end
  FROM ev, unnest({offsets}) AS t(o))"""


def _series(window: str) -> str:
    """Counts over a range of time, less the events of the same moment that come later in the stream."""
    def count(kind: str, by: str) -> str:
        only = f"FILTER (event_type = '{kind}')" if kind else ""
        parts = f"PARTITION BY {by}" if by else ""
        return (
            f"count(*) {only} OVER ({parts} ORDER BY event_time RANGE BETWEEN INTERVAL '{window}' PRECEDING AND CURRENT ROW)"
            f" - count(*) {only} OVER (PARTITION BY {by + ', ' if by else ''}event_time ORDER BY seq"
            " ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
        )

    kinds = {"views": "view", "carts": "cart", "removals": "remove_from_cart", "purchases": "purchase"}
    counts = ", ".join(f"{count(kind, 'product_id')} AS {name}" for name, kind in kinds.items())
    return f"""WITH {_EVENTS}, counted AS (
        SELECT seq, event_time, product_id, {counts}, {count('', '')} AS events_in_window FROM ev)
        SELECT *, views + 3 * carts + 5 * purchases AS trend_score FROM counted"""


def oracle_sql() -> dict[str, str]:
    day = f"{_EVENTS}, {_recent('1 day')}"
    trending_columns = (
        "product_id, views, carts, purchases, trend_score, normal_views_5m, normal_carts_5m, "
        "normal_purchases_5m, normal_trend_score_5m, activity_lift, is_unusually_trending"
    )
    sensitivity = " UNION ALL ".join(
        f"SELECT CAST({t} AS DOUBLE) AS threshold, count(*) AS products, "
        f"count(*) FILTER (normal_score_exact > 0 AND trend_score >= {t} * normal_score_exact) AS flagged_products "
        "FROM compared"
        for t in THRESHOLDS
    )
    long_signals = f"{_EVENTS}, {_signals('5 days')}"
    signal_columns = "session_id, product_id, cart_time, deadline, detected_at"
    baseline_5m = f"WITH {_EVENTS}, {_baseline('5 minutes')} SELECT * FROM base"
    found = {
        "event_normalise": f"WITH {_RAW} SELECT seq, {_CLEAN}, event_time AS source_event_time FROM judged WHERE reason IS NULL",
        "rejected_events": f"WITH {_RAW} SELECT seq, reason FROM judged WHERE reason IS NOT NULL",
        "ingest_quality": f"""WITH {_RAW} SELECT count(*) AS source_rows, count(*) - count(reason) AS accepted_rows,
            count(reason) AS rejected_rows, {_rounded('count(reason) * 100.0 / count(*)', 4)} AS reject_rate_percent FROM judged""",
        "ingest_reasons": f"WITH {_RAW} SELECT coalesce(reason, 'accepted') AS reason, count(*) AS rows FROM judged GROUP BY 1",
        "usable_events": f"WITH {_EVENTS} SELECT seq, {_CLEAN} FROM ev",
        "source_row_limit": f"""WITH {_RAW} SELECT coalesce(reason, 'accepted') AS reason, count(*) AS rows
            FROM (SELECT * FROM judged ORDER BY seq LIMIT 1000) GROUP BY 1""",
        "csv_ingest": f"WITH {_RAW} SELECT {_CLEAN} FROM judged WHERE reason IS NULL",
        "csv_rejects": f"WITH {_RAW} SELECT coalesce(reason, 'accepted') AS reason, count(*) AS rows FROM judged GROUP BY 1",
        "jsonl_roundtrip": f"WITH {_EVENTS} SELECT {_CLEAN}, event_time AS source_event_time FROM ev",
        "keyed_record_decode": f"WITH {_EVENTS} SELECT session_id AS key, {_CLEAN}, 'trial-1' AS experiment_id FROM ev",
        "keyed_files": f"WITH {_EVENTS} SELECT session_id AS key, count(*) AS events, max(event_time) AS last_time FROM ev GROUP BY 1",
        "ingest_files": f"""WITH {_RAW} SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
            count(*) AS rows FROM judged GROUP BY 1""",
        "archive_range": f"""WITH {_EVENTS} SELECT strftime(event_time, '%Y-%m-%d') AS event_date, count(*) AS events FROM ev
            WHERE event_time BETWEEN TIMESTAMP '2024-01-10 12:00:00' AND TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1""",
        "order_violations": """SELECT * FROM (SELECT o_orderkey AS seq, o_orderdate AS event_time, max(o_orderdate) OVER
            (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_before FROM orders)
            WHERE event_time < latest_before""",
        "replay_rebase": f"""WITH {_EVENTS} SELECT seq, event_time AS source_event_time, TIMESTAMP '2030-01-01 00:00:00'
            + to_microseconds((row_number() OVER (ORDER BY seq) - 1) * 125000) AS event_time FROM ev""",
        "replay_preserve_timing": f"""WITH {_EVENTS} SELECT seq, event_time AS source_event_time, TIMESTAMP '2030-01-01 00:00:00'
            + (event_time - (SELECT arg_min(event_time, seq) FROM ev)) AS event_time FROM ev""",
        "product_window_counts": f"WITH {_EVENTS} SELECT product_id, {_bucket('5 minutes')} AS window_start, {_COUNTS} FROM ev GROUP BY ALL",
        "product_activity": f"WITH {_EVENTS}, {_baseline('5 minutes')} SELECT * FROM activity",
        "product_session_funnel": f"WITH {_EVENTS} SELECT product_id, {_STAGES} FROM ev GROUP BY 1",
        "product_baseline": baseline_5m,
        "product_baseline_daily": f"WITH {_EVENTS}, {_baseline('1 day')} SELECT * FROM base",
        "product_baseline_joined": baseline_5m,
        "product_baseline_all_windows": f"WITH {_EVENTS}, {_baseline('5 minutes', windows=_ALL_WINDOWS)} SELECT * FROM base",
        "historical_dropoff": f"""WITH {_EVENTS}, {_baseline('5 minutes')}
            SELECT product_id, historical_view_to_cart_dropoff, historical_cart_to_purchase_dropoff FROM base""",
        "baseline_export": baseline_5m,
        "baseline_last_row": f"""WITH {_EVENTS}, cells AS (
            SELECT product_id, {_bucket('1 day')} AS window_start, {_COUNTS} FROM ev GROUP BY ALL)
            SELECT product_id, views, carts, removals, purchases, trend_score FROM cells
            QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY window_start DESC) = 1""",
        "event_copies": f"""WITH {_EVENTS}, five AS (SELECT ev.* FROM ev, range(5)), {_baseline('1 day', source='five')}
            SELECT * FROM base""",
        "revenue_by_brand": f"""WITH {_EVENTS} SELECT p_brand AS part_brand, count(*) AS purchases,
            CAST(sum(CAST(price AS DECIMAL(38,12))) AS DOUBLE) AS revenue
            FROM ev LEFT JOIN part ON product_id = CAST(p_partkey AS VARCHAR) WHERE event_type = 'purchase' GROUP BY 1""",
        "revenue_by_product": f"""WITH {_EVENTS} SELECT product_id, count(*) AS purchases,
            CAST(sum(CAST(price AS DECIMAL(38,12))) AS DOUBLE) AS revenue FROM ev WHERE event_type = 'purchase' GROUP BY 1""",
        "event_attributes": f"WITH {_RAW}, {_CATALOGUED} SELECT seq, product_id, category_id, category_code, brand FROM catalogued",
        "revenue_by_own_brand": f"""WITH {_RAW}, {_CATALOGUED} SELECT brand, category_code, count(*) AS purchases,
            CAST(sum(CAST(price AS DECIMAL(38,12))) AS DOUBLE) AS revenue FROM catalogued
            WHERE event_type = 'purchase' GROUP BY ALL""",
        "trailing_product_activity": f"WITH {day}, {_PRODUCTS} SELECT * FROM products",
        "trailing_product_activity_5m": f"WITH {_EVENTS}, {_recent('5 minutes')}, {_PRODUCTS} SELECT * FROM products",
        "trailing_funnel": f"WITH {day}, {_FUNNEL} SELECT * FROM funnel",
        "window_event_totals": f"WITH {day} SELECT event_type, count(*) AS events FROM recent GROUP BY 1",
        "active_sessions": f"WITH {day} SELECT count(DISTINCT session_id) AS active_sessions FROM recent",
        "clock_summary": f"""WITH {day} SELECT max(event_time) AS as_of, max(event_time) - INTERVAL '1 day' AS window_start,
            count(*) AS processed_events_total, (SELECT count(*) FROM recent) AS events_in_window FROM ev""",
        "larger_loss": f"""WITH {day}, {_FUNNEL} SELECT view_to_cart_dropoff, cart_to_purchase_dropoff,
            CASE WHEN cart_to_purchase_dropoff > view_to_cart_dropoff THEN 'cart_to_purchase'
                 WHEN view_to_cart_dropoff > cart_to_purchase_dropoff THEN 'view_to_cart'
                 WHEN view_to_cart_dropoff = cart_to_purchase_dropoff THEN 'equal'
                 WHEN cart_to_purchase_dropoff IS NOT NULL THEN 'cart_to_purchase'
                 WHEN view_to_cart_dropoff IS NOT NULL THEN 'view_to_cart' END AS larger_loss FROM funnel""",
        "top_products": f"WITH {day}, {_PRODUCTS} SELECT * FROM products ORDER BY trend_score DESC, product_id LIMIT 5",
        "trailing_series": _series("1 day"),
        "trailing_series_5m": _series("5 minutes"),
        "serving_merge": f"WITH {_DAY_COMPARED} SELECT * FROM compared",
        "serving_top": f"WITH {_DAY_COMPARED} SELECT removals, {trending_columns} FROM compared {_RANK} LIMIT 5",
        "serving_candidates": f"""WITH {_DAY_COMPARED} SELECT removals, {trending_columns} FROM
            (SELECT * FROM compared ORDER BY trend_score DESC, product_id LIMIT 20) {_RANK} LIMIT 10""",
        "threshold_sensitivity": f"WITH {_DAY_COMPARED} {sensitivity}",
        "trending_now": f"WITH {_DAY_COMPARED} SELECT removals, {trending_columns} FROM compared {_RANK} LIMIT 5",
        "snapshot_document": f"""WITH {day}, {_PRODUCTS}, {_FUNNEL}, {_signals('5 days')}, latest AS ({_LATEST})
            SELECT (SELECT max(event_time) FROM ev) AS as_of, CAST(86400 AS BIGINT) AS window_seconds,
              (SELECT max(event_time) - INTERVAL '1 day' FROM ev) AS window_start,
              (SELECT count(*) FROM recent) AS events_in_window, (SELECT count(*) FROM ev) AS processed_events_total,
              active_sessions, (SELECT count(*) FROM pending) AS pending_carts,
              (SELECT count(*) FROM signals) AS abandoned_cart_signals_total,
              view_sessions, cart_sessions, purchase_sessions, view_to_cart_dropoff, cart_to_purchase_dropoff,
              (SELECT count(*) FROM recent WHERE event_type = 'view') AS total_view,
              (SELECT count(*) FROM recent WHERE event_type = 'cart') AS total_cart,
              (SELECT count(*) FROM recent WHERE event_type = 'remove_from_cart') AS total_remove_from_cart,
              (SELECT count(*) FROM recent WHERE event_type = 'purchase') AS total_purchase,
              (SELECT string_agg(product_id, ',' ORDER BY trend_score DESC, product_id) FROM
                (SELECT * FROM products ORDER BY trend_score DESC, product_id LIMIT 5)) AS top_product_ids,
              (SELECT string_agg(session_id, ',' ORDER BY detected_at, cart_time, session_id, product_id) FROM latest) AS latest_session_ids
            FROM funnel""",
        "serving_document": f"""WITH {_DAY_COMPARED}, {_FUNNEL}, {_signals('5 days')},
            candidates AS (SELECT * FROM compared ORDER BY trend_score DESC, product_id LIMIT 5)
            SELECT (SELECT max(event_time) FROM ev) AS as_of,
              'Unusually trending means current score is at least 2x its historical five-minute average.' AS definition,
              (SELECT count(*) FROM signals) AS abandoned_cart_signals_total, (SELECT count(*) FROM recent) AS events_in_window,
              (SELECT count(*) FROM ev) AS processed_events_total, (SELECT view_to_cart_dropoff FROM funnel) AS view_to_cart_dropoff,
              CAST(row_number() OVER ({_RANK}) - 1 AS INTEGER) AS place, {trending_columns} FROM candidates""",
        "minute_product_buckets": f"""WITH {_EVENTS}, {_MINUTES}
            SELECT bucket, product_id, views, carts, removals, purchases, expires_at, updated_at FROM buckets""",
        "minute_health": f"WITH {_EVENTS}, {_HEALTH} SELECT *, CAST(latency_total_ms AS DOUBLE) / event_count AS latency_mean_ms FROM health",
        "bucket_keys": f"""WITH {_EVENTS}, {_MINUTES} SELECT 'WINDOW#' || strftime(bucket, '%Y-%m-%dT%H:%M:%S+00:00') AS PK,
            'PRODUCT#' || product_id AS SK, views AS "Views", carts AS "Carts", removals AS "Removals",
            purchases AS "Purchases", expires_at AS "ExpiresAt" FROM buckets""",
        "health_keys": f"""WITH {_EVENTS}, {_HEALTH} SELECT 'WINDOW#' || strftime(bucket, '%Y-%m-%dT%H:%M:%S+00:00') AS PK,
            concat_ws('#', 'HEALTH', experiment_id) AS SK, event_count AS "EventCount",
            latency_total_ms AS "LatencyTotalMs", expires_at AS "ExpiresAt" FROM health""",
        "five_bucket_view": f"""WITH {_EVENTS}, {_MINUTES} SELECT product_id, {_MINUTE_TOTALS} FROM buckets
            WHERE bucket > (SELECT max(bucket) - INTERVAL '5 minutes' FROM buckets) GROUP BY 1""",
        "day_bucket_view": f"""WITH {_EVENTS}, {_MINUTES} SELECT product_id, {_MINUTE_TOTALS} FROM buckets
            WHERE bucket > (SELECT max(bucket) - INTERVAL '1 day' FROM buckets) GROUP BY 1""",
        "hopping_view": f"""WITH {_EVENTS}, {_hops('[0, 1, 2, 3, 4]', '1 minute', '5 minutes')}
            SELECT window_start, window_end, product_id, {_COUNTS} FROM hops GROUP BY ALL""",
        "retained_buckets": f"""WITH {_EVENTS}, {_MINUTES} SELECT bucket, product_id, views, carts, removals, purchases,
            expires_at, updated_at FROM buckets WHERE expires_at > epoch_us(TIMESTAMP '2024-01-20 00:00:00') // 1000000""",
        "abandoned_carts": f"WITH {long_signals} SELECT {signal_columns} FROM signals",
        "abandoned_carts_15m": f"WITH {_EVENTS}, {_signals('15 minutes')} SELECT {signal_columns} FROM signals",
        "abandoned_carts_flush": f"WITH {_EVENTS}, {_signals('5 days', flush=True)} SELECT {signal_columns} FROM signals",
        "overdue_carts": f"WITH {long_signals} SELECT session_id, product_id, cart_time, deadline FROM signals",
        "pending_carts": f"WITH {long_signals} SELECT * FROM pending",
        "latest_signals": f"WITH {long_signals} {_LATEST}",
        "latency_log_parse": f"""WITH {_EVENTS} SELECT experiment_id, CAST(round(price * 1000) AS BIGINT) AS latency_ms
            FROM ev WHERE experiment_id = 'run-3'""",
        "latency_stats": f"""WITH {_EVENTS}, sorted AS (
              SELECT coalesce(experiment_id, 'unlabelled') AS experiment_id, CAST(round(price * 1000) AS BIGINT) AS latency_ms,
                row_number() OVER (PARTITION BY experiment_id ORDER BY price) - 1 AS i,
                count(*) OVER (PARTITION BY experiment_id) AS n FROM ev),
            picked AS (SELECT experiment_id, count(*) AS processed, CAST(sum(latency_ms) AS DOUBLE) / count(*) AS avg_latency_ms,
              {_percentile("0.5::DOUBLE", 'p50')}, {_percentile("0.95::DOUBLE", 'p95')}, max(latency_ms) AS max_latency_ms FROM sorted GROUP BY 1)
            SELECT experiment_id, processed, avg_latency_ms, coalesce(p50_exact, p50_mixed) AS p50_latency_ms,
              coalesce(p95_exact, p95_mixed) AS p95_latency_ms, max_latency_ms FROM picked""",
        "backlog_age": f"""WITH {_EVENTS} SELECT date_trunc('minute', processed_at) AS minute,
            max((epoch_us(processed_at) - epoch_us(event_time)) // 1000) AS max_age_ms FROM ev GROUP BY 1""",
        "largest_backlog_age": f"""WITH {_EVENTS} SELECT max((epoch_us(processed_at) - epoch_us(event_time)) // 1000)
            AS max_iterator_age_ms FROM ev""",
        "load_run_throughput": f"WITH {_RUNS} SELECT experiment_id, sent_records, producer_seconds, producer_throughput_eps FROM runs",
        "load_run_summary": f"""WITH {_RUNS} SELECT target_rate_eps, count(*) AS complete_runs,
            {_median('p50_latency_ms')} AS p50_latency_ms, {_median('p95_latency_ms')} AS p95_latency_ms,
            {_median('producer_throughput_eps')} AS producer_throughput_eps FROM complete GROUP BY 1""",
        "load_run_csv": f"WITH {_RUNS} SELECT experiment_id, target_rate_eps, sent_records, completed_at_utc FROM complete",
        "throughput_over_time": f"""WITH {_RUNS} SELECT experiment_id, completed_at_utc, (epoch_us(completed_at_utc)
            - (SELECT epoch_us(min(completed_at_utc)) FROM complete)) / 6e7 AS elapsed_minutes, producer_throughput_eps FROM complete""",
        "worker_speedup": f"""WITH medians AS (SELECT l_linenumber AS worker_count, count(*) AS trials,
              {_median('l_extendedprice')} AS median_seconds FROM lineitem
              WHERE l_linestatus = 'F' AND l_linenumber > 0 AND l_extendedprice > 0 GROUP BY 1),
            curve AS (SELECT *, (SELECT arg_min(median_seconds, worker_count) FROM medians) / median_seconds AS speedup,
              CAST(worker_count AS DOUBLE) / (SELECT min(worker_count) FROM medians) AS ideal_speedup FROM medians)
            SELECT *, speedup / ideal_speedup AS efficiency FROM curve WHERE (SELECT count(*) FROM medians) >= 2""",
        "scaling_changes": f"""WITH {_SAMPLES} SELECT * FROM (SELECT *, lag(total_workers) OVER (ORDER BY elapsed_seconds)
            AS previous_workers FROM samples) WHERE previous_workers <> total_workers""",
        "scaling_observed": f"""WITH {_SAMPLES} SELECT count(DISTINCT total_workers) AS distinct_worker_counts,
            count(DISTINCT total_workers) > 1 AS scaling_observed FROM samples""",
        "stream_minute_buckets": f"""WITH {_EVENTS} SELECT date_trunc('minute', event_time) AS bucket, product_id,
            count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'cart') AS carts,
            count(*) FILTER (event_type = 'remove_from_cart') AS removals, count(*) FILTER (event_type = 'purchase') AS purchases,
            (epoch_us(max(event_time)) + 172800000000) // 1000000 AS expires_at, max(processed_at) AS updated_at FROM ev GROUP BY ALL""",
        "stream_live_table": f"WITH {_EVENTS}, {_MINUTES}, {_KEPT} SELECT bucket, product_id, views, carts, removals, purchases, expires_at, updated_at FROM kept",
        "stream_live_top": f"""WITH {_EVENTS}, {_MINUTES}, {_KEPT},
            products AS (SELECT product_id, {_MINUTE_TOTALS} FROM kept
              WHERE bucket > (SELECT max(bucket) - INTERVAL '1 day' FROM kept) GROUP BY 1),
            {_baseline('1 day')}, {_COMPARED}
            SELECT product_id, views, carts, purchases, trend_score, activity_lift, is_unusually_trending
            FROM compared {_RANK} LIMIT 5""",
        "stream_minute_health": f"WITH {_EVENTS}, {_HEALTH} SELECT * FROM health",
        "stream_hopping_trend": f"""WITH {_EVENTS}, {_hops('[0, 1, 2, 3, 4]', '1 minute', '5 minutes')}
            SELECT window_start, window_end, product_id, {_COUNTS} FROM hops GROUP BY ALL""",
        "stream_funnel": f"""WITH {_EVENTS}, {_hops('[0, 1, 2, 3]', '6 hours', '1 day')},
            stage_row AS (SELECT window_start, window_end, {_STAGES}, count(DISTINCT session_id) AS active_sessions
              FROM hops GROUP BY ALL)
            SELECT *, {_DROPS} FROM stage_row""",
        "stream_abandonment": f"""WITH {_EVENTS}, {_signals('5 days', flush=True)}
            SELECT session_id, product_id, cart_time, deadline FROM signals""",
        "stream_signals": f"WITH {long_signals} SELECT {signal_columns} FROM signals",
        "stream_cart_counters": f"""WITH {long_signals} SELECT (SELECT count(*) FROM pending) AS pending_carts,
            (SELECT count(*) FROM signals) AS abandoned_cart_signals_total,
            (SELECT count(*) FROM pending) AS pending_rows, (SELECT max(deadline) FROM pending) AS last_deadline""",
        "stream_dedup": f"""WITH {_EVENTS}, {_hops('[0]', '10 minutes', '10 minutes')}
            SELECT window_start, window_end, product_id, {_COUNTS} FROM hops GROUP BY ALL""",
        "stream_late": f"""WITH {_EVENTS} SELECT seq, event_time, product_id, session_id FROM ev l
            WHERE event_time < (SELECT max(event_time) FROM ev e WHERE e.seq % 3 < l.seq % 3) - INTERVAL '2 days'""",
        "stream_route": """SELECT event_id AS seq, CASE WHEN event_type IN ('view', 'purchase') THEN 'accepted' ELSE 'rejected' END AS status,
            CASE WHEN event_type IN ('view', 'purchase') THEN NULL ELSE 'unsupported event_type' END AS reject_reason FROM events""",
        "stream_redrive": """SELECT event_id AS seq, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS product_id,
            CASE event_type WHEN 'click' THEN 'cart' WHEN 'view' THEN 'view' WHEN 'purchase' THEN 'purchase' END AS event_type,
            CASE WHEN event_type IN ('view', 'purchase') THEN 'accepted' WHEN event_type = 'click' THEN 'promoted' ELSE 'buried' END AS status,
            CASE WHEN event_type IN ('view', 'purchase') THEN 1 ELSE 2 END AS attempts,
            CASE WHEN event_type NOT IN ('view', 'purchase', 'click') THEN 'unsupported event_type' END AS reject_reason FROM events""",
        "stream_archive": f"WITH {_EVENTS} SELECT seq, {_CLEAN}, strftime(event_time, '%Y-%m-%d') AS event_date FROM ev",
        "stream_serving": f"""WITH {_EVENTS}, {_baseline('1 day')}, {_hops('[0]', '1 day', '1 day')},
            products AS (SELECT window_end, product_id, {_COUNTS} FROM hops GROUP BY ALL), {_COMPARED}
            SELECT window_end, CAST(row_number() OVER w AS INTEGER) AS rank, product_id, trend_score, activity_lift,
              is_unusually_trending FROM compared
            WINDOW w AS (PARTITION BY window_end {_RANK}) QUALIFY row_number() OVER w <= 5""",
    }
    return found | {"stream_latency_stats": found["latency_stats"]}
