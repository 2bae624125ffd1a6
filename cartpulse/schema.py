"""Canonical event schema and the fixed values every layer agrees on."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. Results only agree with other producers and consumers of the
# same events when these stay as they are.
# ---------------------------------------------------------------------------
EVENT_TYPES = ("view", "cart", "remove_from_cart", "purchase")

EVENT_TYPE_ALIASES = {
    "view": ("view",),
    "cart": ("addtocart", "add_to_cart", "cart"),
    "remove_from_cart": ("removefromcart", "remove_from_cart"),
    "purchase": ("transaction", "purchase"),
}

REQUIRED_CSV_COLUMNS = ("event_time", "event_type", "product_id", "user_id", "user_session")

VIEW_WEIGHT, CART_WEIGHT, PURCHASE_WEIGHT = 1, 3, 5
UNUSUAL_LIFT = 2.0
WINDOW = "5 minutes"
BUCKET = "1 minute"
ABANDONMENT_TIMEOUT = "15 minutes"
RETENTION = "48 hours"
TOP_N = 5
LATEST_SIGNALS = 10
MILLISECOND_EPOCH_FLOOR = 10_000_000_000  # digits above this are milliseconds
UNLABELLED = "unlabelled"
LATENCY_METRIC = "processing_latency"
DEFINITION = (
    "Unusually trending means current score is at least 2x its historical five-minute average."
)
# ---------------------------------------------------------------------------

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("source_event_time", T.TimestampType()),
    ]
)
EVENT_COLUMNS = tuple(EVENT_SCHEMA.fieldNames())

# The canonical JSON payload before parsing: every field as text, so a number
# where text is expected (or the reverse) is judged by the cleaning rules and
# not silently nulled by the reader.
JSON_TEXT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in (*EVENT_COLUMNS, "experiment_id")]
)

BASELINE_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("avg_views_5m", T.DoubleType()),
        T.StructField("avg_carts_5m", T.DoubleType()),
        T.StructField("avg_purchases_5m", T.DoubleType()),
        T.StructField("avg_trend_score_5m", T.DoubleType()),
        T.StructField("total_views", T.LongType()),
        T.StructField("total_carts", T.LongType()),
        T.StructField("total_purchases", T.LongType()),
        T.StructField("observed_5m_windows", T.LongType()),
        T.StructField("view_sessions", T.LongType()),
        T.StructField("cart_sessions", T.LongType()),
        T.StructField("purchase_sessions", T.LongType()),
        T.StructField("historical_view_to_cart_dropoff", T.DoubleType()),
        T.StructField("historical_cart_to_purchase_dropoff", T.DoubleType()),
    ]
)

_PRODUCT = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("trend_score", T.LongType()),
        T.StructField("views", T.LongType()),
        T.StructField("carts", T.LongType()),
        T.StructField("purchases", T.LongType()),
    ]
)
_FUNNEL = T.StructType(
    [
        T.StructField("view_sessions", T.LongType()),
        T.StructField("cart_sessions", T.LongType()),
        T.StructField("purchase_sessions", T.LongType()),
        T.StructField("view_to_cart_dropoff", T.DoubleType()),
        T.StructField("cart_to_purchase_dropoff", T.DoubleType()),
    ]
)
_SIGNAL = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("cart_time", T.TimestampType()),
        T.StructField("detected_at", T.TimestampType()),
    ]
)
SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("as_of", T.TimestampType()),
        T.StructField("window_seconds", T.LongType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("events_in_window", T.LongType()),
        T.StructField("processed_events_total", T.LongType()),
        T.StructField("active_sessions", T.LongType()),
        T.StructField("event_totals", T.MapType(T.StringType(), T.LongType())),
        T.StructField("top_products", T.ArrayType(_PRODUCT)),
        T.StructField("funnel", _FUNNEL),
        T.StructField("pending_carts", T.LongType()),
        T.StructField("abandoned_cart_signals_total", T.LongType()),
        T.StructField("latest_abandoned_carts", T.ArrayType(_SIGNAL)),
    ]
)

LOAD_RUN_SCHEMA = T.StructType(
    [
        T.StructField("experiment_id", T.StringType()),
        T.StructField("started_at_utc", T.TimestampType()),
        T.StructField("completed_at_utc", T.TimestampType()),
        T.StructField("target_rate_eps", T.IntegerType()),
        T.StructField("repeat", T.IntegerType()),
        T.StructField("sent_records", T.LongType()),
        T.StructField("processed_records", T.LongType()),
        T.StructField("producer_seconds", T.DoubleType()),
        T.StructField("producer_throughput_eps", T.DoubleType()),
        T.StructField("avg_latency_ms", T.DoubleType()),
        T.StructField("p50_latency_ms", T.DoubleType()),
        T.StructField("p95_latency_ms", T.DoubleType()),
        T.StructField("max_latency_ms", T.DoubleType()),
        T.StructField("max_iterator_age_ms", T.DoubleType()),
        T.StructField("query_status", T.StringType()),
    ]
)

WORKER_TRIAL_SCHEMA = T.StructType(
    [
        T.StructField("worker_count", T.IntegerType()),
        T.StructField("repeat", T.IntegerType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("input_events", T.LongType()),
        T.StructField("partitions", T.IntegerType()),
    ]
)

BATCH_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("configuration", T.StringType()),
        T.StructField("partitions", T.IntegerType()),
        T.StructField("initial_workers", T.IntegerType()),
        T.StructField("input_events", T.LongType()),
        T.StructField("input_size_mb", T.IntegerType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("speedup", T.DoubleType()),
    ]
)

WORKER_SAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("timestamp_utc", T.TimestampType()),
        T.StructField("elapsed_seconds", T.LongType()),
        T.StructField("core_workers", T.IntegerType()),
        T.StructField("task_workers", T.IntegerType()),
        T.StructField("total_workers", T.IntegerType()),
    ]
)
