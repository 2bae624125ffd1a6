"""Stateful views. Input: valid events on a clock (``inputs.on_clock``).

All state is ended by the watermark, and every aggregation combines before its exchange,
so a hot product, session or minute reaches its reducer as one partial row per task.
"""

from pyspark.sql import DataFrame, functions as F

from cartpulse.functions.metrics import current_dropoff, stage_counts, trend_score
from cartpulse.functions.timebuckets import expires_at, interval, latency_ms, micros_of
from cartpulse.operators.abandonment import ACTIONS, PAIR, ends_with_cart, last_cart_columns
from cartpulse.schema import ABANDONMENT_TIMEOUT, BUCKET, RETENTION, WINDOW

_KINDS = ("view", "cart", "purchase")


def _counted(events: DataFrame) -> DataFrame:
    """Without closing rows. The condition names event_time, so that the optimizer leaves the filter
    above the watermark and the rows do move the clock."""
    return events.filter(F.when(F.col("event_time").isNotNull(), F.col("event_type").isNotNull()))


def _hop(window: str, step: str):
    return F.window("event_time", window, step)


def minute_counters(events: DataFrame, retention: str = RETENTION) -> DataFrame:
    """Counters per minute and product; run in update mode, rows carry absolute totals."""
    updated = F.max("processed_at") if "processed_at" in events.columns else F.max("event_time")
    return (
        _counted(events).groupBy(F.window("event_time", BUCKET).alias("w"), "product_id")
        .agg(
            *stage_counts(F.col("event_type")),
            expires_at(F.max("event_time"), retention).alias("expires_at"),
            updated.alias("updated_at"),
        )
        .select(F.col("w.start").alias("bucket"), "*")
        .drop("w")
    )


def minute_health(events: DataFrame, retention: str = RETENTION) -> DataFrame:
    """Event count and latency per minute and experiment; needs ``processed_at``."""
    return (
        _counted(events).withColumn("experiment_id", F.nullif("experiment_id", F.lit("")))
        .withColumn("latency_ms", latency_ms(F.col("processed_at"), F.col("event_time")))
        .groupBy(F.window("event_time", BUCKET).alias("w"), "experiment_id")
        .agg(
            F.count("*").alias("event_count"),
            F.sum("latency_ms").alias("latency_total_ms"),
            expires_at(F.max("event_time"), retention).alias("expires_at"),
            F.max("processed_at").alias("updated_at"),
        )
        .select(F.col("w.start").alias("bucket"), "*")
        .drop("w")
    )


def hopping_trend(events: DataFrame, window: str = WINDOW, step: str = "1 minute") -> DataFrame:
    """Product activity of every five-minute window, final once the window is closed."""
    return (
        _counted(events).groupBy(_hop(window, step).alias("w"), "product_id")
        .agg(*stage_counts(F.col("event_type")))
        .withColumn("trend_score", trend_score(F.col("views"), F.col("carts"), F.col("purchases")))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*")
        .drop("w")
    )


def session_funnel(events: DataFrame, window: str = WINDOW, step: str = "1 minute") -> DataFrame:
    """Distinct sessions per stage and window: sessions to flags, flags to counts, two
    stateful steps in one append-mode query."""
    flags = _counted(events).groupBy(_hop(window, step), "session_id").agg(
        *[F.max(F.col("event_type") == kind).alias(kind) for kind in _KINDS]
    )
    stages = flags.groupBy("window").agg(
        *[F.count_if(F.col(kind)).alias(f"{kind}_sessions") for kind in _KINDS],
        F.count("*").alias("active_sessions"),
    )
    return stages.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[f"{kind}_sessions" for kind in _KINDS],
        "active_sessions",
        current_dropoff(F.col("view_sessions"), F.col("cart_sessions")).alias("view_to_cart_dropoff"),
        current_dropoff(F.col("cart_sessions"), F.col("purchase_sessions")).alias(
            "cart_to_purchase_dropoff"
        ),
    )


def abandoned_carts(events: DataFrame, timeout: str = ABANDONMENT_TIMEOUT) -> DataFrame:
    """Abandonment signals, each once, as soon as the clock passes the deadline.

    The actions of a (session, product) pair form session windows that end when nothing
    happens for one timeout; a window that ends with a cart is an abandoned cart. The gap
    is one microsecond short of the timeout because an action exactly at the deadline
    comes too late, whereas Spark joins touching windows. Sessions are merged inside each
    task before the exchange (see ``session.RUNTIME_SETTINGS``).
    """
    # Conditional on event_time, so that the optimizer leaves the filter above the
    # watermark: views are not actions, but they do move the clock.
    action = F.when(
        F.col("event_time").isNotNull(),
        F.col("event_type").isin(*ACTIONS),
    )
    gap = f"{micros_of(timeout) - 1} microseconds"
    return (
        events.filter(action)
        .groupBy(F.session_window("event_time", gap), *PAIR)
        .agg(*last_cart_columns())
        .filter(ends_with_cart())
        .select(*PAIR, "cart_time", (F.col("cart_time") + interval(timeout)).alias("deadline"))
    )
