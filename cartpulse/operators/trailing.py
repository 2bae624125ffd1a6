"""The trailing window: product activity, session funnel and totals at one moment."""

from pyspark.sql import Column, DataFrame, functions as F

from cartpulse.functions.metrics import (
    current_dropoff,
    larger_loss,
    stage_counts,
    trend_score,
)
from cartpulse.functions.timebuckets import interval
from cartpulse.schema import TOP_N, WINDOW


def in_window(events: DataFrame, window: str = WINDOW, as_of: Column | None = None) -> DataFrame:
    """Events with ``as_of - window <= event_time <= as_of``, both ends included.

    Without ``as_of`` the clock is the last event. It is then a scalar subquery, so
    the bound is a plain comparison that stored tables can use to skip row groups. Where the
    events come with their date, the clock is sought in the newest date only, and the
    window reads only the dates it covers.
    """
    time = F.col("event_time")
    if as_of is None:
        dated = "event_date" in events.columns
        newest = events
        if dated:
            newest = events.filter(F.col("event_date") >= events.agg(F.max("event_date")).scalar())
        start = newest.agg((F.max("event_time") - interval(window)).alias("start")).scalar()
        if dated:
            events = events.filter(F.col("event_date") >= F.to_date(start))
        return events.filter(time >= start)
    return events.filter((time >= as_of - interval(window)) & (time <= as_of))


def product_counts(recent: DataFrame) -> DataFrame:
    """Counts and score per product. A product with only removals stays, with score 0."""
    counts = recent.groupBy("product_id").agg(*stage_counts(F.col("event_type")))
    return counts.withColumn(
        "trend_score", trend_score(F.col("views"), F.col("carts"), F.col("purchases"))
    )


def top_products(counts: DataFrame, n: int = TOP_N) -> DataFrame:
    """The ``n`` highest scores; equal scores in text order of the product."""
    return counts.orderBy(F.desc("trend_score"), F.asc("product_id")).limit(n)


def session_flags(recent: DataFrame) -> DataFrame:
    """Which stages each active session reached, in any order."""
    return recent.groupBy("session_id").agg(
        *[F.max(F.col("event_type") == k).alias(k) for k in ("view", "cart", "purchase")]
    )


def funnel(flags: DataFrame) -> DataFrame:
    """One row: sessions per stage, active sessions, and both drop-offs."""
    stages = flags.agg(
        *[F.count_if(F.col(k)).alias(f"{k}_sessions") for k in ("view", "cart", "purchase")],
        F.count("*").alias("active_sessions"),
    )
    return stages.withColumns(
        {
            "view_to_cart_dropoff": current_dropoff(F.col("view_sessions"), F.col("cart_sessions")),
            "cart_to_purchase_dropoff": current_dropoff(
                F.col("cart_sessions"), F.col("purchase_sessions")
            ),
        }
    )


def with_larger_loss(funnel_row: DataFrame) -> DataFrame:
    return funnel_row.withColumn(
        "larger_loss",
        larger_loss(F.col("view_to_cart_dropoff"), F.col("cart_to_purchase_dropoff")),
    )


def event_totals(recent: DataFrame) -> DataFrame:
    """Events per type; a type without events has no row."""
    return recent.groupBy("event_type").agg(F.count("*").alias("events"))


def clock_summary(events: DataFrame, window: str = WINDOW, as_of: Column | None = None) -> DataFrame:
    """One row: the clock, the window start, events in the window and events so far."""
    start = in_window(events, window, as_of).agg(F.count("*"))
    now = F.max("event_time") if as_of is None else as_of
    seen = events if as_of is None else events.filter(F.col("event_time") <= as_of)
    return seen.agg(
        now.alias("as_of"),
        (now - interval(window)).alias("window_start"),
        F.count("*").alias("processed_events_total"),
    ).withColumn("events_in_window", start.scalar())
