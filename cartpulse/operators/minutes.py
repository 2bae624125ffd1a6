"""One-minute buckets: product counters, processing health, and views over them."""

from pyspark.sql import Column, DataFrame, functions as F

from cartpulse.functions.metrics import stage_counts, trend_score
from cartpulse.functions.timebuckets import expires_at, interval, latency_ms, minute_of
from cartpulse.schema import RETENTION, UNLABELLED, WINDOW

COUNTERS = ("views", "carts", "removals", "purchases")


def product_minutes(events: DataFrame, retention: str = RETENTION) -> DataFrame:
    """Counters per minute and product. Expiry follows the latest event of the bucket;
    ``updated_at`` is the latest processing time where the events carry one."""
    updated = F.max("processed_at") if "processed_at" in events.columns else F.max("event_time")
    return events.groupBy(minute_of(F.col("event_time")).alias("bucket"), "product_id").agg(
        *stage_counts(F.col("event_type")),
        expires_at(F.max("event_time"), retention).alias("expires_at"),
        updated.alias("updated_at"),
    )


def health_minutes(events: DataFrame, retention: str = RETENTION) -> DataFrame:
    """Event count and latency per minute and experiment; needs ``processed_at`` and
    ``experiment_id`` (null or empty = not part of an experiment)."""
    labelled = events.withColumn("experiment_id", F.nullif("experiment_id", F.lit("")))
    measured = labelled.withColumn("latency_ms", latency_ms(F.col("processed_at"), F.col("event_time")))
    return (
        measured.groupBy(minute_of(F.col("event_time")).alias("bucket"), "experiment_id")
        .agg(
            F.count("*").alias("event_count"),
            F.sum("latency_ms").alias("latency_total_ms"),
            expires_at(F.max("event_time"), retention).alias("expires_at"),
            F.max("processed_at").alias("updated_at"),
        )
        .withColumn("latency_mean_ms", F.col("latency_total_ms") / F.col("event_count"))
    )


def latency_records(events: DataFrame) -> DataFrame:
    """One latency record per event, labelled with its experiment."""
    return events.select(
        F.coalesce(F.nullif("experiment_id", F.lit("")), F.lit(UNLABELLED)).alias("experiment_id"),
        latency_ms(F.col("processed_at"), F.col("event_time")).alias("latency_ms"),
        "event_type",
    )


def retained(buckets: DataFrame, now: Column) -> DataFrame:
    """Buckets whose expiry (epoch seconds) is still ahead."""
    return buckets.filter(F.col("expires_at") > F.unix_seconds(now))


def _activity(grouped) -> DataFrame:
    return grouped.agg(*[F.sum(c).alias(c) for c in COUNTERS]).withColumn(
        "trend_score", trend_score(F.col("views"), F.col("carts"), F.col("purchases"))
    )


def latest_buckets_view(
    buckets: DataFrame, as_of: Column | None = None, window: str = WINDOW
) -> DataFrame:
    """Product activity of the last five minute buckets, the current one included."""
    if as_of is None:
        start = buckets.agg((F.max("bucket") - interval(window)).alias("start")).scalar()
        recent = buckets.filter(F.col("bucket") > start)
    else:
        minute = minute_of(as_of)
        recent = buckets.filter(
            (F.col("bucket") > minute - interval(window)) & (F.col("bucket") <= minute)
        )
    return _activity(recent.groupBy("product_id"))


def hopping_view(buckets: DataFrame, window: str = WINDOW, step: str = "1 minute") -> DataFrame:
    """Product activity of every five-minute window on the minute grid. Built from the
    buckets, so only one row per minute and product is copied into its windows."""
    return _activity(
        buckets.groupBy(F.window("bucket", window, step).alias("w"), "product_id")
    ).select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "product_id",
        *COUNTERS,
        "trend_score",
    )
