"""Export forms of events: JSON lines, keyed records, latency log lines."""

from pyspark.sql import Column, DataFrame, functions as F

from cartpulse.functions.timebuckets import latency_ms, utc_text
from cartpulse.schema import EVENT_COLUMNS, LATENCY_METRIC, UNLABELLED

_TIMES = ("event_time", "source_event_time")


def payload(experiment_id: str | None = None) -> Column:
    """Canonical event as compact JSON, fields in canonical order, nulls written out,
    times in ISO form; ``experiment_id`` is added only when given."""
    fields = [(utc_text(F.col(c)) if c in _TIMES else F.col(c)).alias(c) for c in EVENT_COLUMNS]
    if experiment_id:
        fields.append(F.lit(experiment_id).alias("experiment_id"))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def write_json_lines(events: DataFrame, path: str, order: tuple[str, ...] = ()) -> None:
    """One event per line. ``order`` (say event_time, seq) makes the lines run in that
    order within and across the files; end it with a unique column, so that events that
    share a moment can still be spread over files."""
    if order:
        events = events.repartitionByRange(*order).sortWithinPartitions(*order)
    events.select(payload().alias("value")).write.mode("overwrite").text(path)


def keyed_records(events: DataFrame, experiment_id: str | None = None) -> DataFrame:
    """Records for a keyed stream: the session is the key, so a session stays in order."""
    return events.select(
        F.col("session_id").alias("key"),
        F.concat(payload(experiment_id), F.lit("\n")).alias("value"),
    )


def write_keyed_files(events: DataFrame, path: str, experiment_id: str | None = None) -> None:
    """Keyed records as files, each session in time order across consecutive files.

    Range partitioning on (session, time, seq) keeps the order without forcing a session
    into one task, however large it is.
    """
    order = ("session_id", "event_time", "seq")
    ordered = events.repartitionByRange(*order).sortWithinPartitions(*order)
    keyed_records(ordered, experiment_id).write.mode("overwrite").parquet(path)


def latency_line() -> Column:
    """One structured log line per event."""
    return F.to_json(
        F.struct(
            F.lit(LATENCY_METRIC).alias("metric"),
            F.coalesce(F.nullif("experiment_id", F.lit("")), F.lit(UNLABELLED)).alias("experiment_id"),
            latency_ms(F.col("processed_at"), F.col("event_time")).alias("latency_ms"),
            "event_type",
        )
    )


def bucket_keys(product_buckets: DataFrame) -> DataFrame:
    """Export of product buckets under composite text keys."""
    bucket = utc_text(F.col("bucket"))
    return product_buckets.select(
        F.concat_ws("#", F.lit("WINDOW"), bucket).alias("PK"),
        F.concat_ws("#", F.lit("PRODUCT"), "product_id").alias("SK"),
        F.col("views").alias("Views"),
        F.col("carts").alias("Carts"),
        F.col("removals").alias("Removals"),
        F.col("purchases").alias("Purchases"),
        F.col("expires_at").alias("ExpiresAt"),
    )


def health_keys(health_buckets: DataFrame) -> DataFrame:
    """Export of health buckets; the experiment is part of the key only where there is one."""
    return health_buckets.select(
        F.concat_ws("#", F.lit("WINDOW"), utc_text(F.col("bucket"))).alias("PK"),
        F.concat_ws("#", F.lit("HEALTH"), F.nullif("experiment_id", F.lit(""))).alias("SK"),
        F.col("event_count").alias("EventCount"),
        F.col("latency_total_ms").alias("LatencyTotalMs"),
        F.col("expires_at").alias("ExpiresAt"),
    )
