"""Every operator run over the sample tables, one query per name.

The sample events are sparse, so next to the default parameters most queries also use a
one-day window or a five-day timeout.
"""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cartpulse import schema, session
from cartpulse.operators import (
    abandonment, baseline, experiments, minutes, normalise, ordered, quality, replay, revenue,
    series, serving, trailing,
)
from cartpulse.plans import documents
from cartpulse.sinks import payloads, tables
from cartpulse.sources import files, records, sample_tables as sample
from cartpulse.streaming import inputs, livetable, outputs, signals, views

DAY = "1 day"
LONG_TIMEOUT = "5 days"
REPLAY_START = "2030-01-01 00:00:00"
RETENTION_NOW = "2024-01-20 00:00:00"
THRESHOLDS = [1.0, 1.5, 2.0, 2.5, 3.0, 5.0]
_CLEAN = ("event_time", "event_type", "product_id", "user_id", "session_id", "price")


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the tables have them."""
    casts = {
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in df.schema.fields
        if f.dataType.typeName() == "timestamp"
    }
    return df.withColumns(casts) if casts else df


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp")


# --- ingest ---------------------------------------------------------------------------


def _interpreted(spark, sf_dir):
    return normalise.interpret_shop_rows(sample.raw_rows(spark, sf_dir))


def event_normalise(spark, sf_dir):
    return normalise.accepted(_interpreted(spark, sf_dir)).select("seq", *_CLEAN, "source_event_time")


def rejected_events(spark, sf_dir):
    return normalise.rejected(_interpreted(spark, sf_dir)).select("seq", "reason")


def ingest_quality(spark, sf_dir):
    return quality.ingest_summary(_interpreted(spark, sf_dir))


def ingest_reasons(spark, sf_dir):
    return quality.reject_reasons(_interpreted(spark, sf_dir))


def usable_events(spark, sf_dir):
    return normalise.usable(sample.shop_events(spark, sf_dir)).select("seq", *_CLEAN)


def source_row_limit(spark, sf_dir):
    first = replay.limit_source_rows(sample.raw_rows(spark, sf_dir), 1000)
    return quality.reject_reasons(normalise.interpret_shop_rows(first))


def csv_ingest(spark, sf_dir):
    path = session.scratch_path(spark, "csv")
    sample.raw_rows(spark, sf_dir).drop("seq").write.option("header", True).csv(path)
    return normalise.accepted(files.read_shop_csv(spark, path)).select(*_CLEAN)


def csv_rejects(spark, sf_dir):
    path = session.scratch_path(spark, "csv-gz")
    rows = sample.raw_rows(spark, sf_dir).drop("seq")
    rows.write.option("header", True).option("compression", "gzip").csv(path)
    return quality.reject_reasons(files.read_shop_csv(spark, path))


def jsonl_roundtrip(spark, sf_dir):
    path = session.scratch_path(spark, "jsonl")
    payloads.write_json_lines(sample.shop_events(spark, sf_dir), path)
    strict = normalise.accepted(files.read_payload_lines(spark, path), on_invalid="fail")
    return strict.select(*_CLEAN, "source_event_time")


def keyed_record_decode(spark, sf_dir):
    keyed = payloads.keyed_records(sample.shop_events(spark, sf_dir), "trial-1")
    encoded = keyed.select("key", F.base64(F.col("value").cast("binary")).alias("data"))
    return normalise.accepted(records.decode_records(encoded)).select("key", *_CLEAN, "experiment_id")


def keyed_files(spark, sf_dir):
    path = session.scratch_path(spark, "keyed")
    payloads.write_keyed_files(sample.shop_events(spark, sf_dir), path)
    stored = records.decode_records(spark.read.parquet(path), data="value", base64=False)
    return normalise.accepted(stored).groupBy("key").agg(
        F.count("*").alias("events"), F.max("event_time").alias("last_time")
    )


def ingest_files(spark, sf_dir):
    path = session.scratch_path(spark, "ingest")
    tables.write_interpreted(_interpreted(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("status").agg(F.count("*").alias("rows"))


def archive_range(spark, sf_dir):
    path = session.scratch_path(spark, "archive")
    events = sample.shop_events(spark, sf_dir).select(*schema.EVENT_COLUMNS, "experiment_id", "seq")
    tables.write_archive(events, path)
    bounds = dt.datetime(2024, 1, 10, 12, tzinfo=dt.UTC), dt.datetime(2024, 1, 20, tzinfo=dt.UTC)
    return (
        files.read_archive(spark, path, *bounds)
        .groupBy(F.col("event_date").cast("string").alias("event_date"))
        .agg(F.count("*").alias("events"))
    )


def order_violations(spark, sf_dir):
    return ordered.order_violations(sample.order_feed(spark, sf_dir))


def replay_rebase(spark, sf_dir):
    events = sample.shop_events(spark, sf_dir)
    moved = replay.rebase(events, _moment(REPLAY_START), events_per_second=8)
    return moved.select("seq", "event_time", "source_event_time")


def replay_preserve_timing(spark, sf_dir):
    events = sample.shop_events(spark, sf_dir)
    moved = replay.rebase(events, _moment(REPLAY_START), events_per_second=1, preserve_timing=True)
    return moved.select("seq", "event_time", "source_event_time")


# --- batch baseline -------------------------------------------------------------------


def product_window_counts(spark, sf_dir):
    return baseline.window_counts(sample.shop_events(spark, sf_dir))


def product_activity(spark, sf_dir):
    return baseline.product_activity(baseline.window_counts(sample.shop_events(spark, sf_dir)))


def product_session_funnel(spark, sf_dir):
    return baseline.session_funnel(sample.shop_events(spark, sf_dir))


def product_baseline(spark, sf_dir):
    return baseline.baseline(sample.shop_events(spark, sf_dir))


def product_baseline_daily(spark, sf_dir):
    return baseline.baseline(sample.shop_events(spark, sf_dir), window=DAY)


def product_baseline_joined(spark, sf_dir):
    events = sample.shop_events(spark, sf_dir)
    activity = baseline.product_activity(baseline.window_counts(events))
    return baseline.join_baseline(activity, baseline.session_funnel(events))


def product_baseline_all_windows(spark, sf_dir):
    return baseline.baseline(sample.shop_events(spark, sf_dir), include_empty=True)


def historical_dropoff(spark, sf_dir):
    funnel = baseline.session_funnel(sample.shop_events(spark, sf_dir))
    return baseline.with_dropoffs(funnel).select(
        "product_id", "historical_view_to_cart_dropoff", "historical_cart_to_purchase_dropoff"
    )


def baseline_export(spark, sf_dir):
    path = session.scratch_path(spark, "baseline")
    tables.write_baseline(product_baseline(spark, sf_dir), path)
    return spark.read.schema(schema.BASELINE_SCHEMA).json(f"{path}/json")


def baseline_last_row(spark, sf_dir):
    days = baseline.window_counts(sample.shop_events(spark, sf_dir), DAY)
    return baseline.last_baseline_row(days, order="window_start")


def event_copies(spark, sf_dir):
    events = sample.shop_events(spark, sf_dir)
    five = events
    for _ in range(4):
        five = five.unionAll(events)
    return baseline.baseline(five, window=DAY)


def revenue_by_brand(spark, sf_dir):
    # Per product first: a product with many sales then joins as one row.
    events = sample.shop_events(spark, sf_dir)
    sold = revenue.revenue_by(events, "product_id")
    return (
        sold.join(sample.parts(spark, sf_dir), "product_id", "left")
        .groupBy("part_brand")
        .agg(
            F.sum("purchases").alias("purchases"),
            F.sum(F.col("revenue").cast("decimal(38,12)")).cast("double").alias("revenue"),
        )
    )


def _catalogued(spark, sf_dir):
    return normalise.accepted(normalise.interpret_shop_rows(sample.catalogued_rows(spark, sf_dir)))


def event_attributes(spark, sf_dir):
    return _catalogued(spark, sf_dir).select("seq", "product_id", "category_id", "category_code", "brand")


def revenue_by_own_brand(spark, sf_dir):
    return revenue.revenue_by(_catalogued(spark, sf_dir), "brand", "category_code")


def revenue_by_product(spark, sf_dir):
    return revenue.revenue_by(sample.shop_events(spark, sf_dir), "product_id")


# --- trailing window ------------------------------------------------------------------


def _recent(spark, sf_dir, window=DAY):
    return trailing.in_window(sample.shop_events(spark, sf_dir), window)


def trailing_product_activity(spark, sf_dir):
    return trailing.product_counts(_recent(spark, sf_dir))


def trailing_product_activity_5m(spark, sf_dir):
    return trailing.product_counts(_recent(spark, sf_dir, schema.WINDOW))


def trailing_funnel(spark, sf_dir):
    return trailing.funnel(trailing.session_flags(_recent(spark, sf_dir)))


def window_event_totals(spark, sf_dir):
    return trailing.event_totals(_recent(spark, sf_dir))


def active_sessions(spark, sf_dir):
    flags = trailing.session_flags(_recent(spark, sf_dir))
    return flags.agg(F.count("*").alias("active_sessions"))


def clock_summary(spark, sf_dir):
    return trailing.clock_summary(sample.shop_events(spark, sf_dir), DAY)


def larger_loss(spark, sf_dir):
    funnel = trailing.funnel(trailing.session_flags(_recent(spark, sf_dir)))
    return trailing.with_larger_loss(funnel).select(
        "view_to_cart_dropoff", "cart_to_purchase_dropoff", "larger_loss"
    )


def top_products(spark, sf_dir):
    return trailing.top_products(trailing_product_activity(spark, sf_dir))


def trailing_series(spark, sf_dir):
    return series.trailing_series(sample.shop_events(spark, sf_dir), DAY)


def trailing_series_5m(spark, sf_dir):
    return series.trailing_series(sample.shop_events(spark, sf_dir))


# --- serving --------------------------------------------------------------------------


def _compared(spark, sf_dir):
    return serving.compare(
        trailing_product_activity(spark, sf_dir), product_baseline_daily(spark, sf_dir)
    )


def serving_merge(spark, sf_dir):
    return _compared(spark, sf_dir)


def serving_top(spark, sf_dir):
    return serving.rank(_compared(spark, sf_dir))


def serving_candidates(spark, sf_dir):
    return serving.trending(
        trailing_product_activity(spark, sf_dir), product_baseline_daily(spark, sf_dir),
        n=10, candidates=20,
    )


def threshold_sensitivity(spark, sf_dir):
    return serving.threshold_sensitivity(_compared(spark, sf_dir), THRESHOLDS)


def trending_now(spark, sf_dir):
    return documents.trending_now(sample.shop_events(spark, sf_dir), window=DAY)


def snapshot_document(spark, sf_dir):
    doc = documents.snapshot_document(sample.shop_events(spark, sf_dir), DAY, LONG_TIMEOUT)
    return doc.select(
        *[
            F.col(f.name)
            for f in schema.SNAPSHOT_SCHEMA.fields
            if f.dataType.typeName() in ("timestamp", "long")
        ],
        "funnel.*",
        *[F.coalesce(F.col("event_totals")[k], F.lit(0)).alias(f"total_{k}") for k in schema.EVENT_TYPES],
        F.concat_ws(",", "top_products.product_id").alias("top_product_ids"),
        F.concat_ws(",", "latest_abandoned_carts.session_id").alias("latest_session_ids"),
    )


def serving_document(spark, sf_dir):
    path = session.scratch_path(spark, "snapshot")
    events = sample.shop_events(spark, sf_dir)
    tables.write_document(documents.snapshot_document(events, DAY, LONG_TIMEOUT), path)
    doc = documents.serving_document(
        files.read_snapshot(spark, path), product_baseline_daily(spark, sf_dir)
    )
    return doc.select(
        "as_of",
        "definition",
        "abandoned_cart_signals_total",
        "performance.*",
        "funnel.view_to_cart_dropoff",
        F.posexplode("trending_products").alias("place", "product"),
    ).select("*", "product.*").drop("product")


# --- minute buckets -------------------------------------------------------------------


def minute_product_buckets(spark, sf_dir):
    return minutes.product_minutes(sample.shop_events(spark, sf_dir))


def minute_health(spark, sf_dir):
    return minutes.health_minutes(sample.shop_events(spark, sf_dir))


def bucket_keys(spark, sf_dir):
    return payloads.bucket_keys(minute_product_buckets(spark, sf_dir))


def health_keys(spark, sf_dir):
    return payloads.health_keys(minute_health(spark, sf_dir))


def five_bucket_view(spark, sf_dir):
    return minutes.latest_buckets_view(minute_product_buckets(spark, sf_dir))


def day_bucket_view(spark, sf_dir):
    return minutes.latest_buckets_view(minute_product_buckets(spark, sf_dir), window=DAY)


def hopping_view(spark, sf_dir):
    return minutes.hopping_view(minute_product_buckets(spark, sf_dir))


def retained_buckets(spark, sf_dir):
    return minutes.retained(minute_product_buckets(spark, sf_dir), _moment(RETENTION_NOW))


# --- cart abandonment -----------------------------------------------------------------


def abandoned_carts(spark, sf_dir):
    return abandonment.abandoned_carts(sample.shop_events(spark, sf_dir), LONG_TIMEOUT)


def abandoned_carts_15m(spark, sf_dir):
    return abandonment.abandoned_carts(sample.shop_events(spark, sf_dir))


def abandoned_carts_flush(spark, sf_dir):
    return abandonment.abandoned_carts(sample.shop_events(spark, sf_dir), LONG_TIMEOUT, flush=True)


def pending_carts(spark, sf_dir):
    return abandonment.pending_carts(sample.shop_events(spark, sf_dir), LONG_TIMEOUT)


def latest_signals(spark, sf_dir):
    return abandonment.latest_abandoned_carts(sample.shop_events(spark, sf_dir), LONG_TIMEOUT)


def overdue_carts(spark, sf_dir):
    return abandonment.overdue_carts(sample.shop_events(spark, sf_dir), LONG_TIMEOUT)


# --- load, latency and scaling tables -------------------------------------------------


def latency_log_parse(spark, sf_dir):
    log = experiments.parse_latency_log(sample.latency_log(spark, sf_dir), experiment_id="run-3")
    return log.select("experiment_id", "latency_ms")


def latency_stats(spark, sf_dir):
    events = sample.shop_events(spark, sf_dir)
    return experiments.latency_statistics(minutes.latency_records(events), "experiment_id")


def backlog_age(spark, sf_dir):
    return experiments.backlog_age(sample.shop_events(spark, sf_dir))


def largest_backlog_age(spark, sf_dir):
    return experiments.largest_backlog_age(sample.shop_events(spark, sf_dir))


def _runs(spark, sf_dir):
    return experiments.with_throughput(sample.load_runs(spark, sf_dir))


def load_run_throughput(spark, sf_dir):
    return _runs(spark, sf_dir).select(
        "experiment_id", "sent_records", "producer_seconds", "producer_throughput_eps"
    )


def load_run_summary(spark, sf_dir):
    return experiments.load_run_summary(_runs(spark, sf_dir))


def load_run_csv(spark, sf_dir):
    path = session.scratch_path(spark, "runs")
    tables.write_table_csv(_runs(spark, sf_dir), path, order=("completed_at_utc", "experiment_id"))
    stored = files.read_table_csv(spark, path, schema.LOAD_RUN_SCHEMA)
    return experiments.complete_runs(stored).select(
        "experiment_id", "target_rate_eps", "sent_records", "completed_at_utc"
    )


def throughput_over_time(spark, sf_dir):
    return experiments.throughput_over_time(_runs(spark, sf_dir))


def worker_speedup(spark, sf_dir):
    return experiments.worker_speedup(sample.worker_trials(spark, sf_dir))


def scaling_changes(spark, sf_dir):
    return experiments.scaling_changes(sample.worker_samples(spark, sf_dir))


def scaling_observed(spark, sf_dir):
    return experiments.scaling_observed(sample.worker_samples(spark, sf_dir))


# --- streams: the same rows through Structured Streaming --------------------------------


def _event_rows(spark, sf_dir):
    # a pattern, because a file stream takes a plain path for a folder
    table = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return inputs.table_files(spark, f"{sf_dir}/events*.parquet", table)


def _stream(spark, sf_dir):
    return sample.canonical(_event_rows(spark, sf_dir))


PIECES = 3  # of a shuffled feed, one a micro-batch
FILE_ROWS = 50_000  # of a file of a piece, at least


def _in_pieces(spark, name, events, piece, pieces):
    """Writes the events piece after piece, each as the same number of files, so that this number a micro-batch
    makes a piece a micro-batch; returns the folder and the number. The events are read once, and all cores
    write; a small piece is one file."""
    path, parted = session.scratch_path(spark, name), session.scratch_path(spark, f"{name}-parted")
    events.withColumn("piece", piece.cast("int")).write.partitionBy("piece").parquet(parted)
    table = T.StructType([*events.schema.fields]).add("piece", "integer")
    found = spark.read.schema(table).option("basePath", parted).parquet(parted)
    sizes = {r.piece: r["count"] for r in found.groupBy("piece").count().collect()}
    most = spark.sparkContext.defaultParallelism
    files = max(1, min(most, min(sizes.get(n, 0) for n in range(pieces)) // FILE_ROWS))
    for n in range(pieces):
        rows = found.filter(F.col("piece") == n).drop("piece")
        (rows.repartition(files) if files > 1 else rows.coalesce(1)).write.mode("append").parquet(path)
    return path, files


def _pieces(spark, sf_dir, closing=True):
    """The events as a stream of files in no order of time, and a row that closes the clock."""
    events = sample.canonical(spark.read.parquet(f"{sf_dir}/events.parquet"))
    path, files = _in_pieces(spark, "feed", events, F.col("seq") % PIECES, PIECES)
    if closing:
        end = events.agg(F.max("event_time") + F.expr(f"interval {LATENESS}") * 2).scalar()
        inputs.closing_row(spark, events.schema, end).write.mode("append").parquet(path)
    return inputs.table_files(spark, f"{path}/*.parquet", events.schema, max_files=files)


# Covers the whole span of the events, because the files come in no order.
LATENESS = "1000 days"


def _clocked(spark, sf_dir):
    return inputs.on_clock(_pieces(spark, sf_dir), LATENESS)


def _in_order(spark, sf_dir):
    """The events as a stream of five pieces in order of time, spread over files, on a clock that allows for the
    disorder inside a piece, and a row that brings the clock just past the last event."""
    events = sample.canonical(spark.read.parquet(f"{sf_dir}/events.parquet"))
    at = F.unix_micros("event_time")
    first, last = events.agg(F.min(at), F.max(at)).first()
    width = -(-(last - first + 1) // 5000) * 1000
    path, files = _in_pieces(spark, "ordered-feed", events, F.call_function("div", at - first, F.lit(width)), 5)
    end = F.timestamp_micros(F.lit(last + width + 2000))
    inputs.closing_row(spark, events.schema, end).write.mode("append").parquet(path)
    feed = inputs.table_files(spark, f"{path}/*.parquet", events.schema, max_files=files)
    return inputs.on_clock(feed, f"{width} microseconds")


def _live_carts(spark, sf_dir):
    """(folder of cart changes, folder of the clock) after a whole feed."""
    events = _in_order(spark, sf_dir)
    changes = signals.cart_changes(events, LONG_TIMEOUT)
    carts = _run(spark, "live-carts", lambda out, check: outputs.live_carts(changes, out, check))
    clock = _run(spark, "clock", lambda out, check: outputs.event_clock(events, out, check))
    return carts, clock


def stream_signals(spark, sf_dir):
    return outputs.read_signals(spark, *_live_carts(spark, sf_dir))


def stream_cart_counters(spark, sf_dir):
    carts, _ = _live_carts(spark, sf_dir)
    pending = outputs.read_pending(spark, carts).agg(F.count("*").alias("pending_rows"), F.max("deadline").alias("last_deadline"))
    return outputs.read_cart_counters(spark, carts).crossJoin(pending)


def _run(spark, name, start):
    """Runs a query over everything that is there; returns the folder it filled."""
    root = session.scratch_path(spark, name)
    query = start(f"{root}/out", f"{root}/checkpoint")
    query.awaitTermination()
    return f"{root}/out"


def _appended(spark, name, rows):
    path = _run(spark, name, lambda out, check: outputs.append_table(rows, out, check))
    return spark.read.schema(rows.schema).parquet(path)


def stream_minute_buckets(spark, sf_dir):
    counters = views.minute_counters(_clocked(spark, sf_dir))
    path = _run(spark, "minutes", lambda out, check: outputs.upsert_totals(counters, out, check))
    return outputs.read_totals(spark, path, "bucket", "product_id")


BUCKET_KEYS = ("bucket", "product_id")


def stream_live_table(spark, sf_dir):
    counters = views.minute_counters(_in_order(spark, sf_dir))
    path = _run(
        spark, "live-table", lambda out, check: livetable.live_table(counters, out, check, BUCKET_KEYS, fanout=2, keep=3)
    )
    return livetable.read_live(spark, path, BUCKET_KEYS)


def stream_live_top(spark, sf_dir):
    """The last day of the live table against the baseline, as of the newest bucket."""
    counters = views.minute_counters(_in_order(spark, sf_dir))
    path = _run(spark, "live-top", lambda out, check: livetable.live_table(counters, out, check, BUCKET_KEYS, fanout=3))
    buckets = livetable.read_live(spark, path, BUCKET_KEYS)
    recent = minutes.latest_buckets_view(buckets, window=DAY).drop("removals")
    return serving.trending(recent, product_baseline_daily(spark, sf_dir)).select(
        "product_id", "views", "carts", "purchases", "trend_score", "activity_lift", "is_unusually_trending"
    )


def stream_minute_health(spark, sf_dir):
    health = views.minute_health(_clocked(spark, sf_dir))
    path = _run(spark, "health", lambda out, check: outputs.upsert_totals(health, out, check))
    return outputs.read_totals(spark, path, "bucket", "experiment_id")


def stream_latency_stats(spark, sf_dir):
    """One latency row per live event, and the percentiles of what has been stored."""
    rows = minutes.latency_records(_stream(spark, sf_dir))
    return experiments.latency_statistics(_appended(spark, "latency", rows), "experiment_id")


def stream_hopping_trend(spark, sf_dir):
    return _appended(spark, "hopping", views.hopping_trend(_clocked(spark, sf_dir)))


def stream_funnel(spark, sf_dir):
    funnel = views.session_funnel(_clocked(spark, sf_dir), "1 day", "6 hours")
    return _appended(spark, "funnel", funnel)


def stream_abandonment(spark, sf_dir):
    signals = views.abandoned_carts(_clocked(spark, sf_dir), LONG_TIMEOUT)
    return _appended(spark, "abandonment", signals)


def stream_dedup(spark, sf_dir):
    twice = _pieces(spark, sf_dir).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    once = inputs.on_clock(twice, LATENESS, event_id="seq")
    return _appended(spark, "dedup", views.hopping_trend(once, "10 minutes", "10 minutes"))


def stream_late(spark, sf_dir):
    events = _pieces(spark, sf_dir, closing=False)
    path = _run(spark, "late", lambda out, check: outputs.late_rows(events, out, check, "2 days"))
    return outputs.read_late(spark, path).select("seq", "event_time", "product_id", "session_id")


def _routed(spark, sf_dir):
    raw = _event_rows(spark, sf_dir)
    payload = F.to_json(
        F.struct(
            F.col("ts").cast("string").alias("event_time"),
            "event_type",
            F.get_json_object("props", "$.k").alias("product_id"),
            F.col("user_id").alias("session_id"),
        )
    )
    decoded = records.decode_records(
        raw.select(F.col("event_id").alias("seq"), F.base64(payload.cast("binary")).alias("data"))
    )
    return _run(spark, "route", lambda out, check: outputs.route(decoded, out, check))


def stream_route(spark, sf_dir):
    return spark.read.parquet(_routed(spark, sf_dir)).select("seq", "status", "reject_reason")


def stream_redrive(spark, sf_dir):
    """Clicks are refused at first, and carts after the rule has changed; errors are refused twice."""
    routed = _routed(spark, sf_dir)
    repair = lambda text: F.regexp_replace(text, '"event_type":"click"', '"event_type":"cart"')
    again = _run(spark, "redrive", lambda out, check: outputs.redrive(spark, routed, out, check, repair))
    first = spark.read.parquet(routed).filter("status = 'accepted'").withColumn("attempts", F.lit(1))
    columns = ("seq", "status", "attempts", "event_type", "product_id", "reject_reason")
    return first.select(*columns).unionByName(spark.read.parquet(again).select(*columns))


def stream_archive(spark, sf_dir):
    events = _stream(spark, sf_dir).select(*schema.EVENT_COLUMNS, "experiment_id", "seq")
    path = _run(spark, "stream-archive", lambda out, check: outputs.archive(events, out, check))
    stored = files.read_archive(spark, path)
    return stored.select("seq", *_CLEAN, F.col("event_date").cast("string").alias("event_date"))


def stream_serving(spark, sf_dir):
    normal = session.scratch_path(spark, "normal")
    tables.write_laid_out(product_baseline_daily(spark, sf_dir), normal, parts=8)
    trend = views.hopping_trend(_clocked(spark, sf_dir), "1 day", "1 day")
    path = _run(spark, "serving", lambda out, check: outputs.serve(trend, normal, out, check, laid_out=True))
    return spark.read.option("basePath", path).parquet(f"{path}/batch_id=*").select(
        "window_end", "rank", "product_id", "trend_score", "activity_lift", "is_unusually_trending"
    )


_QUERIES = (
    event_normalise, rejected_events, ingest_quality, ingest_reasons, usable_events,
    source_row_limit, csv_ingest, csv_rejects, jsonl_roundtrip, keyed_record_decode, keyed_files,
    ingest_files, archive_range, order_violations, replay_rebase, replay_preserve_timing,
    product_window_counts, product_activity, product_session_funnel, product_baseline,
    product_baseline_daily, product_baseline_joined, product_baseline_all_windows,
    historical_dropoff, baseline_export, baseline_last_row, event_copies, revenue_by_brand,
    revenue_by_product, event_attributes, revenue_by_own_brand, trailing_product_activity, trailing_product_activity_5m, trailing_funnel,
    window_event_totals, active_sessions, clock_summary, larger_loss, top_products, trailing_series, trailing_series_5m, serving_merge,
    serving_top, serving_candidates, threshold_sensitivity, trending_now, snapshot_document,
    serving_document, minute_product_buckets, minute_health, bucket_keys, health_keys,
    five_bucket_view, day_bucket_view, hopping_view, retained_buckets, abandoned_carts,
    abandoned_carts_15m, abandoned_carts_flush, overdue_carts, pending_carts, latest_signals, latency_log_parse,
    latency_stats, backlog_age, largest_backlog_age, load_run_throughput, load_run_summary,
    load_run_csv, throughput_over_time, worker_speedup, scaling_changes, scaling_observed,
    stream_minute_buckets, stream_live_table, stream_live_top, stream_minute_health, stream_latency_stats, stream_hopping_trend, stream_funnel,
    stream_abandonment, stream_signals, stream_cart_counters, stream_dedup, stream_late, stream_route, stream_redrive, stream_archive, stream_serving,
)


def _prepared(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(query(session.prepare(spark), sf_dir.rstrip("/")))

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: _prepared(query) for query in _QUERIES}
