"""Streaming sinks. All of them can repeat a micro-batch without changing the result."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from cartpulse.functions.timebuckets import interval
from cartpulse.operators.abandonment import with_detection
from cartpulse.operators.serving import compare
from cartpulse.schema import JSON_TEXT_SCHEMA, TOP_N, UNUSUAL_LIFT
from cartpulse.session import remove
from cartpulse.sinks.payloads import keyed_records
from cartpulse.sources.files import read_baseline, read_laid_out
from cartpulse.sources.records import decode_records
from cartpulse.streaming import signals


def start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    """``every`` sets the micro-batch interval; None processes what is there and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def append_table(
    rows: DataFrame, path: str, checkpoint: str, every: str | None = None, partition_by: str | None = None
) -> StreamingQuery:
    """Final rows appended to a Parquet table exactly once."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return start(writer, checkpoint, every)


def archive(events: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Raw-event archive by date, as ``sources.files.read_archive`` expects it."""
    dated = events.withColumn("event_date", F.to_date("event_time"))
    return append_table(dated, path, checkpoint, every, partition_by="event_date")


def upsert_totals(counters: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keeps counters up to date: each micro-batch stores the absolute totals of the keys
    it touched under its own number, so a repeated batch replaces itself."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return start(counters.writeStream.outputMode("update").foreachBatch(store), checkpoint, every)


def read_totals(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """Current counters: the newest stored row per key."""
    stored = spark.read.option("basePath", path).parquet(f"{path}/batch_id=*")
    values = [c for c in stored.columns if c not in (*keys, "batch_id")]
    newest = stored.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch_id")).alias("row"))
    return newest.select(*keys, *[F.col(f"row.{c}").alias(c) for c in values])


def compact_totals(spark: SparkSession, path: str, target: str, now, *keys: str) -> None:
    """Rewrites the counters without superseded and expired rows, as a new totals folder."""
    current = read_totals(spark, path, *keys).filter(F.col("expires_at") > F.unix_seconds(F.lit(now)))
    current.write.mode("overwrite").parquet(f"{target}/batch_id=-1")


def live_carts(changes: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keeps the cart changes (``signals.cart_changes``) and the running numbers of pending and signalled carts.

    Each micro-batch stores its changes, what it keeps and the numbers and the clock after it under its own number; those
    before it are of the last batch, so a repeated batch replaces itself and a reader of the
    numbers reads one row. Of what was kept only the last two batches stay."""

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = spark.read.parquet(f"{path}/counters/batch_id={batch_id - 1}").first() if batch_id else None
        kept = spark.read.parquet(f"{path}/steps/batch_id={batch_id - 1}") if batch_id else None
        before = last.clock if last else 0
        now = max(before, batch.agg(signals.clock_of()).first()[0] or 0)
        signals.steps(kept, batch, before, now).write.mode("overwrite").parquet(f"{path}/steps/batch_id={batch_id}")
        new = signals.changes_of(spark.read.parquet(f"{path}/steps/batch_id={batch_id}"))
        new.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
        opened, closed, signalled = (
            F.count_if(F.col("change") == kind) for kind in (signals.OPENED, signals.CLOSED, signals.SIGNALLED)
        )
        numbers = new.agg((opened - closed - signalled).alias("pending_carts"), signalled.alias("abandoned_cart_signals_total"))
        if last:
            numbers = numbers.select(*[(F.col(c) + last[c]).alias(c) for c in numbers.columns])
        clocked = numbers.withColumn("clock", F.lit(now).cast("bigint"))
        clocked.coalesce(1).write.mode("overwrite").parquet(f"{path}/counters/batch_id={batch_id}")
        remove(spark, f"{path}/steps/batch_id={batch_id - 2}")

    return start(changes.writeStream.outputMode("update").foreachBatch(store), checkpoint, every)


def event_clock(events: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """The distinct moments of a stream on a clock, by date: what detection times are looked up in."""
    times = events.select("event_time").dropDuplicates(["event_time"])
    return append_table(times.withColumn("event_date", F.to_date("event_time")), path, checkpoint, every, "event_date")


def read_signals(spark: SparkSession, path: str, clock: str) -> DataFrame:
    """All signals so far with ``detected_at``: the first event of any kind at or after the deadline."""
    changes = spark.read.option("basePath", f"{path}/changes").parquet(f"{path}/changes/batch_id=*")
    found = changes.filter(F.col("change") == signals.SIGNALLED).drop("change", "batch_id")
    times = spark.read.parquet(clock)
    first = found.agg(F.to_date(F.min("deadline"))).scalar()
    return with_detection(found, times.filter(F.col("event_date") >= first), F.lit(None).cast("timestamp"))


def read_pending(spark: SparkSession, path: str) -> DataFrame:
    """Carts that are open now: opened last and neither closed nor signalled."""
    changes = spark.read.option("basePath", f"{path}/changes").parquet(f"{path}/changes/batch_id=*")
    ended = F.count_if(F.col("change") != signals.OPENED)
    carts = changes.groupBy("session_id", "product_id", "cart_time", "deadline").agg((F.count("*") - 2 * ended).alias("open"))
    return carts.filter("open > 0").drop("open")


def read_cart_counters(spark: SparkSession, path: str) -> DataFrame:
    """One row: pending carts and signals so far, after the newest micro-batch."""
    stored = spark.read.option("basePath", f"{path}/counters").parquet(f"{path}/counters/batch_id=*")
    newest = stored.agg(F.max("batch_id")).scalar()
    return stored.filter(F.col("batch_id") == newest).drop("batch_id", "clock")


def late_rows(
    events: DataFrame, path: str, checkpoint: str, delay: str, every: str | None = None, strict: bool = False
) -> StreamingQuery:
    """Keeps the events that come more than ``delay`` behind the newest event of earlier micro-batches:
    the rows that views on a clock with this delay can no longer count. With ``strict`` the
    first such event fails the query.

    Each micro-batch stores its clock and its late rows under its own number, so a repeated batch
    replaces itself; the clock of a batch is read from the batch before."""

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = F.max("event_time").alias("newest")
        previous = None
        if batch_id:
            previous = spark.read.parquet(f"{path}/clock/batch_id={batch_id - 1}").first()["newest"]
        late = batch.filter(F.col("event_time") < F.lit(previous).cast("timestamp") - interval(delay))
        if strict:
            too_late = F.raise_error(F.concat(F.lit("event behind the clock at "), F.col("event_time").cast("string")))
            late = late.filter(too_late.cast("boolean"))
        late.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        clock = batch.select("event_time").agg(newest)
        clock.select(F.greatest("newest", F.lit(previous).cast("timestamp")).alias("newest")).write.mode(
            "overwrite"
        ).parquet(f"{path}/clock/batch_id={batch_id}")

    return start(events.writeStream.outputMode("append").foreachBatch(store), checkpoint, every)


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """All late rows so far, with the micro-batch that brought them."""
    return spark.read.option("basePath", f"{path}/late").parquet(f"{path}/late/batch_id=*")


def route(interpreted: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Accepted events and rejects of each micro-batch, written in one pass into
    ``status=accepted`` and ``status=rejected``. A bad record never blocks the good ones
    and is not retried for ever; it stays in the reject table with its reason."""
    status = F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")
    return append_table(
        interpreted.withColumn("status", status), path, checkpoint, every, partition_by="status"
    )


def redrive(
    spark: SparkSession, quarantine: str, path: str, checkpoint: str,
    repair: Callable[[Column], Column] | None = None, every: str | None = None,
) -> StreamingQuery:
    """Judges the refused rows of a ``route`` table (or the buried rows of an earlier pass) once more, by the rules
    of now: rows that are valid become ``status=promoted``, the others ``status=buried``, with the number of
    attempts so far. The text of a row as delivered goes through ``repair`` first, where one is given.

    The table is read as a stream, so every refused row is judged once a pass, also after a restart,
    and a promoted row is counted once. Start a pass anew, with its own checkpoint, after a rule change."""
    table = spark.read.parquet(quarantine).schema
    rows = spark.readStream.schema(table).parquet(quarantine).filter(F.col("status").isin("rejected", "buried"))
    text = F.coalesce(F.get_json_object("raw", "$._corrupt_record"), F.col("raw"))
    attempts = F.col("attempts") if "attempts" in table.names else F.lit(1)
    known = {*JSON_TEXT_SCHEMA.names, "raw", "reject_reason", "status", "attempts", "_corrupt_record"}
    again = decode_records(
        rows.select(
            *[c for c in table.names if c not in known],
            (attempts + 1).alias("attempts"),
            (repair(text) if repair else text).alias("data"),
        ),
        base64=False,
    )
    status = F.when(F.col("reject_reason").isNull(), "promoted").otherwise("buried")
    return append_table(again.withColumn("status", status), path, checkpoint, every, partition_by="status")


def keyed_topic(
    events: DataFrame, servers: str, topic: str, checkpoint: str,
    experiment_id: str | None = None, every: str | None = None,
) -> StreamingQuery:
    """Events to a keyed topic; a refused record fails the query. Needs the Kafka connector."""
    writer = (
        keyed_records(events, experiment_id).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
    )
    return start(writer, checkpoint, every)


def serve(
    trend: DataFrame, baseline_path: str, path: str, checkpoint: str,
    n: int = TOP_N, threshold: float = UNUSUAL_LIFT, every: str | None = None, laid_out: bool = False,
) -> StreamingQuery:
    """Closed windows against the stored baseline: the ``n`` products with the highest
    lift per window. The baseline is read anew for each micro-batch, so a recomputed one
    takes effect at once. Ranking keeps ``n`` rows per window in every task before the
    exchange. A baseline ``laid_out`` by ``sinks.tables.write_laid_out`` is read only in the parts that hold
    products of the micro-batch, and its rows are not shuffled to be made unique."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/_windows/batch_id={batch_id}")
        closed = spark.read.schema(batch.schema).parquet(f"{path}/_windows/batch_id={batch_id}")
        if closed.isEmpty():
            return
        if laid_out:
            compared = compare(closed, read_laid_out(spark, baseline_path, closed), threshold, unique=True)
        else:
            compared = compare(closed, read_baseline(spark, baseline_path), threshold)
        rank_windows(compared, n).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        remove(spark, f"{path}/_windows/batch_id={batch_id}")

    return start(trend.writeStream.outputMode("append").foreachBatch(publish), checkpoint, every)


def rank_windows(compared: DataFrame, n: int = TOP_N) -> DataFrame:
    """Rank within each window: lift, then score, then product."""
    order = Window.partitionBy("window_end").orderBy(
        F.desc_nulls_last("activity_lift"), F.desc("trend_score"), F.asc("product_id")
    )
    return (
        compared.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .drop("normal_score_exact")
    )
