"""Streaming sources and the common front of every streaming query.

The clock of a stream is the newest event time minus the allowed lateness (``delay``). Whatever a
view gets behind its clock it can no longer count, so the lateness must cover the disorder of the
feed: a minute or so on a live topic, nothing on a replay in time order, and the whole covered span
for stored files in any order. Then the result does not depend on how many files a
micro-batch takes. ``outputs.late_rows`` keeps what came too late.

Windows still open when a finished replay ends come out once a closing row (``closing_row``) is
delivered: it moves the clock past the last window and is counted nowhere.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cartpulse.sources.records import decode_records


def _files_per_batch(max_files: int | None) -> int:
    return 1000 if max_files is None else max_files


def payload_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Interpreted events from a folder of canonical JSON lines; ``max_files`` per
    micro-batch sets the replay rate."""
    reader = spark.readStream.schema("value string").option("maxFilesPerTrigger", _files_per_batch(max_files))
    lines = reader.text(path).filter(F.trim("value") != "")
    return decode_records(lines, data="value", base64=False)


def kafka_records(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None,
    starting: str = "latest",
) -> DataFrame:
    """Interpreted events from a keyed topic, with partition and offset for tracing. ``seq`` orders the
    events of one partition; ``delivery`` identifies a record in the whole topic.
    Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    records = reader.load().select(
        "partition",
        F.col("offset").alias("seq"),
        F.concat_ws("-", "partition", "offset").alias("delivery"),
        F.col("key").cast("string").alias("key"),
        "value",
    )
    return decode_records(records, data="value", base64=False)


def table_files(spark: SparkSession, path: str, table: T.StructType, max_files: int | None = None) -> DataFrame:
    """A stored Parquet table or file as a stream."""
    reader = spark.readStream.schema(table).option("maxFilesPerTrigger", _files_per_batch(max_files))
    return reader.parquet(path)


def on_clock(events: DataFrame, delay: str, event_id: str | None = None) -> DataFrame:
    """Event-time clock with the lateness to allow for; see ``outputs.late_rows`` for later rows.
    With ``event_id`` repeated deliveries inside the delay are counted once."""
    clocked = events.withWatermark("event_time", delay)
    return clocked.dropDuplicatesWithinWatermark([event_id]) if event_id else clocked


def closing_row(spark: SparkSession, table: T.StructType, end: Column) -> DataFrame:
    """One row of a feed's own schema with nothing but the time ``end``; deliver it after the last
    file. ``end`` must lie past the newest event by the allowed lateness and the longest window."""
    row = spark.range(1)
    return row.select(
        *[(end if f.name == "event_time" else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.fields]
    )
