"""The live side: every streaming view over one feed, each query with its own checkpoint.

    spark-submit jobs/stream.py OUTPUT --baseline FOLDER (--folder FOLDER | --servers HOSTS --topic NAME)

--once processes what is there and stops.
"""

import argparse

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from cartpulse import schema
from cartpulse.operators.minutes import latency_records
from cartpulse.operators.normalise import accepted
from cartpulse.session import build_session
from cartpulse.streaming import inputs, livetable, outputs, signals, views


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("output")
    parser.add_argument("--baseline", required=True, help="baseline Parquet folder")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--folder", help="folder of canonical JSON lines")
    source.add_argument("--topic", help="keyed topic; needs --servers and the Kafka connector")
    parser.add_argument("--servers")
    parser.add_argument("--starting", default="latest", help="where to start in the topic")
    parser.add_argument("--max-per-batch", type=int, help="files or records per micro-batch")
    parser.add_argument("--delay", default="1 minute", help="how late events may arrive")
    parser.add_argument("--every", default="1 second", help="micro-batch interval")
    parser.add_argument("--window-minutes", type=int, default=5)
    parser.add_argument("--abandonment-minutes", type=int, default=15)
    parser.add_argument("--event-id", help="column that identifies repeated deliveries")
    parser.add_argument("--log-tables", action="store_true", help="counters as live tables that compact themselves")
    parser.add_argument("--once", action="store_true")
    args = parser.parse_args(argv)
    spark = build_session("stream")
    every = None if args.once else args.every
    window, timeout = f"{args.window_minutes} minutes", f"{args.abandonment_minutes} minutes"

    if args.folder:
        interpreted = inputs.payload_files(spark, args.folder, args.max_per_batch)
        interpreted = interpreted.withColumn("seq", F.lit(0).cast("long"))
    else:
        interpreted = inputs.kafka_records(
            spark, args.servers, args.topic, args.max_per_batch, args.starting
        )
    valid = accepted(interpreted).withColumn("processed_at", F.current_timestamp())
    events = inputs.on_clock(valid, args.delay, args.event_id)

    def at(name: str) -> tuple[str, str]:
        return f"{args.output}/{name}", f"{args.output}/_checkpoints/{name}"

    def counters(rows: DataFrame, name: str, *keys: str) -> StreamingQuery:
        if args.log_tables:
            return livetable.live_table(rows, *at(name), keys, every)
        return outputs.upsert_totals(rows, *at(name), every)

    archived = valid.select(*schema.EVENT_COLUMNS, "experiment_id", "seq")
    queries = [
        outputs.route(interpreted, *at("ingest"), every),
        outputs.archive(archived, *at("archive"), every),
        counters(views.minute_counters(events), "product_minutes", "bucket", "product_id"),
        counters(views.minute_health(events), "health_minutes", "bucket", "experiment_id"),
        outputs.append_table(latency_records(valid), *at("latency"), every),
        outputs.live_carts(signals.cart_changes(events, timeout), *at("live_carts"), every),
        outputs.event_clock(events, *at("clock"), every),
        outputs.append_table(views.session_funnel(events, window), *at("funnel"), every),
        outputs.append_table(views.abandoned_carts(events, timeout), *at("abandoned_carts"), every),
        outputs.late_rows(archived, *at("late"), args.delay, every),
        outputs.serve(views.hopping_trend(events, window), args.baseline, *at("trending"), every=every),
    ]
    if args.once:
        for query in queries:
            query.awaitTermination()
        return
    try:
        spark.streams.awaitAnyTermination()  # raises what ended it
    finally:
        for query in queries:
            query.stop()


if __name__ == "__main__":
    main()
