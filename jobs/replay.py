"""Historical shop CSV onto a replay clock, as JSON lines or into a keyed topic.

    spark-submit jobs/replay.py INPUT --rate 1000 (--output FOLDER | --servers HOSTS --topic NAME)
"""

import argparse
import datetime as dt

from pyspark.sql import functions as F

from cartpulse.operators.normalise import accepted
from cartpulse.operators.replay import rebase
from cartpulse.session import build_session
from cartpulse.sinks.payloads import keyed_records, write_json_lines
from cartpulse.sources.files import read_shop_csv


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("input", help="CSV or CSV.GZ file or folder")
    parser.add_argument("--rate", type=float, default=100, help="events per second of the replay clock")
    parser.add_argument("--limit", type=int, help="source rows to read, rejects included")
    parser.add_argument("--preserve-timing", action="store_true", help="keep the gaps, shortened by --rate")
    parser.add_argument("--start", type=dt.datetime.fromisoformat, help="first moment of the replay (default: now)")
    parser.add_argument("--experiment-id", help="label added to topic records")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--output", help="folder for JSON lines")
    target.add_argument("--topic", help="topic for keyed records; needs --servers and the Kafka connector")
    parser.add_argument("--servers")
    args = parser.parse_args(argv)
    spark = build_session("replay")
    start = args.start or dt.datetime.now(dt.UTC)
    if start.tzinfo is None:
        start = start.replace(tzinfo=dt.UTC)
    events = accepted(read_shop_csv(spark, args.input, args.limit))
    moved = rebase(events, F.lit(start), args.rate, args.preserve_timing)
    if args.output:
        write_json_lines(moved, args.output, order=("event_time", "seq"))
    else:
        writer = keyed_records(moved, args.experiment_id).write.format("kafka")
        writer.option("kafka.bootstrap.servers", args.servers).option("topic", args.topic).save()


if __name__ == "__main__":
    main()
