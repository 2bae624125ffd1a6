"""Historical baseline per product.

    spark-submit jobs/baseline.py INPUT OUTPUT [--format json|parquet] [--partitions N]

Writes OUTPUT/parquet and OUTPUT/json. Parquet input is the archive or accepted events.
"""

import argparse

from cartpulse.operators.baseline import baseline
from cartpulse.operators.normalise import accepted, usable
from cartpulse.session import build_session
from cartpulse.sinks.tables import write_baseline
from cartpulse.sources.files import read_history


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--format", choices=("json", "parquet"), default="json")
    parser.add_argument("--window-minutes", type=int, default=5)
    parser.add_argument("--include-empty", action="store_true", help="average over windows without events too")
    parser.add_argument("--partitions", type=int, help="fixed partitions by product, for experiments")
    parser.add_argument("--json-files", type=int, help="number of JSON files (default: as many as Parquet parts)")
    args = parser.parse_args(argv)
    spark = build_session("baseline")
    if args.format == "json":
        events = accepted(read_history(spark, args.input))
    else:
        events = usable(spark.read.parquet(args.input))
    result = baseline(events, f"{args.window_minutes} minutes", args.include_empty, args.partitions)
    write_baseline(result, args.output, args.json_files)


if __name__ == "__main__":
    main()
