"""Snapshot against baseline: lift, flag and ranking.

    spark-submit jobs/serve.py SNAPSHOT BASELINE [--output FOLDER] [--top N]

BASELINE is Parquet, JSON lines or a JSON array. Without --output the document is printed.
"""

import argparse

from cartpulse.plans.documents import serving_document
from cartpulse.session import build_session
from cartpulse.sinks.tables import document_json, write_document
from cartpulse.sources.files import read_baseline, read_baseline_json, read_snapshot


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("snapshot")
    parser.add_argument("baseline")
    parser.add_argument("--baseline-format", choices=("parquet", "json-lines", "json-array"), default="parquet")
    parser.add_argument("--top", type=int, default=5)
    parser.add_argument("--output")
    args = parser.parse_args(argv)
    spark = build_session("serve")
    if args.baseline_format == "parquet":
        normal = read_baseline(spark, args.baseline)
    else:
        normal = read_baseline_json(spark, args.baseline, lines=args.baseline_format == "json-lines")
    document = serving_document(read_snapshot(spark, args.snapshot), normal, args.top)
    if args.output:
        write_document(document, args.output)
    else:
        print(document.select(document_json(document)).first()[0])


if __name__ == "__main__":
    main()
