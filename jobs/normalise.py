"""Shop CSV files to accepted events and rejects.

    spark-submit jobs/normalise.py INPUT OUTPUT [--limit N] [--no-row-numbers]

OUTPUT holds the folders status=accepted and status=rejected; the quality figures are printed.
"""

import argparse

from cartpulse.operators.quality import ingest_summary, reject_reasons
from cartpulse.session import build_session
from cartpulse.sinks.tables import write_interpreted
from cartpulse.sources.files import read_shop_csv


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("input", help="CSV or CSV.GZ file or folder")
    parser.add_argument("output")
    parser.add_argument("--limit", type=int, help="source rows to read, rejects included")
    parser.add_argument("--no-row-numbers", action="store_true", help="single pass, rejects without row number")
    args = parser.parse_args(argv)
    spark = build_session("normalise")
    write_interpreted(
        read_shop_csv(spark, args.input, args.limit, numbered=not args.no_row_numbers), args.output
    )
    stored = spark.read.parquet(args.output)
    ingest_summary(stored).show(truncate=False)
    reject_reasons(stored).show(truncate=False)


if __name__ == "__main__":
    main()
