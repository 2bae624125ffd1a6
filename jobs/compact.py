"""Rewrites a live counter table without superseded and expired rows.

    spark-submit jobs/compact.py OUTPUT/product_minutes TARGET --keys bucket product_id
"""

import argparse
import datetime as dt

from cartpulse.session import build_session
from cartpulse.streaming.outputs import compact_totals


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("totals", help="counter table written by jobs/stream.py")
    parser.add_argument("target", help="folder of the compacted table")
    parser.add_argument("--keys", nargs="+", required=True, help="columns that identify a counter")
    parser.add_argument("--now", type=dt.datetime.fromisoformat, help="moment of expiry; default is the clock")
    args = parser.parse_args(argv)
    now = args.now or dt.datetime.now(dt.UTC)
    compact_totals(build_session("compact"), args.totals, args.target, now, *args.keys)


if __name__ == "__main__":
    main()
