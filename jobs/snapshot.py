"""State of the trailing window at the last event of canonical JSON lines.

    spark-submit jobs/snapshot.py INPUT [--output FOLDER] [--flush-abandonment]

The read is strict: a bad line fails the job. Without --output the document is printed.
"""

import argparse

from cartpulse.operators.normalise import accepted
from cartpulse.operators.ordered import require_ordered
from cartpulse.plans.documents import snapshot_document
from cartpulse.session import build_session, stored
from cartpulse.sinks.tables import document_json, write_document
from cartpulse.sources.files import read_payload_lines


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("input")
    parser.add_argument("--window-minutes", type=int, default=5)
    parser.add_argument("--abandonment-minutes", type=int, default=15)
    parser.add_argument("--top", type=int, default=5)
    parser.add_argument("--flush-abandonment", action="store_true", help="report carts still open at the end")
    parser.add_argument("--check-order", action="store_true", help="fail when lines are not in time order")
    parser.add_argument("--output")
    args = parser.parse_args(argv)
    spark = build_session("snapshot")
    events = accepted(read_payload_lines(spark, args.input), on_invalid="fail")
    if args.check_order:
        events = require_ordered(events)
    # The document looks at the events from several sides; parse and check them once.
    document = snapshot_document(
        stored(events, "events"), f"{args.window_minutes} minutes", f"{args.abandonment_minutes} minutes",
        args.top, args.flush_abandonment,
    )
    if args.output:
        write_document(document, args.output)
    else:
        print(document.select(document_json(document)).first()[0])


if __name__ == "__main__":
    main()
