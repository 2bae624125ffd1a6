"""Moving historical events onto a replay clock."""

from pyspark.sql import Column, DataFrame, functions as F

from cartpulse.functions.timebuckets import history_clock
from cartpulse.operators.ordered import first_rows, with_position


def rebase(
    events: DataFrame,
    start: Column,
    events_per_second: float,
    preserve_timing: bool = False,
    seq: str = "seq",
) -> DataFrame:
    """New ``event_time`` = start + offset; the old one is kept as ``source_event_time``
    unless that is already known.

    The offset is the event's position in ``seq`` order divided by the rate, or with
    ``preserve_timing`` its distance from the first event divided by the rate. The second
    form needs no ordering pass, only the time of the first event.
    """
    if events_per_second <= 0:
        raise ValueError("events_per_second must be greater than zero")
    if preserve_timing:
        first = events.agg(F.min_by("event_time", seq).alias("first")).scalar()
        seconds = (F.unix_micros("event_time") - F.unix_micros(first)) / 1e6
        placed = events
    else:
        placed = with_position(events, seq)
        seconds = F.col("position").cast("double")
    offset = F.rint(seconds / float(events_per_second) * 1e6).cast("bigint")
    return placed.withColumns(
        {
            "event_time": F.timestamp_micros(F.unix_micros(start) + offset),
            "source_event_time": history_clock(),
        }
    ).drop("position")


def limit_source_rows(rows: DataFrame, n: int, seq: str = "seq") -> DataFrame:
    """The first ``n`` source rows in ``seq`` order, counted before any validation."""
    return first_rows(rows, n, seq)
