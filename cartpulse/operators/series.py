"""The trailing window after every single event.

An event counts from its own place in the stream on, and no longer once an event comes more than the window
later. Both are marks on one line of time: plus one at the event, minus one just behind the end of its window, and the state
after an event is the sum of all marks up to it. Marks that take events away are summed by product and
moment first, so a moment that holds a third of all events leaves as one mark a product.
"""

from pyspark.sql import DataFrame, functions as F

from cartpulse.functions.metrics import trend_score
from cartpulse.functions.timebuckets import micros_of
from cartpulse.operators.ordered import in_chunks, running_sums
from cartpulse.schema import EVENT_TYPES, WINDOW

_COUNTS = dict(zip(EVENT_TYPES, ("views", "carts", "removals", "purchases")))
_LAST = (1 << 63) - 1


def trailing_series(events: DataFrame, window: str = WINDOW) -> DataFrame:
    """One row per event: ``seq, event_time, product_id``, the counts and score of its product in the
    window that ends with it, and ``events_in_window`` of all products.

    The window holds the events from ``event_time - window`` on, both ends included, that come
    no later in the order of time and ``seq``, which must be unique. An empty input gives an empty result."""
    known = events.filter(F.col("event_time").isNotNull() & F.col("seq").isNotNull())
    one = [F.when(F.col("event_type") == kind, 1).otherwise(0).cast("bigint").alias(c) for kind, c in _COUNTS.items()]
    came = known.select(
        "product_id", F.unix_micros("event_time").alias("at"), F.col("seq").cast("bigint").alias("tie"), "event_time", *one,
        F.lit(1).cast("bigint").alias("events"),
    )
    # Behind every event at the last moment of the window, ahead of the next moment.
    went = came.groupBy("product_id", (F.col("at") + micros_of(window)).alias("at")).agg(
        *[(-F.sum(c)).alias(c) for c in (*_COUNTS.values(), "events")]
    )
    marks = came.unionByName(
        went.withColumns({"tie": F.lit(_LAST), "event_time": F.lit(None).cast("timestamp")})
    )
    order = ["at", "tie"]
    chunks = in_chunks(marks, *order)
    of_all = running_sums(chunks, ["events"], order, suffix="_in_window")
    each = running_sums(of_all, list(_COUNTS.values()), order, ("product_id",), suffix="_now")
    counts = {c: F.col(f"{c}_now") for c in _COUNTS.values()}
    return each.filter(F.col("event_time").isNotNull()).select(
        F.col("tie").alias("seq"),
        "event_time",
        "product_id",
        *[n.alias(c) for c, n in counts.items()],
        trend_score(counts["views"], counts["carts"], counts["purchases"]).alias("trend_score"),
        "events_in_window",
    )
