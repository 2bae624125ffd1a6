"""Cart abandonment: carts that nothing followed within the timeout.

A cart of a (session, product) pair is abandoned when the pair's next cart, removal or
purchase comes at or after the deadline (cart time + timeout) or never, and the clock
has reached the deadline. Re-adding a product restarts its timer; a later purchase does
not take a signal back.

Time is cut into slots as wide as the timeout. Two actions in one slot are less than a
timeout apart, so only the last action of a pair in a slot can be an abandoned cart, and
its successor is the first action of the pair's next slot. The actions are therefore
reduced to one row per pair and slot by an ordinary aggregation, which combines before
the exchange: a pair that owns a large share of all events shrinks to at most one row
per slot of the covered time span, and only those rows go through a window.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartpulse.functions.timebuckets import interval, micros_of, slot_of, stream_key
from cartpulse.operators.asof import first_at_or_after
from cartpulse.schema import ABANDONMENT_TIMEOUT, LATEST_SIGNALS

ACTIONS = ("cart", "remove_from_cart", "purchase")
PAIR = ("session_id", "product_id")


def last_cart_columns() -> list[Column]:
    """Aggregates that tell whether a group of actions ends with a cart: the time of its
    last cart, and the stream position of its last cart and of its last other action.
    ``seq`` settles actions with the same time, in stream order."""
    cart = F.col("event_type") == "cart"
    position = stream_key(F.col("event_time"), F.col("seq"))
    return [
        F.max(F.when(cart, F.col("event_time"))).alias("cart_time"),
        F.max(F.when(cart, position)).alias("cart_position"),
        F.max(F.when(~cart, position)).alias("other_position"),
    ]


def ends_with_cart() -> Column:
    return F.col("cart_position").isNotNull() & (
        F.col("other_position").isNull() | (F.col("cart_position") > F.col("other_position"))
    )


def last_carts(events: DataFrame, timeout: str = ABANDONMENT_TIMEOUT) -> DataFrame:
    """Carts that end their slot, and when their pair acted next."""
    at = F.col("event_time")
    slots = (
        events.filter(F.col("event_type").isin(*ACTIONS))
        .groupBy(*PAIR, slot_of(at, micros_of(timeout)).alias("slot"))
        .agg(F.min(at).alias("first_time"), *last_cart_columns())
    )
    following = F.lead("first_time").over(Window.partitionBy(*PAIR).orderBy("slot"))
    return (
        slots.select(*PAIR, "cart_time", ends_with_cart().alias("is_cart"), following.alias("next_time"))
        .filter("is_cart")
        .drop("is_cart")
    )


def _clock(events: DataFrame, timeout: str, flush: bool) -> Column:
    now = F.max("event_time")
    return events.agg((now + interval(timeout) if flush else now).alias("clock")).scalar()


def overdue_carts(
    events: DataFrame, timeout: str = ABANDONMENT_TIMEOUT, flush: bool = False
) -> DataFrame:
    """One row per abandoned cart: ``session_id, product_id, cart_time, deadline``.

    ``flush`` pushes the clock past the last event by one timeout, so that every cart left
    open counts."""
    return (
        last_carts(events, timeout)
        .withColumn("deadline", F.col("cart_time") + interval(timeout))
        .filter(F.col("next_time").isNull() | (F.col("next_time") >= F.col("deadline")))
        .filter(F.col("deadline") <= _clock(events, timeout, flush))
        .select(*PAIR, "cart_time", "deadline")
    )


def with_detection(overdue: DataFrame, events: DataFrame, end: Column) -> DataFrame:
    """Adds ``detected_at``: the first event of any kind at or after the deadline, the
    moment a processor that only moves with the events would notice, or the clock ``end``
    where no event follows."""
    seen = first_at_or_after(events.select("event_time"), overdue.select("deadline"))
    found = F.coalesce("found", end)
    return overdue.join(seen, F.col("deadline") == F.col("probe")).select(
        *PAIR, "cart_time", "deadline", found.alias("detected_at")
    )


def abandoned_carts(
    events: DataFrame, timeout: str = ABANDONMENT_TIMEOUT, flush: bool = False
) -> DataFrame:
    """One signal per abandoned cart, with its detection time."""
    overdue = overdue_carts(events, timeout, flush)
    return with_detection(overdue, events, _clock(events, timeout, flush))


def pending_carts(
    events: DataFrame, timeout: str = ABANDONMENT_TIMEOUT, flush: bool = False
) -> DataFrame:
    """Carts nothing has followed yet and whose deadline is still ahead of the clock."""
    return (
        last_carts(events, timeout)
        .filter(F.col("next_time").isNull())
        .withColumn("deadline", F.col("cart_time") + interval(timeout))
        .filter(F.col("deadline") > _clock(events, timeout, flush))
        .select(*PAIR, "cart_time", "deadline")
    )


def latest_abandoned_carts(
    events: DataFrame,
    timeout: str = ABANDONMENT_TIMEOUT,
    n: int = LATEST_SIGNALS,
    flush: bool = False,
) -> DataFrame:
    """The last ``n`` signals, oldest first; signals detected together are ordered by cart
    time, session and product.

    A later deadline is never detected earlier, so ordering by cart time is the same. The
    ``n`` carts are chosen first, and only the events after the earliest of their deadlines
    are searched.
    """
    order = ("cart_time", *PAIR)
    latest = overdue_carts(events, timeout, flush).orderBy(*[F.desc(c) for c in order]).limit(n)
    first_deadline = latest.agg(F.min("deadline")).scalar()
    tail = events.filter(F.col("event_time") >= first_deadline)
    return with_detection(latest, tail, _clock(events, timeout, flush)).orderBy(*order)
