"""Live cart abandonment: open carts kept from micro-batch to micro-batch, judged by the clock of the stream.

Each (session, product) pair keeps its open cart and the actions the clock has not passed yet. An
action takes effect once the clock of the stream passes it, in order of time and ``seq``, so
the order in which micro-batches bring them does not matter within the allowed lateness. An
open cart gives its signal, once, when the clock passes its deadline. Pairs without an open cart or waiting actions
hold no state. Every change is a row, from which pending and signalled carts are counted.

A micro-batch takes all its pairs together: what is kept and what is new go through one window by pair, on all
cores and on disk where memory ends. State is rewritten by every micro-batch, so its cost grows with the carts that
are open and the actions that wait, not with the age of the stream.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartpulse.functions.timebuckets import micros_of
from cartpulse.operators.abandonment import ACTIONS, PAIR
from cartpulse.schema import ABANDONMENT_TIMEOUT

OPENED, CLOSED, SIGNALLED = "opened", "closed", "signalled"
CHANGES = (OPENED, CLOSED, SIGNALLED)
HELD, WAITING = "held", "waiting"
_DELAY = "spark.watermarkDelayMs"  # where a column on a clock names its lateness


def cart_changes(events: DataFrame, timeout: str = ABANDONMENT_TIMEOUT) -> DataFrame:
    """What ``outputs.live_carts`` follows the carts of a stream by, of valid events on a clock (``inputs.on_clock``): the
    actions of every pair, and of the other events nothing but their time, which moves the clock. Stored are
    ``session_id, product_id, change, cart_time, deadline``: a cart is opened, then either closed by the pair's next
    action or signalled at its deadline."""
    delay = events.schema["event_time"].metadata[_DELAY]
    action = F.coalesce(F.col("event_type").isin(*ACTIONS), F.lit(False))
    return events.select(
        *PAIR, F.unix_micros("event_time").alias("micros"), F.col("seq").cast("bigint").alias("seq"),
        (F.col("event_type") == "cart").alias("is_cart"), action.alias("is_action"),
        F.lit(delay).cast("bigint").alias("delay_ms"), F.lit(micros_of(timeout)).cast("bigint").alias("timeout"),
    )


def clock_of() -> Column:
    """Aggregate of a micro-batch of ``cart_changes``: the newest event minus the lateness, in whole milliseconds as
    watermarks are; null without events."""
    return (F.max(F.floor(F.col("micros") / 1000)) - F.max("delay_ms")).cast("bigint") * 1000


def steps(kept: DataFrame | None, rows: DataFrame, before: int, now: int) -> DataFrame:
    """One micro-batch: what was ``kept`` and the new ``rows``, while the clock moves from ``before`` to ``now``
    (microseconds). Rows with ``outcome`` opened, closed or signalled are changes; held and waiting ones are kept for
    the next micro-batch. New actions behind the clock come too late and do not count."""
    columns = [*PAIR, "micros", "seq", "is_cart", "timeout"]
    new = rows.filter(F.col("is_action") & (F.col("micros") > before)).select(*columns, F.lit(WAITING).alias("outcome"))
    found = new if kept is None else kept.filter(F.col("outcome").isin(HELD, WAITING)).select(*new.columns).unionByName(new)
    held = F.col("outcome") == HELD
    passed = held | (F.col("micros") <= now)
    order = Window.partitionBy(*PAIR).orderBy(F.desc(held), "micros", "seq", "is_cart")
    # Those that the clock has passed come first in a pair, so the next action counts if the clock has passed it too.
    after = F.lead("micros").over(order)
    deadline = F.col("micros") + F.col("timeout")
    judged = found.withColumn("after", after).withColumn("after", F.when(F.col("after") <= now, F.col("after")))
    end = (
        F.when(F.col("after").isNotNull(), F.when(deadline <= F.col("after"), SIGNALLED).otherwise(CLOSED))
        .when(deadline <= now, SIGNALLED).otherwise(HELD)
    )
    outcomes = (
        F.when(~passed, F.array(F.lit(WAITING)))
        .when(held, F.array(end))
        .when(F.col("is_cart"), F.array(F.lit(OPENED), end))
    )
    return judged.select(*columns, F.explode(outcomes).alias("outcome"))


def changes_of(stepped: DataFrame) -> DataFrame:
    return stepped.filter(F.col("outcome").isin(*CHANGES)).select(
        *PAIR, F.col("outcome").alias("change"),
        F.timestamp_micros("micros").alias("cart_time"), F.timestamp_micros(F.col("micros") + F.col("timeout")).alias("deadline"),
    )
