"""Historical per-product baseline and session funnel."""

from pyspark.sql import DataFrame, functions as F

from cartpulse.functions.metrics import historical_dropoff, stage_counts, trend_score
from cartpulse.functions.timebuckets import history_clock, micros_of
from cartpulse.schema import BASELINE_SCHEMA, WINDOW

_ACTIVITY = ("views", "carts", "purchases")
# grouping_id() over (product_id, window_start, session_id): a set bit marks a
# column that is not part of the grouping set.
_WINDOW_CELL = 0b001
_SESSION_CELL = 0b010


def window_counts(events: DataFrame, window: str = WINDOW) -> DataFrame:
    """Events per product and tumbling window of the history clock, one column per type."""
    return (
        events.groupBy(
            "product_id", F.window(history_clock(), window).getField("start").alias("window_start")
        )
        .agg(*stage_counts(F.col("event_type")))
        .withColumn("trend_score", trend_score(*[F.col(c) for c in _ACTIVITY]))
    )


def product_activity(windows: DataFrame) -> DataFrame:
    """Averages over the observed windows, totals, and the number of windows."""
    return windows.groupBy("product_id").agg(
        *[F.avg(c).alias(f"avg_{c}_5m") for c in (*_ACTIVITY, "trend_score")],
        *[F.sum(c).alias(f"total_{c}") for c in _ACTIVITY],
        F.count("*").alias("observed_5m_windows"),
    )


def session_funnel(events: DataFrame) -> DataFrame:
    """Distinct sessions per product and stage.

    Two levels instead of three distinct counts: a session is first reduced to one
    row of flags, which also flattens a session or product that dominates the data.
    """
    kinds = ("view", "cart", "purchase")
    flags = events.groupBy("product_id", "session_id").agg(
        *[F.max(F.col("event_type") == kind).alias(kind) for kind in kinds]
    )
    return flags.groupBy("product_id").agg(
        *[F.count_if(F.col(kind)).alias(f"{kind}_sessions") for kind in kinds]
    )


def with_dropoffs(funnel: DataFrame) -> DataFrame:
    views, carts, purchases = (F.col(f"{s}_sessions") for s in ("view", "cart", "purchase"))
    return funnel.withColumns(
        {
            "historical_view_to_cart_dropoff": historical_dropoff(views, carts),
            "historical_cart_to_purchase_dropoff": historical_dropoff(carts, purchases),
        }
    )


def join_baseline(activity: DataFrame, funnel: DataFrame) -> DataFrame:
    """Left join of activity and funnel, when the two are kept as separate tables.
    Both sides hold one row per product."""
    return with_dropoffs(activity.join(funnel, "product_id", "left")).select(
        *BASELINE_SCHEMA.fieldNames()
    )


def baseline(
    events: DataFrame,
    window: str = WINDOW,
    include_empty: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """The whole baseline, one row per product.

    Equal to ``join_baseline(product_activity(window_counts(e)), session_funnel(e))``
    but the events are scanned and shuffled once: the two groupings are computed as
    grouping sets, and a second aggregation by product folds both kinds of cell.
    Each level combines before its exchange, so a product with a large share of all
    events reaches its reducer as a few partial rows.

    ``include_empty`` divides by every window between the first and last window of
    the data instead of the observed ones. ``partitions`` repartitions the events by
    product first; it exists for partition-count experiments and is best left unset,
    because it moves raw rows and piles a hot product onto one task.
    """
    if partitions:
        events = events.repartition(partitions, "product_id")
    keyed = events.select(
        "product_id",
        F.window(history_clock(), window).getField("start").alias("window_start"),
        "session_id",
        "event_type",
    )
    keys = ("product_id", "window_start", "session_id")
    cells = keyed.groupingSets(
        [["product_id", "window_start"], ["product_id", "session_id"]], *keys
    ).agg(*stage_counts(F.col("event_type")), F.grouping_id().alias("cell"))

    in_window, in_session = F.col("cell") == _WINDOW_CELL, F.col("cell") == _SESSION_CELL
    totals = cells.groupBy("product_id").agg(
        *[F.sum(F.when(in_window, F.col(c)).otherwise(0)).alias(f"total_{c}") for c in _ACTIVITY],
        F.count_if(in_window).alias("observed_5m_windows"),
        *[
            F.count_if(in_session & (F.col(c) > 0)).alias(f"{c.rstrip('s')}_sessions")
            for c in _ACTIVITY
        ],
    )
    if include_empty:
        span = keyed.agg(
            F.call_function(
                "div",
                F.unix_micros(F.max("window_start")) - F.unix_micros(F.min("window_start")),
                F.lit(micros_of(window)),
            )
            + 1
        )
        windows = span.scalar()
    else:
        windows = F.col("observed_5m_windows")
    score = trend_score(*[F.col(f"total_{c}") for c in _ACTIVITY])
    averages = {f"avg_{c}_5m": F.col(f"total_{c}") / windows for c in _ACTIVITY}
    averages["avg_trend_score_5m"] = score / windows
    return with_dropoffs(totals.withColumns(averages)).select(*BASELINE_SCHEMA.fieldNames())


def last_baseline_row(baselines: DataFrame, order: str) -> DataFrame:
    """One row per product from a baseline table that may repeat a product: the row
    with the highest ``order`` wins."""
    others = [c for c in baselines.columns if c not in ("product_id", order)]
    return (
        baselines.groupBy(F.col("product_id").cast("string").alias("product_id"))
        .agg(F.max_by(F.struct(*others), F.col(order)).alias("row"))
        .select("product_id", *[F.col(f"row.{c}").alias(c) for c in others])
    )
