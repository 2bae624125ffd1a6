"""Snapshot and serving documents: one nested row each."""

from pyspark.sql import Column, DataFrame, functions as F

from cartpulse import schema
from cartpulse.functions.timebuckets import interval, micros_of
from cartpulse.operators import abandonment, serving, trailing
from cartpulse.operators.baseline import baseline as build_baseline

_PRODUCT = ("product_id", "trend_score", "views", "carts", "purchases")
_FUNNEL = (
    "view_sessions", "cart_sessions", "purchase_sessions",
    "view_to_cart_dropoff", "cart_to_purchase_dropoff",
)
_SIGNAL = ("session_id", "product_id", "cart_time", "detected_at")
_TRENDING = (
    *_PRODUCT, "normal_views_5m", "normal_carts_5m", "normal_purchases_5m",
    "normal_trend_score_5m", "activity_lift", "is_unusually_trending",
)


def _listed(rows: DataFrame, fields: tuple[str, ...], sort_key: list[Column]) -> Column:
    """A short, already limited DataFrame as one array in the given order."""
    keyed = F.struct(F.struct(*sort_key).alias("k"), F.struct(*fields).alias("v"))
    ordered = F.sort_array(F.collect_list(keyed))
    return rows.agg(F.transform(ordered, lambda x: x["v"])).scalar()


def snapshot_document(
    events: DataFrame,
    window: str = schema.WINDOW,
    timeout: str = schema.ABANDONMENT_TIMEOUT,
    n: int = schema.TOP_N,
    flush: bool = False,
) -> DataFrame:
    """State of the trailing window at the last event, with the abandonment figures so
    far. ``flush`` moves the clock one timeout further, which empties the window. Without
    events the clock is null."""
    now = F.max("event_time") + interval(timeout) if flush else F.max("event_time")
    clock = events.agg(now.alias("as_of")).scalar() if flush else None
    recent = trailing.in_window(events, window, clock)
    products = trailing.product_counts(recent)
    kinds = dict(zip(schema.EVENT_TYPES, ("views", "carts", "removals", "purchases")))
    counted = F.create_map(
        *[x for kind, c in kinds.items() for x in (F.lit(kind), F.coalesce(F.sum(c), F.lit(0)))]
    )
    totals = products.agg(F.map_filter(counted, lambda _, v: v > 0)).scalar()
    stages = trailing.funnel(trailing.session_flags(recent))
    overdue = abandonment.overdue_carts(events, timeout, flush)
    open_carts = abandonment.pending_carts(events, timeout, flush)
    return (
        events.agg(
            now.alias("as_of"),
            F.lit(micros_of(window) // 1_000_000).cast("bigint").alias("window_seconds"),
            (now - interval(window)).alias("window_start"),
            F.count("*").alias("processed_events_total"),
        )
        .withColumns(
            {
                "event_totals": totals,
                "top_products": _listed(
                    trailing.top_products(products, n), _PRODUCT,
                    [-F.col("trend_score"), F.col("product_id")],
                ),
                "_stages": stages.agg(
                    F.first(F.struct("active_sessions", F.struct(*_FUNNEL).alias("funnel")))
                ).scalar(),
                "pending_carts": open_carts.agg(F.count("*")).scalar(),
                "abandoned_cart_signals_total": overdue.agg(F.count("*")).scalar(),
                "latest_abandoned_carts": _listed(
                    abandonment.latest_abandoned_carts(events, timeout, flush=flush), _SIGNAL,
                    [F.col(c) for c in ("cart_time", "session_id", "product_id")],
                ),
            }
        )
        .withColumns(
            {
                "events_in_window": F.aggregate(
                    F.map_values("event_totals"), F.lit(0).cast("bigint"), lambda a, x: a + x
                ),
                "active_sessions": F.col("_stages.active_sessions"),
                "funnel": F.col("_stages.funnel"),
            }
        )
        .select(*schema.SNAPSHOT_SCHEMA.fieldNames())
    )


def serving_document(
    snapshot: DataFrame, baseline: DataFrame, n: int = schema.TOP_N
) -> DataFrame:
    """The snapshot's top products against the baseline, ranked by lift."""
    recent = snapshot.select(F.inline("top_products"))
    ranked = serving.trending(recent, baseline, n)
    trending = _listed(
        ranked, _TRENDING,
        [-F.coalesce("activity_lift", F.lit(-1.0)), -F.col("trend_score"), F.col("product_id")],
    )
    return snapshot.select(
        "as_of",
        F.lit(schema.DEFINITION).alias("definition"),
        trending.alias("trending_products"),
        "funnel",
        "abandoned_cart_signals_total",
        F.struct("events_in_window", "processed_events_total").alias("performance"),
    )


def trending_now(
    events: DataFrame,
    history: DataFrame | None = None,
    window: str = schema.WINDOW,
    n: int = schema.TOP_N,
    candidates: int | None = None,
) -> DataFrame:
    """The flagship question: which products are unusually active right now? Events to
    ranked products, with the baseline taken from ``history`` (default: the same events). Only the history of
    recent products is aggregated."""
    recent = trailing.product_counts(trailing.in_window(events, window))
    if candidates is not None:
        recent = trailing.top_products(recent, candidates)
    history = serving.of_products(events if history is None else history, recent)
    normal = build_baseline(history, window)
    return serving.trending(recent, normal, n)
