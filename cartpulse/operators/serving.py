"""Recent activity against the historical baseline."""

from pyspark.sql import DataFrame, functions as F

from cartpulse.functions.metrics import activity_lift, is_unusual, round_exact
from cartpulse.operators.baseline import last_baseline_row
from cartpulse.operators.trailing import top_products
from cartpulse.schema import TOP_N, UNUSUAL_LIFT

_NORMAL = {
    "normal_views_5m": "avg_views_5m",
    "normal_carts_5m": "avg_carts_5m",
    "normal_purchases_5m": "avg_purchases_5m",
    "normal_trend_score_5m": "avg_trend_score_5m",
}


def of_products(rows: DataFrame, recent: DataFrame) -> DataFrame:
    """The rows whose product is among the recent ones. A semi join: few products are broadcast to the
    scan, by Spark's own check of their size; many meet the rows in a shuffle, behind a Bloom filter
    where Spark expects it to pay."""
    keys = recent.select(F.col("product_id").alias("_recent"))
    return rows.join(keys, F.col("product_id").cast("string") == F.col("_recent"), "left_semi")


def compare(
    recent: DataFrame, baseline: DataFrame, threshold: float = UNUSUAL_LIFT, order: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Every recent product with its normal activity, lift and flag.

    Left join on one row per product each side; a product without a baseline gets zero
    normal activity, no lift and no flag. Averages missing from the baseline table count
    as zero. Where the baseline repeats a product its last row counts: that with the highest
    ``order``, or without one the last row read. Only rows of recent products are aggregated, and
    the aggregation leaves them where the join needs them. ``unique`` says that the baseline repeats none.
    """
    if not unique:
        if order is None:
            order = "_row"
            baseline = baseline.withColumn(order, F.monotonically_increasing_id())
        baseline = last_baseline_row(of_products(baseline, recent), order)
    normal = baseline.select(
        "product_id",
        *[
            (F.col(c) if c in baseline.columns else F.lit(None)).cast("double").alias(c)
            for c in _NORMAL.values()
        ],
    )
    normal_score = F.coalesce("avg_trend_score_5m", F.lit(0.0))
    current = F.coalesce(F.col("trend_score"), F.lit(0)).cast("double")
    return (
        recent.join(normal, "product_id", "left")
        .withColumns(
            {
                "activity_lift": activity_lift(current, normal_score),
                "is_unusually_trending": is_unusual(current, normal_score, threshold),
                **{
                    name: round_exact(F.coalesce(F.col(c), F.lit(0.0)), 3)
                    for name, c in _NORMAL.items()
                },
            }
        )
        .withColumn("normal_score_exact", normal_score)
        .drop(*_NORMAL.values())
    )


def rank(compared: DataFrame, n: int = TOP_N) -> DataFrame:
    """Highest lift first, products without lift last; then score, then product."""
    return (
        compared.orderBy(
            F.desc_nulls_last("activity_lift"), F.desc("trend_score"), F.asc("product_id")
        )
        .limit(n)
        .drop("normal_score_exact")
    )


def trending(
    recent: DataFrame,
    baseline: DataFrame,
    n: int = TOP_N,
    candidates: int | None = None,
    threshold: float = UNUSUAL_LIFT,
) -> DataFrame:
    """Top ``n`` by lift. All recent products compete unless ``candidates`` first keeps
    only that many by score, which hides small products with a large lift."""
    if candidates is not None:
        recent = top_products(recent, candidates)
    return rank(compare(recent, baseline, threshold), n)


def threshold_sensitivity(compared: DataFrame, thresholds: list[float]) -> DataFrame:
    """Flagged products per threshold, counted in one pass over the comparison."""
    current, normal = F.col("trend_score").cast("double"), F.col("normal_score_exact")
    counts = compared.agg(
        F.count("*").alias("products"),
        F.array(
            *[
                F.struct(
                    F.lit(float(t)).alias("threshold"),
                    F.count_if(is_unusual(current, normal, t)).alias("flagged_products"),
                )
                for t in thresholds
            ]
        ).alias("per_threshold"),
    )
    return counts.select("products", F.inline("per_threshold"))
