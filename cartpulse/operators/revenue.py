"""Purchase revenue by product attributes."""

from pyspark.sql import DataFrame, functions as F


def revenue_by(events: DataFrame, *groups: str) -> DataFrame:
    """Purchases and revenue per group. Amounts are added as decimals of twelve places, so the sum
    keeps every digit of a price and does not depend on the order in which partitions arrive."""
    amount = F.col("price").cast("decimal(38,12)")
    return (
        events.filter(F.col("event_type") == "purchase")
        .groupBy(*groups)
        .agg(
            F.count("*").alias("purchases"),
            F.coalesce(F.sum(amount).cast("double"), F.lit(0.0)).alias("revenue"),
        )
    )
