"""Ingest quality figures."""

from pyspark.sql import DataFrame, functions as F

from cartpulse.functions.metrics import round_exact


def reject_reasons(interpreted: DataFrame) -> DataFrame:
    """Rows per reason; accepted rows count under ``accepted``."""
    return interpreted.groupBy(
        F.coalesce("reject_reason", F.lit("accepted")).alias("reason")
    ).agg(F.count("*").alias("rows"))


def ingest_summary(interpreted: DataFrame) -> DataFrame:
    """One row: source rows, accepted, rejected, and the reject rate in percent."""
    rejected = F.count("reject_reason")
    return interpreted.agg(
        F.count("*").alias("source_rows"),
        (F.count("*") - rejected).alias("accepted_rows"),
        rejected.alias("rejected_rows"),
    ).withColumn(
        "reject_rate_percent",
        F.when(
            F.col("source_rows") > 0,
            round_exact(F.col("rejected_rows") * 100.0 / F.col("source_rows"), 4),
        ),
    )
