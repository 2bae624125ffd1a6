"""Table and document writers."""

from pyspark.sql import Column, DataFrame, functions as F

from cartpulse.functions.timebuckets import utc_text
from cartpulse.operators.baseline import last_baseline_row
from cartpulse.sources.files import part_of, read_baseline

PARTS = 256


def write_baseline(baseline: DataFrame, path: str, json_files: int | None = None) -> None:
    """Baseline by product as Parquet under ``/parquet`` and as JSON under ``/json``.

    The JSON copy is read back from the Parquet one, so the baseline is computed once.
    ``json_files=1`` gives a single file, which funnels all products through one task:
    only for baselines that fit there.
    """
    root = path.rstrip("/")
    baseline.orderBy("product_id").write.mode("overwrite").parquet(f"{root}/parquet")
    stored = read_baseline(baseline.sparkSession, f"{root}/parquet").orderBy("product_id")
    if json_files is not None:
        stored = stored.coalesce(json_files)
    stored.write.mode("overwrite").option("ignoreNullFields", False).json(f"{root}/json")


def write_laid_out(baseline: DataFrame, path: str, order: str | None = None, parts: int = PARTS) -> None:
    """A baseline for serving: one row per product (the last by ``order`` where products repeat), in ``parts``
    folders by hash of the product, each sorted by product. ``sources.files.read_laid_out`` opens
    only the folders it needs."""
    rows = last_baseline_row(baseline, order) if order else baseline
    part = part_of(F.col("product_id"), parts)
    laid = rows.withColumns({"parts": F.lit(parts), "part": part}).repartition("part").sortWithinPartitions("part", "product_id")
    laid.write.mode("overwrite").partitionBy("parts", "part").parquet(path)


def write_interpreted(rows: DataFrame, path: str) -> None:
    """Accepted events and rejects side by side from one pass over the source: folders
    ``status=accepted`` and ``status=rejected``."""
    status = F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")
    rows.withColumn("status", status).write.mode("overwrite").partitionBy("status").parquet(path)


def write_archive(events: DataFrame, path: str) -> None:
    """Canonical events by date, for pruned reads of history."""
    dated = events.withColumn("event_date", F.to_date("event_time"))
    dated.write.mode("append").partitionBy("event_date").parquet(path)


def write_document(document: DataFrame, path: str) -> None:
    """A one-row document as JSON, times as ISO text."""
    document.select(document_json(document).alias("value")).write.mode("overwrite").text(path)


def document_json(document: DataFrame) -> Column:
    """The row as JSON text with nulls written out."""
    fields = [
        utc_text(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in document.schema.fields
    ]
    return F.to_json(
        F.struct(*fields),
        {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]xxx"},
    )


def write_table_csv(table: DataFrame, path: str, order: tuple[str, ...] = ()) -> None:
    """An experiment table with header, its rows and files in ascending ``order`` where given
    (completion time of runs, rates, worker counts)."""
    table = table.orderBy(*order) if order else table
    exact = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    writer = table.write.mode("overwrite").option("header", True)
    writer.option("timestampFormat", exact).csv(path)
