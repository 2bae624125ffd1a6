"""File sources: shop CSV, canonical JSON lines, stored tables."""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from cartpulse import schema
from cartpulse.operators.normalise import interpret_payloads, interpret_shop_rows
from cartpulse.session import stored
from cartpulse.sources.records import decode_records

_CORRUPT = T.StructField("_corrupt_record", T.StringType())


def require_columns(present: list[str], required=schema.REQUIRED_CSV_COLUMNS) -> None:
    missing = sorted(set(required) - set(present))
    if missing:
        raise ValueError(f"Dataset is missing required columns: {missing}")


def with_source_rows(raw: DataFrame, first_row: int) -> DataFrame:
    """Adds ``source_file``, ``source_row`` (number in its file, counted from
    ``first_row``) and ``seq`` (0, 1, 2, … over all files in path order).

    A row's place inside its file split is known while the split is read, so it is enough
    to count the rows of each split; the rows are not shuffled. The rows are first copied
    to the shared folder together with their place: how Spark cuts and groups files may
    change between two reads, and a copy also spares the second parse. The table of
    splits, one row per file block, is stored too; with its size known, Spark broadcasts
    it below the broadcast limit and shuffles beyond.
    """
    rows = stored(
        raw.select(
            "*",
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_place"),
        ),
        "source-rows",
    )
    counts = stored(
        rows.groupBy(F.col("source_file").alias("_file"), F.col("_block").alias("_start")).agg(
            F.min("_place").alias("_first"), F.count("*").alias("_rows")
        ),
        "splits",
    )
    before = (Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("_file").orderBy("_start").rowsBetween(*before)
    overall = Window.orderBy("_file", "_start").rowsBetween(*before)
    splits = counts.select(
        "_file",
        "_start",
        "_first",
        F.coalesce(F.sum("_rows").over(in_file), F.lit(0)).alias("_in_file"),
        F.coalesce(F.sum("_rows").over(overall), F.lit(0)).alias("_overall"),
    )
    place = F.col("_place") - F.col("_first")
    same_split = (F.col("source_file") == F.col("_file")) & (F.col("_block") == F.col("_start"))
    return (
        rows.join(splits, same_split)
        .withColumn("source_row", place + F.col("_in_file") + first_row)
        .withColumn("seq", place + F.col("_overall"))
        .drop("_block", "_place", "_file", "_start", "_first", "_in_file", "_overall")
    )


def read_shop_csv(
    spark: SparkSession,
    paths: str | list[str],
    limit: int | None = None,
    numbered: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Interpreted rows of shop CSV files (plain or ``.gz``), columns found by header name.

    All columns are read as text and judged by the cleaning rules. ``limit`` counts source
    rows, rejects included. ``numbered=False`` leaves out row numbers and ``seq`` and reads
    the files in a single pass. Gzip files cannot be split: one task reads one file, so
    deliver many of them. ``multi_line`` allows line breaks inside quotes at the price of
    unsplit files.
    """
    raw = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(paths)
    )
    require_columns(raw.columns)
    if not numbered and limit is None:
        return interpret_shop_rows(raw)
    rows = with_source_rows(raw, first_row=2)
    if limit is not None:
        rows = rows.filter(F.col("seq") < limit)
    return interpret_shop_rows(rows)


def read_payload_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Interpreted rows of canonical JSON lines; blank lines are skipped, but count as lines.

    Follow with ``accepted(rows, on_invalid="fail")`` for the strict read."""
    lines = with_source_rows(spark.read.text(paths), first_row=1)
    return decode_records(lines.filter(F.trim("value") != ""), data="value", base64=False)


def read_history(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Interpreted JSON history for the batch baseline: one pass, no row numbers."""
    text = T.StructType([*schema.JSON_TEXT_SCHEMA.fields, _CORRUPT])
    return interpret_payloads(spark.read.schema(text).json(paths))


def read_archive(
    spark: SparkSession, path: str, since: dt.datetime | None = None, until: dt.datetime | None = None
) -> DataFrame:
    """Canonical events archived by date. The bounds prune date folders and reach the
    Parquet scan as pushed filters."""
    events = spark.read.schema(
        T.StructType(
            [
                *schema.EVENT_SCHEMA.fields,
                T.StructField("experiment_id", T.StringType()),
                T.StructField("seq", T.LongType()),
                T.StructField("event_date", T.DateType()),
            ]
        )
    ).parquet(path)
    if since is not None:
        events = events.filter(
            (F.col("event_date") >= F.lit(since.date())) & (F.col("event_time") >= F.lit(since))
        )
    if until is not None:
        events = events.filter(
            (F.col("event_date") <= F.lit(until.date())) & (F.col("event_time") <= F.lit(until))
        )
    return events


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """Baseline table written as Parquet."""
    return spark.read.schema(schema.BASELINE_SCHEMA).parquet(path)


def part_of(product: Column, parts: int) -> Column:
    """The folder of a product in a laid-out baseline."""
    return F.pmod(F.xxhash64(product.cast("string")), F.lit(parts)).cast("int")


def read_laid_out(spark: SparkSession, path: str, products: DataFrame) -> DataFrame:
    """Rows of a baseline written by ``sinks.tables.write_laid_out`` for these products (product_id): only the folders
    that can hold one are listed and opened, and the products filter their rows where they are read."""
    stored = spark.read.parquet(path)
    parts = stored.select("parts").first()
    if parts is None:
        return stored.drop("parts", "part")
    keys = products.select(F.col("product_id").cast("string").alias("_recent")).distinct()
    # At most as many numbers as there are folders.
    needed = [r.part for r in keys.select(part_of(F.col("_recent"), parts[0]).alias("part")).distinct().collect()]
    rows = stored.filter(F.col("part").isin(needed))
    return rows.join(keys, F.col("product_id") == F.col("_recent"), "left_semi").drop("parts", "part")


def read_baseline_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Baseline as one JSON array, or with ``lines`` one row per line; missing columns
    become null. An array file is read by a single task, so prefer lines."""
    reader = spark.read.schema(schema.BASELINE_SCHEMA).option("multiLine", not lines)
    return reader.json(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot documents written as JSON."""
    return spark.read.schema(schema.SNAPSHOT_SCHEMA).option("multiLine", True).json(path)


def read_table_csv(spark: SparkSession, path: str, table: T.StructType) -> DataFrame:
    """An experiment table (load runs, worker trials, batch results, worker samples) by
    header name: columns may come in any order and a column may be missing."""
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    return raw.select(
        *[
            (F.col(f.name) if f.name in raw.columns else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in table.fields
        ]
    )
