"""What the corpus operators share: tables, fold rules, Arrow batches and word splitting."""

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows per Arrow batch handed to Python: whole texts are long, so batches stay small.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of whole texts can hold in a worker, by rows and by bytes. The settings stay in
    the session: plans are lazy, and Spark reads them when a job starts."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        if spark.conf.get(key, None) != str(most):
            spark.conf.set(key, str(most))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def utf8(text: Column) -> Column:
    """The text as bytes; null is empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def words_of(text: bytes) -> list[bytes]:
    """Maximal runs of bytes other than space and 0x09-0x0D."""
    return text.split()


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [
        column if isinstance(column, pa.Array) else pa.array(column, field.type)
        for column, field in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
