"""Running values over a stream order that is far too long for one task.

The rows are cut into chunks of about ``CHUNK`` rows along the order, whatever its values look
like: consecutive numbers, microseconds or hashes. Windows run inside chunks only; what earlier chunks
contribute comes from a table with one row per chunk, small enough for a single running window (a
trillion rows make about a million chunks).
"""

from pyspark.sql import DataFrame, Window, functions as F

from cartpulse.functions.timebuckets import whole_div
from cartpulse.session import stored

CHUNK = 1 << 20
_BEFORE = (Window.unboundedPreceding, -1)
_UPTO = (Window.unboundedPreceding, Window.currentRow)


def in_chunks(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``_chunk``: 0, 1, 2, … along the order columns, about ``CHUNK`` rows each; rows with equal order
    stay together. The cuts are those of a range partitioning, which samples the order. The rows are
    written once, so that everything made of them sees the same cuts; what fits one chunk is not."""
    chunks = -(-rows.count() // CHUNK)
    if chunks <= 1:
        return rows.withColumn("_chunk", F.lit(0))
    return stored(rows.repartitionByRange(chunks, *order).withColumn("_chunk", F.spark_partition_id()), "chunks")


def running_sums(
    chunks: DataFrame, values: list[str], order: list[str], keys: tuple[str, ...] = (), suffix: str = ""
) -> DataFrame:
    """Adds to rows of ``in_chunks`` the sums of ``values`` over all rows up to each one, by ``keys``: each
    under its name and ``suffix``. Rows of equal order must agree in nothing but values that
    nobody reads."""
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(*_BEFORE)
    carry = (
        chunks.groupBy(*keys, "_chunk")
        .agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
        .select(*keys, "_chunk", *[F.coalesce(F.sum(f"_sum_{v}").over(earlier), F.lit(0)).alias(f"_sum_{v}") for v in values])
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(*_UPTO)
    here = chunks.withColumns({f"_here_{v}": F.sum(v).over(inside) for v in values})
    added = {f"{v}{suffix}": F.col(f"_here_{v}") + F.col(f"_sum_{v}") for v in values}
    return here.join(carry, [*keys, "_chunk"]).withColumns(added).drop(*[f"_{k}_{v}" for k in ("here", "sum") for v in values])


def first_rows(rows: DataFrame, n: int, seq: str = "seq") -> DataFrame:
    """The first ``n`` rows in ``seq`` order. Numbers are counted first, by ranges of ``CHUNK``, over ``seq``
    alone; only the ranges that hold the rows are read whole, and only they are shuffled."""
    if n <= 0:
        return rows.limit(0)
    number = whole_div(F.col(seq), CHUNK)
    counts = rows.groupBy(number.alias("_range")).agg(F.count("*").alias("_rows"))
    upto = Window.orderBy("_range").rowsBetween(*_UPTO)
    filled = counts.withColumn("_all", F.sum("_rows").over(upto)).filter(F.col("_all") >= n)
    last = filled.agg((F.min("_range") + 1) * CHUNK).scalar()
    start = rows.filter(F.col(seq) < F.coalesce(last, F.lit((1 << 63) - 1)))
    return with_position(start, seq).filter(F.col("position") < n).drop("position")


def with_position(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """Adds ``position``: 0, 1, 2, … in ``seq`` order, without gaps."""
    chunks = in_chunks(rows, seq)
    carry = (
        chunks.groupBy("_chunk")
        .agg(F.count("*").alias("_summary"))
        .select(
            "_chunk",
            F.sum("_summary").over(Window.orderBy("_chunk").rowsBetween(*_BEFORE)).alias("_earlier"),
        )
    )
    within = Window.partitionBy("_chunk").orderBy(seq)
    return (
        chunks.withColumn("_inside", F.row_number().over(within))
        .join(carry, "_chunk")
        .withColumn("position", F.col("_inside") - 1 + F.coalesce("_earlier", F.lit(0)))
        .drop("_chunk", "_inside", "_earlier")
    )


def with_latest_before(rows: DataFrame, value: str, seq: str = "seq") -> DataFrame:
    """Adds ``latest_before``: the largest ``value`` among all earlier rows."""
    chunks = in_chunks(rows, seq)
    carry = (
        chunks.groupBy("_chunk")
        .agg(F.max(value).alias("_summary"))
        .select(
            "_chunk",
            F.max("_summary").over(Window.orderBy("_chunk").rowsBetween(*_BEFORE)).alias("_earlier"),
        )
    )
    within = Window.partitionBy("_chunk").orderBy(seq).rowsBetween(*_BEFORE)
    return (
        chunks.withColumn("_inside", F.max(value).over(within))
        .join(carry, "_chunk")
        .withColumn("latest_before", F.greatest("_inside", "_earlier"))
        .drop("_chunk", "_inside", "_earlier")
    )


def with_previous(rows: DataFrame, value: str, seq: str = "seq") -> DataFrame:
    """Adds ``previous``: ``value`` of the row just before, null for the first row."""
    chunks = in_chunks(rows, seq)
    carry = (
        chunks.groupBy("_chunk")
        .agg(F.max_by(value, seq).alias("_summary"))
        .select("_chunk", F.lag("_summary").over(Window.orderBy("_chunk")).alias("_earlier"))
    )
    within = Window.partitionBy("_chunk").orderBy(seq)
    return (
        chunks.withColumn("_inside", F.lag(value).over(within))
        .withColumn("_first", F.row_number().over(within) == 1)
        .join(carry, "_chunk")
        .withColumn("previous", F.when(F.col("_first"), F.col("_earlier")).otherwise(F.col("_inside")))
        .drop("_chunk", "_inside", "_earlier", "_first")
    )


def order_violations(events: DataFrame, time: str = "event_time", seq: str = "seq") -> DataFrame:
    """Events that would move the clock backwards: earlier than some event before them."""
    return with_latest_before(events, time, seq).filter(F.col(time) < F.col("latest_before"))


def require_ordered(events: DataFrame, time: str = "event_time", seq: str = "seq") -> DataFrame:
    """The events unchanged; the job fails when one of them is out of order."""
    checked = with_latest_before(events, time, seq)
    late = F.coalesce(F.col(time) < F.col("latest_before"), F.lit(False))
    message = F.concat(F.lit("events must be ordered by event_time; out of order: "), F.col(seq))
    keep = F.when(late, F.raise_error(message).cast("boolean")).otherwise(True)
    return checked.filter(keep).drop("latest_before")
