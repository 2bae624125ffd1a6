"""Analysis of load runs, worker trials, latency logs and cluster samples."""

from pyspark.sql import Column, DataFrame, functions as F

from cartpulse.functions.metrics import round_exact
from cartpulse.functions.timebuckets import latency_ms, minute_of
from cartpulse.operators.ordered import with_previous
from cartpulse.session import stored

CELLS = 512


def parse_latency_log(log: DataFrame, message: str = "message", experiment_id: str | None = None) -> DataFrame:
    """Latency numbers found in log lines, optionally only of lines that mention one
    experiment. Lines without a number are left out."""
    line = F.col(message)
    lines = log if experiment_id is None else log.filter(line.contains(experiment_id))
    return (
        lines.withColumn(
            "latency_ms", F.regexp_extract(line, r'"latency_ms":([0-9]+)', 1).try_cast("bigint")
        )
        .withColumn("experiment_id", F.get_json_object(line, "$.experiment_id"))
        .filter(F.col("latency_ms").isNotNull())
    )


def percentiles(
    rows: DataFrame, groups: list[str], value: str, points: dict[str, float], *others: Column
) -> DataFrame:
    """Exact interpolated percentiles of the known values per group, named by ``points``.

    Rows are first counted per distinct value, which combines before the exchange. The values at the
    wanted ranks are then found by selection (``values_at``), without sorting a group. ``others``
    are further aggregates over the counted rows, which carry the column ``rows``.
    """
    known = rows.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    counted = stored(known.groupBy(*groups, value).agg(F.count("*").alias("rows")), "values")
    totals = counted.groupBy(*groups).agg(F.sum("rows").alias("rows"), *others)
    last = F.col("rows") - 1
    ranks = [f(F.lit(share) * last) for share in points.values() for f in (F.floor, F.ceil)]
    keyed = lambda df: df.withColumn("_group", F.struct(F.lit(0).alias("_"), *groups))
    wanted = keyed(totals).select("_group", F.array_distinct(F.array(*ranks)).alias("ranks"))
    found = values_at(keyed(counted).select("_group", F.col(value).alias("value"), "rows"), wanted)
    looked_up = found.groupBy("_group").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", F.col("value").cast("double")))).alias("_at")
    )
    results = []
    for name, share in points.items():
        rank = F.lit(share) * last
        below, above = F.floor(rank), F.ceil(rank)
        low, high = F.col("_at")[below], F.col("_at")[above]
        mixed = (above - rank) * low + (rank - below) * high
        results.append(F.when(rank - below == 0, low).otherwise(mixed).alias(name))
    return keyed(totals).join(looked_up, "_group").select(*totals.columns, *results)


def values_at(counted: DataFrame, wanted: DataFrame) -> DataFrame:
    """(_group, rank, value): the value at each wanted rank, from 0, among the rows of a group in order.

    ``counted`` has _group, value and its number of rows, ``wanted`` _group and an array of ranks. The range of
    values that holds a rank is cut into ``CELLS`` of equal width, rows are counted by cell, and only the cell
    with the rank is looked at again, from its lowest to its highest value, until that is one value.
    Every pass is one aggregation of at most ``CELLS`` rows a range, whatever a group holds."""
    whole = counted.groupBy("_group").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.lit(0).cast("bigint").alias("before")
    )
    ranges = stored(whole.join(wanted, "_group"), "ranges")
    found = []
    while True:
        single = ranges.filter("low = high")
        found.append(single.select("_group", F.explode("ranks").alias("rank"), F.col("low").alias("value")))
        wide = ranges.filter("low < high")
        if wide.isEmpty():
            break
        place = (F.col("value") - F.col("low")).cast("double") / (F.col("high") - F.col("low")).cast("double")
        cell = F.least(F.floor(place * CELLS), F.lit(CELLS - 1)).alias("cell")
        key = ["_group", "low", "before"]
        cells = (
            counted.join(wide.select(*key, "high"), "_group")
            .filter("value BETWEEN low AND high")
            .groupBy(*key, cell)
            .agg(F.sum("rows").alias("n"), F.min("value").alias("from"), F.max("value").alias("to"))
        )
        listed = cells.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("cell", "n", "from", "to"))).alias("cells"))
        # Cells with the number of rows before each one.
        summed = listed.withColumn(
            "cells",
            F.expr(
                "transform(cells, (c, i) -> struct(c.from AS low, c.to AS high, c.n AS n, "
                "before + aggregate(slice(cells, 1, i), 0L, (a, x) -> a + x.n) AS before))"
            ),
        )
        ranked = wide.select(*key, F.explode("ranks").alias("rank")).join(summed, key)
        holder = ranked.select(
            "_group", "rank", F.inline(F.filter("cells", lambda c: (c["before"] <= F.col("rank")) & (F.col("rank") < c["before"] + c["n"])))
        )
        ranges = stored(holder.groupBy("_group", "low", "high", "before").agg(F.collect_set("rank").alias("ranks")), "ranges")
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result


def latency_statistics(records: DataFrame, *groups: str) -> DataFrame:
    """Count, mean, median, 95th percentile and maximum of ``latency_ms`` per group."""
    value = F.col("latency_ms")
    return percentiles(
        records,
        list(groups),
        "latency_ms",
        {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95},
        (F.sum(value * F.col("rows")) / F.sum("rows")).alias("avg_latency_ms"),
        F.max(value).alias("max_latency_ms"),
    ).withColumnRenamed("rows", "processed")


def backlog_age(events: DataFrame) -> DataFrame:
    """Largest processing delay per minute of processing, in milliseconds."""
    delay = latency_ms(F.col("processed_at"), F.col("event_time"))
    return events.groupBy(minute_of(F.col("processed_at")).alias("minute")).agg(
        F.max(delay).alias("max_age_ms")
    )


def largest_backlog_age(events: DataFrame) -> DataFrame:
    return backlog_age(events).agg(F.max("max_age_ms").alias("max_iterator_age_ms"))


def with_throughput(runs: DataFrame) -> DataFrame:
    """Producer seconds and throughput as reported: 3 and 2 decimals."""
    seconds = F.col("producer_seconds")
    rate = F.when(seconds > 0, F.col("sent_records") / seconds)
    return runs.withColumns(
        {
            "producer_throughput_eps": round_exact(rate, 2),
            "producer_seconds": round_exact(seconds, 3),
        }
    )


def complete_runs(runs: DataFrame) -> DataFrame:
    """Runs in which everything sent was processed and a latency was measured."""
    return runs.filter(
        F.col("p95_latency_ms").isNotNull()
        & F.col("completed_at_utc").isNotNull()
        & (F.col("processed_records") == F.col("sent_records"))
    )


def load_run_summary(runs: DataFrame) -> DataFrame:
    """Medians per target rate over the complete runs."""
    figures = ["p50_latency_ms", "p95_latency_ms", "producer_throughput_eps"]
    long = complete_runs(runs).unpivot("target_rate_eps", figures, "figure", "value")
    medians = percentiles(long, ["target_rate_eps", "figure"], "value", {"median": 0.5})
    return medians.groupBy("target_rate_eps").agg(
        F.max("rows").alias("complete_runs"),
        *[F.max(F.when(F.col("figure") == f, F.col("median"))).alias(f) for f in figures],
    )


def throughput_over_time(runs: DataFrame) -> DataFrame:
    """Complete runs with the minutes elapsed since the first one finished."""
    complete = complete_runs(runs)
    first = complete.agg(F.min("completed_at_utc").alias("first")).scalar()
    micros = F.unix_micros("completed_at_utc") - F.unix_micros(first)
    return complete.select(
        "experiment_id",
        "completed_at_utc",
        (micros / 6e7).alias("elapsed_minutes"),
        "producer_throughput_eps",
    )


def worker_speedup(trials: DataFrame) -> DataFrame:
    """Median duration per worker count, with speedup and efficiency relative to the
    smallest count. Trials without a status count as completed. With fewer than two
    worker counts there is no curve and the result is empty."""
    status = F.upper(F.coalesce("status", F.lit("COMPLETED"))) if "status" in trials.columns else F.lit("COMPLETED")
    completed = trials.filter(
        (status == "COMPLETED") & (F.col("worker_count") > 0) & (F.col("duration_seconds") > 0)
    )
    medians = percentiles(
        completed, ["worker_count"], "duration_seconds", {"median_seconds": 0.5}
    ).withColumnRenamed("rows", "trials")
    smallest = medians.agg(
        F.min(F.struct("worker_count", "median_seconds")).alias("base")
    ).scalar()
    counts = medians.agg(F.count("*")).scalar()
    workers = F.col("worker_count")
    return (
        medians.withColumn("base", smallest)
        .filter(counts >= 2)
        .select(
            "worker_count",
            "trials",
            "median_seconds",
            (F.col("base.median_seconds") / F.col("median_seconds")).alias("speedup"),
            (workers / F.col("base.worker_count")).alias("ideal_speedup"),
        )
        .withColumn("efficiency", F.col("speedup") / F.col("ideal_speedup"))
    )


def scaling_changes(samples: DataFrame, order: str = "elapsed_seconds") -> DataFrame:
    """Samples at which the total worker count differs from the sample before."""
    return (
        with_previous(samples, "total_workers", order)
        .filter(F.col("previous").isNotNull() & (F.col("previous") != F.col("total_workers")))
        .withColumnRenamed("previous", "previous_workers")
    )


def scaling_observed(samples: DataFrame) -> DataFrame:
    """One row: how many different worker counts were seen, and whether that is a change."""
    return samples.agg(
        F.count_distinct("total_workers").alias("distinct_worker_counts")
    ).withColumn("scaling_observed", F.col("distinct_worker_counts") > 1)
