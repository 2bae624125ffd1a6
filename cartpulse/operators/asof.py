"""Forward as-of lookup on one global clock."""

from pyspark.sql import DataFrame, Window, functions as F

from cartpulse.functions.timebuckets import slot_of, whole_div

_SECOND = 1_000_000
_DAY_SECONDS = 86_400


def first_at_or_after(points: DataFrame, probes: DataFrame) -> DataFrame:
    """For each distinct probe time the first point time that is not earlier.

    ``points`` and ``probes`` are one-column DataFrames of timestamps; the result has
    ``probe`` and ``found`` (null when no point follows).

    Every window is bounded by the clock, not by the data: times are made distinct
    first, so a second holds at most a million of them, a day holds 86,400 seconds,
    and the last window runs over days. However many rows share a moment, they arrive
    as one, and moments are sorted only in seconds that hold a probe.
    """
    point, probe = points.columns[0], probes.columns[0]
    second = slot_of(F.col("t"), _SECOND).alias("second")
    at_points, at_probes = points.select(F.col(point).alias("t")), probes.select(F.col(probe).alias("t"))
    # Only points in a second with a probe are looked at one by one.
    probed = at_probes.select(second).distinct()
    near = at_points.select("t", second).join(probed, "second", "left_semi")
    marks = (
        near.select("t", F.lit(True).alias("is_point"))
        .unionAll(at_probes.select("t", F.lit(False)))
        .groupBy(second, "t")
        .agg(F.max("is_point").alias("is_point"), (~F.min("is_point")).alias("is_probe"))
    )
    # Descending, so that "at or after" is the running frame and stays linear.
    inside = Window.partitionBy("second").orderBy(F.desc("t")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    looked_up = marks.withColumn(
        "here", F.min(F.when(F.col("is_point"), F.col("t"))).over(inside)
    ).filter("is_probe")

    # First point after each second that holds a point or a probe. Reduced straight from
    # the input: the seconds are far fewer than the distinct times.
    later_seconds = Window.partitionBy("day").orderBy(F.desc("second")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    later_days = Window.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, -1)
    day = whole_div(F.col("second") - F.pmod("second", F.lit(_DAY_SECONDS)), _DAY_SECONDS)
    seconds = (
        at_points.select(second, "t")
        .unionAll(at_probes.select(second, F.lit(None).cast("timestamp")))
        .groupBy("second")
        .agg(F.min("t").alias("first_point"))
        .withColumn("day", day)
    )
    days = (
        seconds.groupBy("day")
        .agg(F.min("first_point").alias("day_first"))
        .select("day", F.min("day_first").over(later_days).alias("next_day_first"))
    )
    following = (
        seconds.withColumn("next_in_day", F.min("first_point").over(later_seconds))
        .join(days, "day")
        .select("second", F.coalesce("next_in_day", "next_day_first").alias("later"))
    )
    return looked_up.join(following, "second").select(
        F.col("t").alias("probe"), F.coalesce("here", "later").alias("found")
    )
