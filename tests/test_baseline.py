import pytest
from pyspark.sql import functions as F

from conftest import events_of, naive
from cartpulse import schema
from cartpulse.operators import baseline, revenue
from cartpulse.sinks import tables
from cartpulse.sources import files


def rows(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()]


def joined(events, window=schema.WINDOW):
    activity = baseline.product_activity(baseline.window_counts(events, window))
    return baseline.join_baseline(activity, baseline.session_funnel(events))


def test_eight_events(eight):
    one, two = rows(baseline.baseline(eight), "product_id")
    assert one == {
        "product_id": "100", "avg_views_5m": 2.0, "avg_carts_5m": 2.0, "avg_purchases_5m": 1.0,
        "avg_trend_score_5m": 13.0, "total_views": 2, "total_carts": 2, "total_purchases": 1,
        "observed_5m_windows": 1, "view_sessions": 2, "cart_sessions": 2, "purchase_sessions": 1,
        "historical_view_to_cart_dropoff": 0.0, "historical_cart_to_purchase_dropoff": 0.5,
    }
    assert (two["observed_5m_windows"], two["avg_trend_score_5m"]) == (2, 2.5)
    assert (two["avg_views_5m"], two["avg_carts_5m"], two["avg_purchases_5m"]) == (1.0, 0.5, 0.0)
    assert (two["view_sessions"], two["cart_sessions"], two["purchase_sessions"]) == (2, 1, 0)
    assert (two["historical_view_to_cart_dropoff"], two["historical_cart_to_purchase_dropoff"]) == (0.5, 1.0)


def test_windows_are_half_open_on_the_utc_grid(spark):
    events = events_of(spark, [(4.999, "view", "1", "s"), (5, "view", "1", "s"), (9.999, "cart", "1", "s")])
    got = rows(baseline.window_counts(events), "window_start")
    assert [(r["window_start"], r["views"], r["carts"], r["trend_score"]) for r in got] == [
        (naive(0), 1, 0, 1), (naive(5), 1, 1, 4),
    ]


def test_source_clock_wins_over_the_replay_clock(spark):
    events = events_of(spark, [(100, "view", "1", "s"), (200, "view", "1", "s")], source_event_time=None)
    moved = events.withColumn("source_event_time", F.when(F.col("seq") == 0, F.lit(naive(200)).cast("timestamp")))
    assert baseline.baseline(moved).first().observed_5m_windows == 1


def test_removals_make_an_observed_window_but_no_score(spark):
    events = events_of(spark, [(0, "remove_from_cart", "1", "s"), (10, "view", "1", "s")])
    row = baseline.baseline(events).first()
    assert (row.observed_5m_windows, row.avg_trend_score_5m, row.total_views) == (2, 0.5, 1)
    assert row.historical_cart_to_purchase_dropoff is None


def test_more_carts_than_views_gives_a_negative_historical_dropoff(spark):
    events = events_of(spark, [(0, "view", "1", "a"), (1, "cart", "1", "a"), (1, "cart", "1", "b")])
    assert baseline.baseline(events).first().historical_view_to_cart_dropoff == -1.0


def test_empty_windows_can_be_counted(spark):
    events = events_of(spark, [(0, "view", "1", "s"), (16, "view", "2", "s")])
    got = rows(baseline.baseline(events, include_empty=True), "product_id")
    assert [(r["avg_views_5m"], r["observed_5m_windows"]) for r in got] == [(0.25, 1), (0.25, 1)]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the events belongs to one product and one session."""
    n = 30_000
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(n).select(
        F.timestamp_seconds(1569888000 + i).alias("event_time"),
        F.element_at(F.array(*map(F.lit, schema.EVENT_TYPES)), ((i * 7919) % 4 + 1).cast("int")).alias("event_type"),
        F.when(hot, "hot").otherwise((i % 97).cast("string")).alias("product_id"),
        F.when(hot, "hot").otherwise((i % 1009).cast("string")).alias("session_id"),
        F.timestamp_seconds(1569888000 + i).alias("source_event_time"),
        i.alias("seq"),
    )


def test_single_pass_equals_the_join_on_skewed_data(skewed):
    fused, apart = baseline.baseline(skewed), joined(skewed)
    assert fused.exceptAll(apart).count() == 0 and fused.count() == apart.count() == 98


def test_partition_count_does_not_change_the_result(skewed):
    assert baseline.baseline(skewed, partitions=3).exceptAll(baseline.baseline(skewed)).count() == 0


def test_a_hot_product_reaches_its_reducer_as_partial_rows(skewed):
    """Both exchanges carry aggregated rows, and there is one scan and no join."""
    plan = baseline.baseline(skewed)._jdf.queryExecution().executedPlan().toString()
    lines = [line.strip(" +-:*()0123456789") for line in plan.splitlines()]
    exchanges = [i for i, line in enumerate(lines) if line.startswith("Exchange")]
    assert len(exchanges) == 2 and all("partial_" in lines[i + 1] for i in exchanges)
    assert plan.count("Range (") == 1 and "Join" not in plan and plan.count("Expand") == 1


def test_copies_multiply_counts_but_not_sessions(eight):
    five = eight
    for _ in range(4):
        five = five.unionAll(eight)
    row = baseline.baseline(five).filter("product_id = '100'").first()
    assert (row.total_views, row.avg_trend_score_5m, row.view_sessions) == (10, 65.0, 2)


def test_written_baseline_reads_back(spark, eight, tmp_path):
    out = str(tmp_path / "base")
    result = baseline.baseline(eight)
    tables.write_baseline(result, out, json_files=1)
    assert files.read_baseline(spark, f"{out}/parquet").exceptAll(result).count() == 0
    lines = files.read_baseline_json(spark, f"{out}/json", lines=True)
    assert lines.exceptAll(result).count() == 0
    assert len(list((tmp_path / "base" / "json").glob("part-*"))) == 1
    text = spark.read.text(f"{out}/json").first()[0]
    assert "historical_cart_to_purchase_dropoff" in text


def test_last_row_wins_for_a_repeated_product(spark):
    df = spark.createDataFrame([(1, 5, 1.0), (1, 7, 2.0), (2, 6, 3.0)], "product_id int, line int, avg_trend_score_5m double")
    got = baseline.last_baseline_row(df, "line").orderBy("product_id").collect()
    assert [tuple(r) for r in got] == [("1", 2.0), ("2", 3.0)]


def test_revenue_counts_purchases_only(spark):
    prices = [1.1, 2.2, None, 4.4]
    events = events_of(
        spark,
        [(0, "purchase", "a", "s"), (1, "purchase", "a", "s"), (2, "purchase", "b", "s"), (3, "view", "a", "s")],
        price=lambda i: prices[i],
    )
    got = revenue.revenue_by(events, "product_id").orderBy("product_id").collect()
    assert [tuple(r) for r in got] == [("a", 2, 3.3), ("b", 1, 0.0)]


