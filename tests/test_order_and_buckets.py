import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import EIGHT, at, events_of, naive
from cartpulse import schema
from cartpulse.operators import experiments, minutes, ordered, replay
from cartpulse.sinks import payloads, tables
from cartpulse.sources import files


@pytest.fixture
def sparse(spark, monkeypatch):
    """Rows with gaps in seq, over many small chunks."""
    monkeypatch.setattr(ordered, "CHUNK", 16)
    rng = random.Random(5)
    seqs = sorted(rng.sample(range(2000), 600))
    values = [rng.randint(0, 50) for _ in seqs]
    rows = list(zip(seqs, values))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "seq long, v int"), sorted(rows)


def test_positions_without_gaps(sparse):
    df, rows = sparse
    got = ordered.with_position(df).orderBy("seq").collect()
    assert [(r.seq, r.position) for r in got] == [(s, i) for i, (s, _) in enumerate(rows)]


def test_latest_before_and_previous(sparse):
    df, rows = sparse
    values = [v for _, v in rows]
    latest = [r.latest_before for r in ordered.with_latest_before(df, "v").orderBy("seq").collect()]
    assert latest == [max(values[:i], default=None) for i in range(len(values))]
    previous = [r.previous for r in ordered.with_previous(df, "v").orderBy("seq").collect()]
    assert previous == [None, *values[:-1]]


def test_no_window_runs_over_unbounded_rows(sparse):
    """The only unpartitioned window reads the aggregated chunks."""
    plan = ordered.with_position(sparse[0])._jdf.queryExecution().executedPlan().toString()
    single = plan[plan.index("Exchange SinglePartition"):]
    assert plan.count("SinglePartition") == 1 and single.index("HashAggregate") < single.index("Scan")


def test_order_check(spark, eight):
    assert ordered.order_violations(eight).count() == 0
    assert ordered.require_ordered(eight).count() == 8
    late = events_of(spark, [(0, "view", "1", "s"), (5, "view", "1", "s"), (3, "view", "1", "s"), (4, "view", "1", "s")])
    assert [r.seq for r in ordered.order_violations(late).orderBy("seq").collect()] == [2, 3]
    with pytest.raises(Exception, match="must be ordered"):
        ordered.require_ordered(late).collect()


def test_rebase_by_rate_keeps_the_source_clock(spark):
    start = F.lit(naive(1000)).cast("timestamp")
    events = events_of(spark, EIGHT[:3], source_event_time=None)
    got = replay.rebase(events, start, 2).orderBy("seq").collect()
    half = dt.timedelta(seconds=0.5)
    assert [r.event_time for r in got] == [naive(1000), naive(1000) + half, naive(1000) + 2 * half]
    assert [r.source_event_time for r in got] == [naive(0), naive(1), naive(2)]
    again = replay.rebase(replay.rebase(events, start, 2), start, 1).orderBy("seq").collect()
    assert [r.source_event_time for r in again] == [naive(0), naive(1), naive(2)]


def test_rebase_with_gaps_starts_at_the_first_event(spark):
    events = events_of(spark, [(10, "view", "1", "s"), (4, "view", "1", "s"), (12, "view", "1", "s")])
    start = F.lit(naive(0)).cast("timestamp")
    got = replay.rebase(events, start, 2, preserve_timing=True).orderBy("seq").collect()
    assert [r.event_time for r in got] == [naive(0), naive(-3), naive(1)]


def test_rate_must_be_positive(eight):
    with pytest.raises(ValueError, match="greater than zero"):
        replay.rebase(eight, F.current_timestamp(), 0)


# --- buckets ----------------------------------------------------------------------------


def test_eight_events_in_one_minute_store_three_rows(spark):
    events = events_of(
        spark, [(0.1 + i / 100, *e[1:]) for i, e in enumerate(EIGHT)],
        processed_at=lambda i: at(0.1 + i / 100) + dt.timedelta(milliseconds=[250, -9][i % 2]),
    )
    products = {r.product_id: r for r in minutes.product_minutes(events).collect()}
    assert {k: (r.views, r.carts, r.removals, r.purchases) for k, r in products.items()} == {
        "100": (2, 2, 0, 1), "200": (2, 1, 0, 0),
    }
    assert products["100"].bucket == naive(0)
    assert products["100"].expires_at == int((at(0.14) + dt.timedelta(hours=48)).timestamp())
    health = minutes.health_minutes(events).collect()
    assert [(r.event_count, r.latency_total_ms, r.latency_mean_ms, r.experiment_id) for r in health] == [(8, 1000, 125.0, None)]
    assert minutes.latency_records(events).first().experiment_id == schema.UNLABELLED


def test_bucket_views(spark):
    events = events_of(spark, [(i, "view", "1", "s") for i in range(10)] + [(9, "cart", "1", "s")])
    buckets = minutes.product_minutes(events)
    row = minutes.latest_buckets_view(buckets).first()
    assert (row.views, row.carts, row.trend_score) == (5, 1, 8)
    row = minutes.latest_buckets_view(buckets, as_of=F.lit(at(4.5))).first()
    assert (row.views, row.carts) == (5, 0)
    hopping = {r.window_end: r.views for r in minutes.hopping_view(buckets).collect()}
    assert len(hopping) == 14 and hopping[naive(5)] == 5 and hopping[naive(1)] == 1 and hopping[naive(14)] == 1


def test_retention_and_keys(spark):
    events = events_of(spark, [(0, "view", "1", "s"), (60, "view", "1", "s")], processed_at=at(61), experiment_id="x")
    buckets = minutes.product_minutes(events, retention="1 hour")
    assert minutes.retained(buckets, F.lit(at(60))).count() == 1
    keys = payloads.bucket_keys(buckets).orderBy("PK").first()
    assert (keys.PK, keys.SK) == ("WINDOW#2019-10-01T00:00:00+00:00", "PRODUCT#1")
    health = minutes.health_minutes(events)
    assert payloads.health_keys(health).first().SK == "HEALTH#x"
    unlabelled = minutes.health_minutes(events.withColumn("experiment_id", F.lit(None).cast("string")))
    assert payloads.health_keys(unlabelled).first().SK == "HEALTH"


# --- experiments ------------------------------------------------------------------------


def test_latency_statistics(spark):
    lines = [f'{{"metric":"m","experiment_id":"a","latency_ms":{i},"event_type":"view"}}' for i in range(100)]
    lines += ['{"experiment_id":"b","latency_ms":7}', "START request", '{"experiment_id":"a","latency_ms":"x"}']
    log = spark.createDataFrame([(line,) for line in lines], "message string")
    parsed = experiments.parse_latency_log(log)
    got = {r.experiment_id: r for r in experiments.latency_statistics(parsed, "experiment_id").collect()}
    assert (got["a"].processed, got["a"].avg_latency_ms, got["a"].p50_latency_ms, got["a"].max_latency_ms) == (100, 49.5, 49.5, 99)
    assert got["a"].p95_latency_ms == pytest.approx(94.05)
    assert (got["b"].processed, got["b"].p95_latency_ms) == (1, 7.0)
    assert experiments.parse_latency_log(log, experiment_id='"a"').count() == 100


def test_load_runs(spark, tmp_path):
    runs = [
        ("r1", 100, 1000, 1000, 10.0004, 5.0, 9.0, naive(1)), ("r2", 100, 1000, 1000, 8.0, 7.0, 11.0, naive(3)),
        ("r3", 100, 1000, 999, 9.0, 100.0, 200.0, naive(2)), ("r4", 500, 1000, 1000, 2.0, 1.0, 2.0, naive(7)),
        ("r5", 500, 1000, 1000, 2.0, 1.0, None, naive(8)),
    ]
    table = spark.createDataFrame(
        runs, "experiment_id string, target_rate_eps int, sent_records long, processed_records long, "
        "producer_seconds double, p50_latency_ms double, p95_latency_ms double, completed_at_utc timestamp"
    )
    out = str(tmp_path / "runs")
    tables.write_table_csv(experiments.with_throughput(table), out)
    stored = files.read_table_csv(spark, out, schema.LOAD_RUN_SCHEMA)
    assert stored.filter("experiment_id = 'r1'").first().producer_seconds == 10.0
    assert stored.schema == schema.LOAD_RUN_SCHEMA
    got = experiments.load_run_summary(stored).orderBy("target_rate_eps").collect()
    assert [tuple(r) for r in got] == [(100, 2, 6.0, 10.0, 112.5), (500, 1, 1.0, 2.0, 500.0)]
    over_time = experiments.throughput_over_time(stored).orderBy("elapsed_minutes").collect()
    assert [(r.experiment_id, r.elapsed_minutes) for r in over_time] == [("r1", 0.0), ("r2", 2.0), ("r4", 6.0)]


def test_worker_speedup(spark, tmp_path):
    path = tmp_path / "trials.csv"
    path.write_text(
        "worker_count,repeat,duration_seconds,status,input_events,partitions\n"
        "2,1,60,COMPLETED,10,8\n2,2,58,completed,10,8\n2,3,70,,10,8\n4,1,30,COMPLETED,10,8\n4,2,1,FAILED,10,8\n0,1,5,COMPLETED,1,1\n8,1,0,COMPLETED,1,1\n"
    )
    trials = files.read_table_csv(spark, str(path), schema.WORKER_TRIAL_SCHEMA)
    got = experiments.worker_speedup(trials).orderBy("worker_count").collect()
    assert [(r.worker_count, r.trials, r.median_seconds, r.speedup, r.ideal_speedup, r.efficiency) for r in got] == [
        (2, 3, 60.0, 1.0, 1.0, 1.0), (4, 1, 30.0, 2.0, 2.0, 1.0),
    ]
    assert experiments.worker_speedup(trials.filter("worker_count = 2")).count() == 0
    assert experiments.worker_speedup(trials.drop("status")).count() == 2


def test_scaling_changes(spark):
    samples = spark.createDataFrame([(30 * i, n) for i, n in enumerate((2, 2, 3, 3, 4, 2))], "elapsed_seconds long, total_workers int")
    got = experiments.scaling_changes(samples).orderBy("elapsed_seconds").collect()
    assert [(r.elapsed_seconds, r.previous_workers, r.total_workers) for r in got] == [(60, 2, 3), (120, 3, 4), (150, 4, 2)]
    assert tuple(experiments.scaling_observed(samples).first()) == (3, True)
    assert tuple(experiments.scaling_observed(samples.limit(2)).first()) == (1, False)


def test_backlog_age(spark):
    events = events_of(spark, EIGHT[:3], processed_at=lambda i: at([0.5, 1.25, 2.75][i]))
    assert experiments.largest_backlog_age(events).first()[0] == 45_000
    assert [r.max_age_ms for r in experiments.backlog_age(events).orderBy("minute").collect()] == [30_000, 15_000, 45_000]


@pytest.mark.parametrize("values", ["hashes", "micros", "numbers"])
def test_chunks_are_bounded_whatever_the_order(spark, monkeypatch, values):
    monkeypatch.setattr(ordered, "CHUNK", 500)
    order = {
        "hashes": F.xxhash64("id"), "micros": F.col("id") * 1_000_003 + (F.col("id") % 7) ** 9 * 1000, "numbers": F.col("id"),
    }[values]
    rows = spark.range(20_000).select(order.cast("long").alias("seq"), "id")
    sizes = [r["count"] for r in ordered.in_chunks(rows, "seq").groupBy("_chunk").count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 2000
    got = [r.position for r in ordered.with_position(rows, "seq").orderBy("seq").collect()]
    assert got == list(range(20_000))


@pytest.mark.parametrize("spread", [1, 50, 10**15])
def test_values_at_ranks(spark, spread):
    rng = random.Random(spread)
    data = [(rng.choice("ab") if i % 3 else "hot", rng.choice((rng.randint(0, 20), rng.randint(0, spread))) * rng.choice((1, 1, -1)) * 0.1)
            for i in range(3000)] + [("one", 7.5), ("two", None), ("three", float("nan"))]
    rows = spark.createDataFrame(data, "g string, v double")
    points = {"low": 0.0, "quarter": 0.25, "median": 0.5, "most": 0.95, "top": 1.0}
    got = {r.g: r for r in experiments.percentiles(rows, ["g"], "v", points, F.max("v").alias("most_v")).collect()}
    groups = {}
    for g, v in data:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, held in groups.items():
        held.sort()
        for name, share in points.items():
            rank = share * (len(held) - 1)
            low, high = int(rank // 1), int(-(-rank // 1))
            want = held[low] if low == high else (high - rank) * held[low] + (rank - low) * held[high]
            assert got[g][name] == want
        assert got[g]["rows"] == len(held) and got[g].most_v == held[-1]


def test_percentiles_sort_no_group(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    found = experiments.percentiles(rows, ["g"], "id", {"median": 0.5})
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert experiments.percentiles(rows.limit(0), ["g"], "id", {"median": 0.5}).count() == 0
    assert experiments.percentiles(rows, [], "id", {"median": 0.5}).first().median == 499.5
