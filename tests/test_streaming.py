import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import EIGHT, T0, at, events_of, naive
from cartpulse import schema
from cartpulse.operators import abandonment, baseline, minutes, normalise, serving
from cartpulse.plans import sample_queries
from cartpulse.sinks import payloads, tables
from cartpulse.sources import files
from cartpulse.streaming import inputs, livetable, outputs, signals, views

COLUMNS = [*schema.EVENT_COLUMNS, "seq", "processed_at", "experiment_id"]


def some_events(n=300, seed=1):
    rng, clock, rows = random.Random(seed), 0, []
    for i in range(n):
        clock += rng.choice((0, 0.25, 1, 1, 3))
        pair = ("hot", "hot") if i % 3 == 0 else (str(rng.randint(0, 4)), str(rng.randint(0, 6)))
        rows.append((clock, rng.choice(("view", "view", "cart", "purchase", "remove_from_cart")), *pair))
    return rows


def full(spark, rows):
    events = events_of(spark, rows, processed_at=lambda i: at(rows[i][0]) + dt.timedelta(milliseconds=i))
    missing = {c: F.lit("") for c in ("user_id", "category_id", "category_code", "brand")}
    return events.withColumns(missing).select(*COLUMNS)


class Feed:
    """A folder that receives one file per piece, in order."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.count = spark, folder, 0
        (folder / "in").mkdir()

    def add(self, events):
        target = self.folder / f"piece{self.count}"
        events.coalesce(1).write.parquet(str(target))
        part = next(target.glob("part-*"))
        part.rename(self.folder / "in" / f"{self.count:03d}.parquet")
        self.count += 1

    def stream(self, delay="0 seconds", **options):
        table = self.spark.read.parquet(str(self.folder / "in")).schema
        rows = inputs.table_files(self.spark, str(self.folder / "in"), table, max_files=1)
        return inputs.on_clock(rows, delay, **options)

    def run(self, start, name="q"):
        query = start(str(self.folder / f"{name}-out"), str(self.folder / f"{name}-check"))
        query.awaitTermination()
        return str(self.folder / f"{name}-out")

    def appended(self, rows, name="q"):
        out = self.run(lambda o, c: outputs.append_table(rows, o, c), name)
        return self.spark.read.schema(rows.schema).parquet(out)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def filled(feed, rows, pieces):
    events = full(feed.spark, rows)
    size = -(-len(rows) // pieces)
    for i in range(pieces):
        feed.add(events.filter((F.col("seq") >= i * size) & (F.col("seq") < (i + 1) * size)))
    return events


def same(left, right):
    columns = left.columns
    return sorted(map(str, left.collect())) == sorted(map(str, right.select(*columns).collect()))


@pytest.mark.parametrize("pieces", [1, 4])
def test_signals_equal_the_batch_form(feed, pieces):
    rows = some_events()
    events = filled(feed, rows, pieces)
    got = feed.appended(views.abandoned_carts(feed.stream(), "7 minutes"))
    want = abandonment.abandoned_carts(events, "7 minutes")
    assert got.count() > 20 and same(got, want)


def test_views_move_the_clock_of_signals(feed):
    feed.add(full(feed.spark, [(0, "cart", "p", "s")]))
    feed.add(full(feed.spark, [(15, "view", "q", "x")]))
    feed.add(full(feed.spark, [(15.5, "purchase", "p", "s"), (40, "view", "q", "x")]))
    got = feed.appended(views.abandoned_carts(feed.stream())).collect()
    assert [(r.session_id, r.cart_time, r.deadline) for r in got] == [("s", naive(0), naive(15))]


def test_sessions_are_merged_before_the_exchange(feed):
    filled(feed, some_events(30), 1)
    rows = views.abandoned_carts(feed.stream())
    out, check = str(feed.folder / "o"), str(feed.folder / "c")
    query = outputs.append_table(rows, out, check)
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    exchange = plan.index("Exchange hashpartitioning(")
    assert "MergingSessions" in plan[exchange:], plan


@pytest.mark.parametrize("pieces", [1, 5])
def test_minute_totals_equal_the_batch_form(feed, pieces):
    events = filled(feed, some_events(), pieces)
    counters = views.minute_counters(feed.stream())
    out = feed.run(lambda o, c: outputs.upsert_totals(counters, o, c))
    current = outputs.read_totals(feed.spark, out, "bucket", "product_id")
    assert same(current, minutes.product_minutes(events))
    health = views.minute_health(feed.stream())
    out = feed.run(lambda o, c: outputs.upsert_totals(health, o, c), "health")
    current = outputs.read_totals(feed.spark, out, "bucket", "experiment_id")
    assert same(current, minutes.health_minutes(events))


def test_a_repeated_batch_changes_nothing_and_compaction_keeps_the_newest(feed):
    spark = feed.spark
    out = str(feed.folder / "totals")
    first = minutes.product_minutes(full(spark, [(0, "view", "1", "s")]))
    second = minutes.product_minutes(full(spark, [(0, "view", "1", "s"), (0.5, "view", "1", "s"), (9, "cart", "2", "s")]))
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={number}")
    current = outputs.read_totals(spark, out, "bucket", "product_id")
    assert {r.product_id: r.views for r in current.collect()} == {"1": 2, "2": 0}
    target = str(feed.folder / "compact")
    outputs.compact_totals(spark, out, target, at(48 * 60 + 5), "bucket", "product_id")
    kept = outputs.read_totals(spark, target, "bucket", "product_id").collect()
    assert [r.product_id for r in kept] == ["2"]


@pytest.mark.parametrize("pieces", [1, 4])
def test_closed_windows_equal_the_batch_form(feed, pieces):
    rows = some_events()
    events = filled(feed, rows, pieces)
    closed = F.col("window_end") <= F.lit(at(rows[-1][0]))
    got = feed.appended(views.hopping_trend(feed.stream()))
    want = minutes.hopping_view(minutes.product_minutes(events)).filter(closed)
    assert got.count() > 100 and same(got, want)
    funnel = feed.appended(views.session_funnel(feed.stream()), "funnel")
    flags = events.groupBy(F.window("event_time", "5 minutes", "1 minute"), "session_id").agg(
        *[F.max(F.col("event_type") == k).alias(k) for k in ("view", "cart", "purchase")]
    )
    counts = flags.groupBy(F.col("window.end").alias("window_end")).agg(
        F.count_if("view").alias("view_sessions"), F.count_if("cart").alias("cart_sessions"),
        F.count_if("purchase").alias("purchase_sessions"), F.count("*").alias("active_sessions"),
    )
    assert same(counts.filter(closed), funnel)


def test_late_rows_are_dropped_after_the_delay(feed):
    feed.add(full(feed.spark, [(0, "view", "1", "s"), (20, "view", "1", "s")]))
    feed.add(full(feed.spark, [(20.5, "cart", "1", "s")]))
    feed.add(full(feed.spark, [(12, "view", "1", "s"), (2, "view", "1", "s"), (60, "view", "1", "s")]))
    got = feed.appended(views.hopping_trend(feed.stream(delay="10 minutes"), "5 minutes", "5 minutes"))
    assert {r.window_start: r.views for r in got.collect()} == {naive(0): 1, naive(10): 1, naive(20): 1}


def test_repeated_deliveries_count_once(feed):
    events = full(feed.spark, [(0, "view", "1", "s"), (1, "view", "1", "s")])
    feed.add(events.unionAll(events))
    feed.add(events.unionAll(full(feed.spark, [(30, "view", "1", "s")]).withColumn("seq", F.lit(99).cast("long"))))
    got = feed.appended(views.hopping_trend(feed.stream(delay="10 minutes", event_id="seq"), "5 minutes", "5 minutes"))
    assert {r.window_start: r.views for r in got.collect()} == {naive(0): 2}


def test_bad_records_do_not_block_good_ones(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good = [payloads.payload()]
    lines = [r[0] for r in full(spark, EIGHT).select(*good).collect()]
    (folder / "a.jsonl").write_text("\n".join([lines[0], "{broken", "", lines[1]]) + "\n")
    (folder / "b.jsonl").write_text(json.dumps({**json.loads(lines[2]), "event_type": "checkout"}) + "\n" + lines[3] + "\n")
    rows = inputs.payload_files(spark, str(folder), max_files=1)
    out = str(tmp_path / "out")
    outputs.route(rows, out, str(tmp_path / "check")).awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.filter("status = 'accepted'").count() == 3
    assert {r.reject_reason for r in stored.filter("status = 'rejected'").collect()} == {normalise.BAD_JSON, normalise.BAD_TYPE}
    assert stored.filter("reject_reason = 'malformed record'").first().raw is not None


def test_archive_is_readable_by_date(feed):
    events = filled(feed, EIGHT, 2).drop("processed_at")
    rows = feed.stream().select(*schema.EVENT_COLUMNS, "experiment_id", "seq")
    out = feed.run(lambda o, c: outputs.archive(rows, o, c))
    back = files.read_archive(feed.spark, out, since=T0)
    assert back.drop("event_date").exceptAll(events.select(*schema.EVENT_COLUMNS, "experiment_id", "seq")).count() == 0
    assert back.count() == 8


def test_live_serving_ranks_closed_windows(feed):
    spark = feed.spark
    rows = some_events(200)
    events = filled(feed, rows, 3)
    normal = baseline.baseline(events)
    path = str(feed.folder / "base")
    tables.write_baseline(normal, path)
    trend = views.hopping_trend(feed.stream(), "5 minutes", "5 minutes")
    out = feed.run(lambda o, c: outputs.serve(trend, f"{path}/parquet", o, c, n=2))
    got = spark.read.option("basePath", out).parquet(f"{out}/batch_id=*")
    closed = F.col("window_end") <= F.lit(at(rows[-1][0]))
    counts = baseline.window_counts(events).withColumn(
        "window_end", F.col("window_start") + F.expr("INTERVAL 5 MINUTES")
    )
    want = outputs.rank_windows(serving.compare(counts.filter(closed), normal), 2)
    columns = ["window_end", "rank", "product_id", "trend_score", "activity_lift", "is_unusually_trending"]
    assert got.count() > 10 and same(got.select(*columns), want)


def shuffled(feed, rows, pieces, delay):
    """The events in files of no order, one a micro-batch, and the row that closes the clock."""
    events = full(feed.spark, rows)
    for i in range(pieces):
        feed.add(events.filter(F.col("seq") % pieces == pieces - 1 - i))
    end = F.lit(at(rows[-1][0])) + F.expr(f"interval {delay}") * 2
    feed.add(inputs.closing_row(feed.spark, events.schema, end))
    return events


@pytest.mark.parametrize("pieces", [1, 5])
def test_order_and_number_of_files_do_not_matter(feed, pieces):
    events = shuffled(feed, some_events(), pieces, "2 days")
    trend = feed.appended(views.hopping_trend(feed.stream("2 days")), "trend")
    batch = minutes.hopping_view(minutes.product_minutes(events))
    assert sorted(trend.select(*batch.columns).collect()) == sorted(batch.collect())
    signals = feed.appended(views.abandoned_carts(feed.stream("2 days")), "signals")
    overdue = abandonment.overdue_carts(events, flush=True)
    assert sorted(signals.collect()) == sorted(overdue.collect())
    out = feed.run(lambda o, c: outputs.upsert_totals(views.minute_counters(feed.stream("2 days")), o, c), "minutes")
    totals = outputs.read_totals(feed.spark, out, "bucket", "product_id")
    stored = minutes.product_minutes(events)
    assert sorted(totals.select(*stored.columns).collect()) == sorted(stored.collect())


def test_late_rows_are_kept(feed):
    rows = some_events(60)
    events = full(feed.spark, rows)
    for low, high in ((40, 60), (0, 20), (20, 40)):
        feed.add(events.filter((F.col("seq") >= low) & (F.col("seq") < high)))
    table = feed.spark.read.parquet(str(feed.folder / "in")).schema
    stream = inputs.table_files(feed.spark, str(feed.folder / "in"), table, max_files=1)
    out = feed.run(lambda o, c: outputs.late_rows(stream, o, c, "1 minute"), "late")
    newest = max(rows[i][0] for i in range(40, 60))
    want = sorted(i for i in range(40) if rows[i][0] < newest - 1)
    assert want and sorted(r.seq for r in outputs.read_late(feed.spark, out).collect()) == want
    with pytest.raises(Exception, match="behind the clock"):
        feed.run(lambda o, c: outputs.late_rows(stream, o, c, "1 minute", strict=True), "strict")


def test_updated_at_is_the_processing_time(feed):
    events = filled(feed, some_events(30), 2)
    out = feed.run(lambda o, c: outputs.upsert_totals(views.minute_counters(feed.stream()), o, c))
    newest = outputs.read_totals(feed.spark, out, "bucket", "product_id").agg(F.max("updated_at")).first()[0]
    assert newest == events.agg(F.max("processed_at")).first()[0]


@pytest.mark.parametrize("pieces", [1, 5])
def test_live_carts_equal_the_batch_form(feed, pieces):
    rows = some_events()
    events = full(feed.spark, rows)
    size = -(-len(rows) // pieces)
    for i in range(pieces):
        feed.add(events.filter((F.col("seq") >= i * size) & (F.col("seq") < (i + 1) * size)))
    last = at(rows[-1][0])
    feed.add(inputs.closing_row(feed.spark, events.schema, F.lit(last + dt.timedelta(seconds=60, milliseconds=2))))
    stream = feed.stream("60 seconds")
    out = feed.run(lambda o, c: outputs.live_carts(signals.cart_changes(stream, "7 minutes"), o, c), "carts")
    clock = feed.run(lambda o, c: outputs.event_clock(stream, o, c), "clock")
    got = outputs.read_signals(feed.spark, out, clock)
    want = abandonment.abandoned_carts(events, "7 minutes")
    assert want.count() > 20 and same(got, want)
    pending = abandonment.pending_carts(events, "7 minutes")
    assert pending.count() and same(outputs.read_pending(feed.spark, out), pending)
    counters = outputs.read_cart_counters(feed.spark, out).first()
    assert (counters.pending_carts, counters.abandoned_cart_signals_total) == (pending.count(), want.count())


def test_a_signal_comes_once_and_a_restart_moves_it(feed):
    feed.add(full(feed.spark, [(0, "cart", "p", "s"), (2, "cart", "p", "s"), (1, "cart", "p", "t"), (3, "purchase", "p", "t")]))
    feed.add(full(feed.spark, [(20, "view", "q", "x")]))
    feed.add(full(feed.spark, [(40, "view", "q", "x"), (41, "purchase", "p", "s")]))
    out = feed.run(lambda o, c: outputs.live_carts(signals.cart_changes(feed.stream("1 second")), o, c))
    changes = feed.spark.read.parquet(f"{out}/changes/*").filter("change = 'signalled'").collect()
    assert [(r.session_id, r.cart_time) for r in changes] == [("s", naive(2))]
    assert outputs.read_cart_counters(feed.spark, out).first().asDict() == {"pending_carts": 0, "abandoned_cart_signals_total": 1}


def test_carts_of_all_pairs_are_judged_together(feed):
    """No Python and no call for each pair: a micro-batch is one window over what is kept and what is new."""
    feed.add(full(feed.spark, [(0, "view", "p", "s")]))
    plan = signals.cart_changes(feed.stream("1 second"))._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan and "Python" not in plan
    minute, timeout, table = 60_000_000, 15 * 60_000_000, "session_id string, product_id string, micros bigint, seq bigint, is_cart boolean, is_action boolean, delay_ms bigint, timeout bigint"
    new = lambda *rows: feed.spark.createDataFrame([(s, "p", m * minute, q, c, True, 0, timeout) for s, m, q, c in rows], table)
    told = lambda rows: sorted((r.session_id, r.micros // minute, r.outcome) for r in rows.collect())
    first = signals.steps(None, new(("a", 1, 1, True), ("b", 2, 2, True), ("b", 2, 3, False), ("c", 9, 4, False), ("d", 3, 5, True)), 0, 5 * minute)
    assert told(first) == [
        ("a", 1, "held"), ("a", 1, "opened"), ("b", 2, "closed"), ("b", 2, "opened"), ("c", 9, "waiting"), ("d", 3, "held"), ("d", 3, "opened"),
    ]
    late = new(("a", 4, 6, False), ("d", 18, 7, True), ("a", 40, 8, True))
    second = signals.steps(first, late, 5 * minute, 30 * minute)
    assert told(second) == [("a", 1, "signalled"), ("a", 40, "waiting"), ("d", 3, "signalled"), ("d", 18, "held"), ("d", 18, "opened")]


def test_live_table_keeps_itself_small(feed):
    spark, path, keys = feed.spark, str(feed.folder / "table"), ("bucket", "product_id")
    rows = some_events(200)
    events = full(spark, rows)
    pinned = {}
    for n in range(12):
        upto = events.filter(F.col("seq") < (n + 1) * 17)
        touched = minutes.product_minutes(upto).join(
            upto.filter(F.col("seq") >= n * 17).select(F.date_trunc("minute", "event_time").alias("bucket"), "product_id").distinct(), [*keys]
        )
        livetable.append(touched, path, n, keys, fanout=2, keep=6)
        if n == 7:  # the same micro-batch again
            livetable.append(touched, path, n, keys, fanout=2, keep=6)
        pinned[n] = livetable.read_live(spark, path, keys, version=n), minutes.product_minutes(upto)
    # Readers pinned to a kept version see it as it was, whatever was merged since.
    for n in range(6, 12):
        got, want = pinned[n]
        assert same(want, got), n
    assert livetable.versions(spark, path) == list(range(6, 12))
    listed = livetable._manifest(spark, path, 11)
    assert len(listed) <= 4 and max(level for _, level in listed) >= 2
    used = {s for v in range(6, 12) for s, _ in livetable._manifest(spark, path, v)}
    assert used <= {p.name for p in (feed.folder / "table" / "data").iterdir()} and len(used) < 14
    newest = livetable.read_live(spark, path, keys, since=F.lit(at(rows[-1][0] - 5)))
    assert newest.count() == minutes.product_minutes(events.filter("seq < 204")).filter(F.col("bucket") >= F.lit(at(rows[-1][0] - 5))).count()


def test_segments_have_few_files_a_date(feed):
    spark, path = feed.spark, str(feed.folder / "table")
    rows = minutes.product_minutes(full(spark, some_events(200))).repartition(40)
    livetable.append(rows, path, 0, ("bucket", "product_id"))
    dates = {p.parent: sum(1 for _ in p.parent.glob("part-*")) for p in (feed.folder / "table" / "data").glob("*/event_date=*/part-*")}
    assert dates and max(dates.values()) <= livetable.SPREAD


def test_a_feed_is_written_by_all_cores(feed, monkeypatch):
    spark = feed.spark
    events = full(spark, some_events(300)).repartition(3)
    for least, several in ((50_000, False), (10, spark.sparkContext.defaultParallelism > 1)):
        monkeypatch.setattr(sample_queries, "FILE_ROWS", least)
        path, files = sample_queries._in_pieces(spark, "feed", events, F.col("seq") % 3, 3)
        assert (files > 1) == several
        stored = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
        assert sorted(r.seq for r in stored.collect()) == list(range(300))
        found = stored.groupBy("file").agg(F.collect_set(F.col("seq") % 3).alias("pieces"))
        assert sorted(r.pieces[0] for r in found.collect() if len(r.pieces) == 1) == sorted(list(range(3)) * files)


def test_live_table_expires_in_merges(feed):
    spark, path, keys = feed.spark, str(feed.folder / "table"), ("bucket", "product_id")
    for n, minute in enumerate((0, 1, 48 * 60 + 5, 48 * 60 + 6)):
        livetable.append(minutes.product_minutes(full(spark, [(minute, "view", "1", "s")])), path, n, keys, fanout=2)
    livetable.append(minutes.product_minutes(full(spark, []).limit(0)), path, 4, keys, fanout=2)
    assert [r.bucket for r in livetable.read_live(spark, path, keys).orderBy("bucket").collect()] == [naive(48 * 60 + 5), naive(48 * 60 + 6)]
    merged = livetable._manifest(spark, path, 4)
    assert len(merged) == 1 and spark.read.parquet(f"{path}/data/{merged[0][0]}").count() == 2


def test_refused_records_are_judged_again_once(feed, tmp_path):
    spark = feed.spark
    folder = tmp_path / "lines"
    folder.mkdir()
    lines = [r[0] for r in full(spark, EIGHT).select(payloads.payload()).collect()]
    odd = {**json.loads(lines[2]), "event_type": "checkout"}
    (folder / "a.jsonl").write_text("\n".join([lines[0], "{broken", json.dumps(odd)]) + "\n")
    out = str(tmp_path / "routed")
    outputs.route(inputs.payload_files(spark, str(folder)), out, str(tmp_path / "c0")).awaitTermination()
    repair = lambda text: F.regexp_replace(text, "checkout", "purchase")
    again, check = str(tmp_path / "again"), str(tmp_path / "c1")
    for _ in range(2):  # a restarted pass judges nothing twice
        outputs.redrive(spark, out, again, check, repair).awaitTermination()
    got = {(r.status, r.attempts, r.event_type, r.reject_reason) for r in spark.read.parquet(again).collect()}
    assert got == {("promoted", 2, "purchase", None), ("buried", 2, None, normalise.BAD_JSON)}
    assert spark.read.parquet(again).count() == 2
    third = str(tmp_path / "third")
    mend = lambda text: F.when(text == "{broken", F.lit(lines[1])).otherwise(text)
    outputs.redrive(spark, again, third, str(tmp_path / "c2"), mend).awaitTermination()
    assert [(r.status, r.attempts, r.event_type) for r in spark.read.parquet(third).collect()] == [("promoted", 3, "cart")]


def test_laid_out_baseline_is_read_in_parts_without_a_shuffle(spark, tmp_path):
    rows = [(str(i), float(i), i) for i in range(500)] + [("7", 99.0, 1000)]
    history = spark.createDataFrame(rows, "product_id string, avg_trend_score_5m double, version int")
    path = str(tmp_path / "laid")
    tables.write_laid_out(history, path, order="version", parts=16)
    recent = spark.createDataFrame([("7", 10), ("8", 16), ("new", 5)], "product_id string, trend_score long")
    kept = files.read_laid_out(spark, path, recent)
    assert {r.product_id: r.avg_trend_score_5m for r in kept.collect()} == {"7": 99.0, "8": 8.0}
    got = serving.compare(recent, kept, unique=True)
    want = serving.compare(recent, history, order="version")
    assert same(want, got)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "part" in plan
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "PartitionFilters: [" in plan and "part#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
