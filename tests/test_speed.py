import datetime as dt
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import EIGHT, T0, at, events_of, naive
from cartpulse.operators import abandonment, asof, ordered, series, trailing
from cartpulse.plans import documents


def snapshot(events, **options):
    return documents.snapshot_document(events, **options).first().asDict(recursive=True)


def test_snapshot_after_seven_events(spark):
    doc = snapshot(events_of(spark, EIGHT[:7]))
    assert (doc["as_of"], doc["window_start"], doc["window_seconds"]) == (naive(7), naive(2), 300)
    assert (doc["events_in_window"], doc["processed_events_total"], doc["active_sessions"]) == (5, 7, 2)
    assert doc["event_totals"] == {"view": 2, "cart": 2, "purchase": 1}
    assert doc["top_products"] == [
        {"product_id": "100", "trend_score": 9, "views": 1, "carts": 1, "purchases": 1},
        {"product_id": "200", "trend_score": 4, "views": 1, "carts": 1, "purchases": 0},
    ]
    assert doc["funnel"] == {
        "view_sessions": 2, "cart_sessions": 2, "purchase_sessions": 1,
        "view_to_cart_dropoff": 0.0, "cart_to_purchase_dropoff": 0.5,
    }
    assert (doc["pending_carts"], doc["abandoned_cart_signals_total"], doc["latest_abandoned_carts"]) == (2, 0, [])


def test_snapshot_after_all_eight(eight):
    doc = snapshot(eight)
    assert doc["abandoned_cart_signals_total"] == 1 and doc["pending_carts"] == 1
    assert doc["latest_abandoned_carts"] == [
        {"session_id": "s1", "product_id": "100", "cart_time": naive(1), "detected_at": naive(20)}
    ]
    assert doc["events_in_window"] == 1 and doc["top_products"][0]["trend_score"] == 1
    assert (doc["funnel"]["view_to_cart_dropoff"], doc["funnel"]["cart_to_purchase_dropoff"]) == (1.0, None)


def test_flush_pushes_the_clock(eight):
    doc = snapshot(eight, flush=True)
    assert doc["as_of"] == naive(35) and doc["events_in_window"] == 0 and doc["top_products"] == []
    assert doc["event_totals"] == {} and doc["active_sessions"] == 0 and doc["pending_carts"] == 0
    assert [(s["session_id"], s["cart_time"], s["detected_at"]) for s in doc["latest_abandoned_carts"]] == [
        ("s1", naive(1), naive(20)), ("s3", naive(7), naive(35)),
    ]


def test_snapshot_without_events(spark):
    doc = snapshot(events_of(spark, []))
    assert doc["as_of"] is None and doc["processed_events_total"] == 0 and doc["events_in_window"] == 0
    assert doc["top_products"] == [] and doc["funnel"]["view_sessions"] == 0


def test_window_is_closed_at_both_ends(spark):
    events = events_of(spark, [(-0.001, "view", "1", "s"), (0, "view", "2", "s"), (5, "view", "3", "s"), (6, "view", "4", "s")])
    kept = trailing.in_window(events, "5 minutes", F.lit(at(5))).select("product_id").collect()
    assert sorted(r[0] for r in kept) == ["2", "3"]
    assert trailing.in_window(events, "6 minutes").count() == 3


def test_only_removals_still_rank_with_zero(spark):
    events = events_of(spark, [(0, "remove_from_cart", "9", "s"), (0, "view", "10", "s"), (0, "view", "2", "s")])
    counts = trailing.product_counts(trailing.in_window(events))
    assert [(r.product_id, r.trend_score, r.removals) for r in trailing.top_products(counts).collect()] == [
        ("10", 1, 0), ("2", 1, 0), ("9", 0, 1),
    ]
    assert {r.event_type: r.events for r in trailing.event_totals(events).collect()} == {"view": 2, "remove_from_cart": 1}


def test_stages_are_independent(spark):
    events = events_of(spark, [(0, "cart", "1", "a"), (0, "cart", "1", "b"), (0, "view", "1", "c"), (0, "remove_from_cart", "1", "d")])
    row = trailing.funnel(trailing.session_flags(events)).first()
    assert (row.view_sessions, row.cart_sessions, row.active_sessions) == (1, 2, 4)
    assert row.view_to_cart_dropoff == 0.0 and row.cart_to_purchase_dropoff == 1.0


# --- abandonment -----------------------------------------------------------------------


def model(events, timeout, flush=False):
    """The rules read event by event: advance the clock, report what is overdue, apply."""
    pending, signals, clock = {}, [], None

    def advance(now):
        for key in [k for k, t in pending.items() if t + timeout <= now]:
            signals.append((*key, pending.pop(key), now))

    for minute, kind, product, session in events:
        clock = minute
        advance(clock)
        if kind == "cart":
            pending[session, product] = clock
        elif kind in ("purchase", "remove_from_cart"):
            pending.pop((session, product), None)
    if flush and clock is not None:
        advance(clock + timeout)
    return sorted(signals), sorted((*k, t) for k, t in pending.items())


def minutes_since(time):
    return (time - naive(0)) / dt.timedelta(minutes=1)


def computed(spark, rows, timeout, flush=False):
    events = events_of(spark, rows)
    span = f"{timeout} minutes"
    signals = abandonment.abandoned_carts(events, span, flush).collect()
    pending = abandonment.pending_carts(events, span, flush).collect()
    return (
        sorted((r.session_id, r.product_id, minutes_since(r.cart_time), minutes_since(r.detected_at)) for r in signals),
        sorted((r.session_id, r.product_id, minutes_since(r.cart_time)) for r in pending),
    )


CASES = {
    "purchase exactly at the deadline is too late": [(0, "cart", "p", "s"), (15, "purchase", "p", "s")],
    "purchase just before the deadline": [(0, "cart", "p", "s"), (14.5, "purchase", "p", "s"), (40, "view", "p", "x")],
    "re-add restarts the timer": [(0, "cart", "p", "s"), (10, "cart", "p", "s"), (20, "view", "q", "x")],
    "two signals": [(0, "cart", "p", "s"), (15, "view", "q", "x"), (16, "cart", "p", "s"), (31, "view", "q", "x")],
    "purchase then cart at once": [(0, "purchase", "p", "s"), (0, "cart", "p", "s"), (5, "view", "q", "x")],
    "cart then purchase at once": [(0, "cart", "p", "s"), (0, "purchase", "p", "s"), (50, "view", "q", "x")],
    "removal cancels": [(0, "cart", "p", "s"), (3, "remove_from_cart", "p", "s"), (50, "view", "q", "x")],
    "later purchase does not retract": [(0, "cart", "p", "s"), (20, "purchase", "p", "s"), (50, "view", "q", "x")],
    "detected by the next event, hours later": [(0, "cart", "p", "s"), (3000, "view", "q", "x")],
    "other product does not cancel": [(0, "cart", "p", "s"), (1, "purchase", "q", "s"), (15, "view", "q", "x")],
}


def test_abandonment_cases(spark):
    for name, rows in CASES.items():
        for flush in (False, True):
            assert computed(spark, rows, 15, flush) == model(rows, 15, flush), name


@settings(max_examples=12, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(0, 8), st.sampled_from(["view", "cart", "purchase", "remove_from_cart"]),
            st.sampled_from("pq"), st.sampled_from("ab"),
        ),
        max_size=40,
    ),
    st.integers(1, 20),
    st.booleans(),
)
def test_abandonment_follows_the_model(spark, steps, timeout, flush):
    clock, rows = 0, []
    for gap, *rest in steps:
        clock += gap
        rows.append((clock, *rest))
    assert computed(spark, rows, timeout, flush) == model(rows, timeout, flush)


def test_hot_pair_is_reduced_before_the_window(spark):
    """A pair with a third of all rows leaves one row per slot."""
    rng = random.Random(3)
    rows, clock = [], 0
    for i in range(3000):
        clock += rng.choice((0, 0, 1, 4))
        pair = ("hot", "hot") if i % 3 == 0 else (str(rng.randint(0, 40)), str(rng.randint(0, 5)))
        rows.append((clock, rng.choice(("view", "cart", "cart", "purchase", "remove_from_cart")), *pair))
    assert computed(spark, rows, 7) == model(rows, 7)
    plan = abandonment.last_carts(events_of(spark, rows))._jdf.queryExecution().executedPlan().toString()
    window = plan.index("Window [")
    assert plan.index("HashAggregate", window) > window and "SortAggregate" not in plan
    assert "partial_min" in plan[plan.index("slot", window):]


def test_latest_signals_are_the_last_ten_in_order(spark):
    rows = [(i, "cart", str(i), "s") for i in range(15)] + [(100, "view", "z", "z")]
    latest = abandonment.latest_abandoned_carts(events_of(spark, rows)).collect()
    assert [r.product_id for r in latest] == [str(i) for i in range(5, 15)]
    assert {r.detected_at for r in latest} == {naive(100)}


def test_latest_signals_equal_the_end_of_all_signals(spark):
    rng = random.Random(8)
    rows, clock = [], 0
    for _ in range(400):
        clock += rng.choice((0, 0, 1, 6))
        rows.append((clock, rng.choice(("view", "cart", "purchase")), rng.choice("pqr"), rng.choice("abcd")))
    events = events_of(spark, rows)
    order = ("detected_at", "cart_time", "session_id", "product_id")
    for flush in (False, True):
        signals = abandonment.abandoned_carts(events, "5 minutes", flush).orderBy(*order).collect()
        assert abandonment.latest_abandoned_carts(events, "5 minutes", 7, flush).collect() == signals[-7:]


def test_forward_lookup_equals_brute_force(spark):
    rng = random.Random(11)
    base = int(T0.timestamp()) * 1_000_000
    spread = [rng.choice((0, 1, 999_999, 1_000_000, 50_000_000, 86_400_000_000)) for _ in range(400)]
    points, clock = [], base
    for step in spread:
        clock += step
        points.append(clock)
    probes = [rng.choice(points) + rng.choice((-1, 0, 1, 500_000, 90_000_000_000)) for _ in range(300)]
    micros = "t long"
    frame = lambda values: spark.createDataFrame([(v,) for v in values], micros).select(F.timestamp_micros("t").alias("t"))
    found = asof.first_at_or_after(frame(points), frame(probes)).select(
        F.unix_micros("probe"), F.unix_micros("found")
    )
    expected = {p: min((x for x in points if x >= p), default=None) for p in probes}
    assert {r[0]: r[1] for r in found.collect()} == expected
    assert found.count() == len(expected)


@pytest.mark.parametrize("chunk", [1 << 20, 16])
def test_series_is_the_state_after_each_event(spark, monkeypatch, chunk):
    monkeypatch.setattr(ordered, "CHUNK", chunk)
    rng = random.Random(chunk)
    clock, rows = 0.0, []
    for i in range(250):
        clock += rng.choice((0, 0, 0.5, 1, 5))  # many events share a moment
        kind = rng.choice(("view", "cart", "purchase", "remove_from_cart"))
        rows.append((clock, kind, "hot" if i % 3 == 0 else str(rng.randint(0, 3)), "s"))
    got = {r.seq: r for r in series.trailing_series(events_of(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, (minute, _, product, _) in enumerate(rows):
        held = [r for r in rows[: i + 1] if r[0] >= minute - 5]
        mine = [kind for _, kind, p, _ in held if p == product]
        want = [mine.count(k) for k in ("view", "cart", "remove_from_cart", "purchase")]
        row = got[i]
        assert [row.views, row.carts, row.removals, row.purchases, row.events_in_window] == [*want, len(held)]
        assert row.trend_score == want[0] + 3 * want[1] + 5 * want[3] and row.product_id == product


def test_series_of_eight(spark, eight):
    last = series.trailing_series(eight.filter("seq < 7")).orderBy("seq").collect()[-1]
    assert (last.product_id, last.views, last.carts, last.trend_score, last.events_in_window) == ("200", 1, 1, 4, 5)
    assert series.trailing_series(eight.limit(0)).count() == 0


def test_series_windows_stay_in_chunks(spark, eight, monkeypatch):
    monkeypatch.setattr(ordered, "CHUNK", 2)
    plan = series.trailing_series(eight)._jdf.queryExecution().optimizedPlan().toString()
    raw = [line for line in plan.splitlines() if "Window [" in line and "_here_" in line]
    assert len(raw) == 2 and all("_chunk" in line.split("], [")[1] for line in raw)
