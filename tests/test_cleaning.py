import datetime as dt
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import EIGHT, at, events_of
from cartpulse import schema
from cartpulse.functions import cleaning, metrics
from cartpulse.functions.timebuckets import latency_ms, slot_of, stream_key, utc_text
from cartpulse.operators import minutes, normalise, revenue
from cartpulse.sinks import payloads

MIDNIGHT = dt.datetime(2019, 10, 1)


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "fractional", [False, True], ids=["text", "json"]
)
def test_event_times(spark, fractional):
    expected = {
        "1569888000": MIDNIGHT,
        "1569888000000": MIDNIGHT,
        " 1569888000 ": MIDNIGHT,
        "1569888000123": MIDNIGHT.replace(microsecond=123000),
        "10000000000": dt.datetime(2286, 11, 20, 17, 46, 40),
        "10000000001": dt.datetime(1970, 4, 26, 17, 46, 40, 1000),
        "99999999999999999999999": None,
        "999999999999999999": None,
        "2019-10-01 00:00:00 UTC": MIDNIGHT,
        "2019-10-01T00:00:00Z": MIDNIGHT,
        "2019-10-01T00:00:00": MIDNIGHT,
        "2019-10-01 00:00:00": MIDNIGHT,
        "\t2019-10-01 00:00:00 UTC\n": MIDNIGHT,
        "2019-10-01": MIDNIGHT,
        "2019-10-01T02:00:00+02:00": MIDNIGHT,
        "2019-09-30T19:00:00-05:00": MIDNIGHT,
        "2019-10-01T02:00:00+0200": MIDNIGHT,
        "2019-10-01T02:00:00+02": MIDNIGHT,
        "2019-10-01T02+02": MIDNIGHT,
        "2019-10-01T00:00:00.5Z": MIDNIGHT.replace(microsecond=500000),
        "2019-10-01T00:00:00.123456": MIDNIGHT.replace(microsecond=123456),
        "2019-10-01T00:00:00.123456789Z": MIDNIGHT.replace(microsecond=123456),
        "2019-10-01T00:00:00,25": MIDNIGHT.replace(microsecond=250000),
        "2019-10-01T00:00": MIDNIGHT,
        "2019-10-01x00:00": MIDNIGHT,
        "20191001T000000": MIDNIGHT,
        "20191001T0000Z": MIDNIGHT,
        "20191001T00": MIDNIGHT,
        "2019-10": None,
        "12:00:00": None,
        "2019-02-30": None,
        "2019-10-01T25:00:00": None,
        "2019-10-01T0:0:0": None,
        "2019-10-01 00:00:00 Europe/Paris": None,
        "yesterday": None,
        "": None,
        None: None,
        "-5": dt.datetime(1969, 12, 31, 23, 59, 55) if fractional else None,
        "1569888000.5": MIDNIGHT.replace(microsecond=500000) if fractional else None,
    }
    got = column(spark, list(expected), lambda v: cleaning.event_time_of(v, fractional).cast("timestamp_ntz"))
    assert dict(zip(expected, got)) == expected


def test_event_types(spark):
    expected = {
        "view": "view", " VIEW\n": "view", " AddToCart ": "cart", "add_to_cart": "cart", "cart": "cart",
        "RemoveFromCart": "remove_from_cart", "remove_from_cart": "remove_from_cart",
        "transaction": "purchase", "purchase ": "purchase", "checkout": None, "": None, None: None,
    }
    assert dict(zip(expected, column(spark, list(expected), cleaning.event_type_of))) == expected


def test_prices(spark):
    expected = {
        "12.50": 12.5, " 7 ": 7.0, "1e3": 1000.0, ".5": 0.5, "1_000": 1000.0, "inf": None,
        "12.5d": None, "0x10": None, "free": None, " ": None, "": None, None: None,
    }
    assert dict(zip(expected, column(spark, list(expected), cleaning.price_of))) == expected


def test_rounding_follows_the_stored_value(spark):
    rng = random.Random(7)
    values = [0.0, 0.0005, 0.00005, 0.00049, 0.0625, 2.675, 1.0005, -0.0005, -2.5, 123456.7895]
    values += [i / 20000 for i in range(0, 40000, 3)]
    values += [rng.random() * 10 ** rng.randint(-4, 4) for _ in range(5000)]
    values += [1 - rng.randint(0, 300) / rng.randint(1, 300) for _ in range(5000)]
    for digits in (2, 3, 4):
        got = column(spark, values, lambda v: metrics.round_exact(v, digits), "double")
        assert [(v, g) for v, g in zip(values, got) if g != round(v, digits)] == []


def test_larger_loss(spark):
    rows = [(0.2, 0.5), (0.5, 0.2), (0.5, 0.5), (None, 0.1), (0.1, None), (None, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = [r[0] for r in df.select(metrics.larger_loss(F.col("a"), F.col("b"))).collect()]
    assert got == [
        "cart_to_purchase", "view_to_cart", "equal", "cart_to_purchase", "view_to_cart", None,
    ]


def test_dropoffs_differ_between_history_and_now(spark):
    df = spark.createDataFrame([(2, 3), (0, 3), (3, 1)], "a long, b long")
    got = df.select(
        metrics.historical_dropoff(F.col("a"), F.col("b")).alias("h"),
        metrics.current_dropoff(F.col("a"), F.col("b")).alias("c"),
    ).collect()
    assert [tuple(r) for r in got] == [(-0.5, 0.0), (None, None), (1 - 1 / 3, 0.6667)]


def test_unusual_is_judged_unrounded_and_inclusive(spark):
    df = spark.createDataFrame([(20.0, 10.0), (19.9999, 10.0), (5.0, 0.0), (5.0, None)], "c double, n double")
    flags = [r[0] for r in df.select(metrics.is_unusual(F.col("c"), F.col("n"))).collect()]
    lifts = [r[0] for r in df.select(metrics.activity_lift(F.col("c"), F.col("n"))).collect()]
    assert flags == [True, False, False, False]
    assert lifts == [2.0, 2.0, None, None]


def test_clock_expressions(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2019, 10, 1, 0, 0, 1, 999), dt.datetime(2019, 10, 1, 0, 0, 0))], "a timestamp, b timestamp"
    )
    row = df.select(
        latency_ms(F.col("a"), F.col("b")).alias("forward"),
        latency_ms(F.col("b"), F.col("a")).alias("backward"),
        utc_text(F.col("a")).alias("fraction"),
        utc_text(F.col("b")).alias("whole"),
        slot_of(F.timestamp_micros(F.lit(-1)), 1_000_000).alias("before_epoch"),
    ).first()
    assert row.forward == 1000 and row.backward == 0 and row.before_epoch == -1
    assert row.fraction == "2019-10-01T00:00:01.000999+00:00"
    assert row.whole == "2019-10-01T00:00:00+00:00"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**51), st.integers(0, 2**62)), min_size=2, max_size=30))
def test_stream_key_sorts_like_the_pair(spark, pairs):
    df = spark.createDataFrame(pairs, "t long, s long").select(
        "t", "s", stream_key(F.timestamp_micros("t"), F.col("s")).alias("k")
    )
    assert [tuple(r) for r in df.orderBy("k").select("t", "s").collect()] == sorted(pairs)


def test_empty_label_is_none(spark):
    rows = events_of(spark, EIGHT[:1], processed_at=lambda i: at(0), experiment_id="")
    assert minutes.latency_records(rows).first().experiment_id == schema.UNLABELLED
    assert payloads.health_keys(minutes.health_minutes(rows)).first().SK == "HEALTH"


def test_raw_is_the_row_as_delivered_and_prices_are_finite(spark):
    columns = "event_time string, event_type string, product_id string, user_session string, price string, source_row long"
    rows = [("2019-10-01 00:00:00 UTC", "view", "1", "s", p, i) for i, p in enumerate(("nan", "inf", "1.5"))]
    read = normalise.interpret_shop_rows(spark.createDataFrame(rows, columns))
    dead = normalise.rejected(read).collect()
    assert [r.reason for r in dead] == [normalise.BAD_PRICE] * 2
    assert all("source_row" not in r.raw for r in dead) and {r.source_row for r in dead} == {0, 1}


def test_small_prices_add_up(spark):
    rows = events_of(spark, [(0, "purchase", "1", "s")] * 3, price=lambda i: (0.00004, 0.00004, 1e18)[i])
    assert revenue.revenue_by(rows.filter("seq < 2"), "product_id").first().revenue == 0.00008
    assert revenue.revenue_by(rows, "product_id").first().revenue == 1e18
