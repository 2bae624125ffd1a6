import datetime as dt
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from cartpulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


T0 = dt.datetime(2019, 10, 1, tzinfo=dt.UTC)
SCHEMA = (
    "event_time timestamp, event_type string, product_id string, session_id string, "
    "seq long, source_event_time timestamp, price double, processed_at timestamp, experiment_id string"
)
# minute after T0, type, product, session
EIGHT = [
    (0, "view", "100", "s1"), (1, "cart", "100", "s1"), (2, "view", "100", "s2"),
    (3, "cart", "100", "s2"), (4, "purchase", "100", "s2"), (6, "view", "200", "s3"),
    (7, "cart", "200", "s3"), (20, "view", "200", "s4"),
]


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def naive(minutes):
    return at(minutes).replace(tzinfo=None)


def events_of(spark, rows, **columns):
    """Events from (minute, type, product, session), in list order."""
    data = []
    for seq, (minute, kind, product, session) in enumerate(rows):
        time = at(minute)
        extra = {k: v(seq) if callable(v) else v for k, v in columns.items()}
        data.append(
            (
                time, kind, product, session, seq, extra.get("source_event_time", time),
                extra.get("price"), extra.get("processed_at"), extra.get("experiment_id"),
            )
        )
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="session")
def eight(spark):
    return events_of(spark, EIGHT)


CSV = """event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session
""" + "".join(
    f"2019-10-01 00:{m:02d}:00 UTC,{kind},{product},{int(product) // 10},shop.{product},acme,{product}.50,u{session[1]},{session}\n"
    for m, kind, product, session in EIGHT
)
