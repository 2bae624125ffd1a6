import json

import pytest

from conftest import CSV, naive
from cartpulse.streaming import outputs
from jobs import baseline, compact, normalise, replay, serve, snapshot, stream


@pytest.fixture
def source(tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(CSV + "2019-10-01 00:30:00 UTC,checkout,1,1,x,y,1,u1,s1\n")
    return str(path)


def document(spark, path):
    return json.loads(spark.read.text(path).first()[0])


def test_batch_jobs_end_to_end(spark, source, tmp_path, capsys):
    paths = {n: str(tmp_path / n) for n in ("events", "lines", "base", "snap", "serve")}
    normalise.main([source, paths["events"]])
    assert "unsupported event_type" in capsys.readouterr().out
    assert spark.read.parquet(paths["events"]).filter("status = 'rejected'").first().source_row == 10

    replay.main([source, "--rate", "1000", "--start", "2030-01-01T00:00:00", "--output", paths["lines"]])
    baseline.main([paths["lines"], paths["base"], "--json-files", "1"])
    snapshot.main([paths["lines"], "--output", paths["snap"], "--check-order"])
    serve.main([paths["snap"], paths["base"] + "/parquet", "--output", paths["serve"]])
    got = document(spark, paths["serve"])
    assert got["as_of"] == "2030-01-01T00:00:00.007000+00:00"
    assert [(p["product_id"], p["activity_lift"]) for p in got["trending_products"]] == [("200", 2.0), ("100", 1.0)]
    serve.main([paths["snap"], paths["base"] + "/json", "--baseline-format", "json-lines", "--top", "1"])
    assert json.loads(capsys.readouterr().out)["trending_products"] == got["trending_products"][:1]
    baseline.main([paths["events"], paths["base"] + "2", "--format", "parquet", "--partitions", "2"])
    assert spark.read.parquet(paths["base"] + "2/parquet").count() == 2


def test_replay_preserving_gaps_and_limit(spark, source, tmp_path, capsys):
    lines = str(tmp_path / "lines")
    replay.main([source, "--rate", "60", "--preserve-timing", "--limit", "3", "--start", "2030-01-01", "--output", lines])
    times = sorted(json.loads(r[0])["event_time"] for r in spark.read.text(lines).collect())
    assert times == [f"2030-01-01T00:00:0{i}+00:00" for i in range(3)]
    snapshot.main([lines, "--abandonment-minutes", "1", "--flush-abandonment"])
    got = json.loads(capsys.readouterr().out)
    assert [s["session_id"] for s in got["latest_abandoned_carts"]] == ["s1"] and got["events_in_window"] == 3


def test_stream_job(spark, source, tmp_path):
    lines, base, out = (str(tmp_path / n) for n in ("lines", "base", "out"))
    # a minute of history per replayed second, so the last event closes windows and carts
    replay.main([source, "--rate", "1", "--preserve-timing", "--start", "2019-10-01", "--output", lines])
    baseline.main([lines, base])
    stream.main([out, "--baseline", f"{base}/parquet", "--folder", lines, "--delay", "0 seconds", "--once"])
    read = spark.read.parquet
    assert read(f"{out}/ingest").count() == 8 and read(f"{out}/archive").count() == 8
    assert read(f"{out}/product_minutes").count() == 8
    signals = read(f"{out}/abandoned_carts").collect()
    assert [(r.session_id, r.cart_time) for r in signals] == [("s1", naive(1))]
    assert read(f"{out}/funnel").count() > 0 and read(f"{out}/trending").count() > 0


def test_compact_job(spark, tmp_path):
    row = [(naive(0), "1", v, e) for v, e in ((1, 10**12), (2, 10**12))]
    kinds = "bucket timestamp, product_id string, views long, expires_at long"
    for i, r in enumerate(row):
        spark.createDataFrame([r], kinds).write.parquet(str(tmp_path / f"totals/batch_id={i}"))
    spark.createDataFrame([(naive(0), "2", 1, 5)], kinds).write.parquet(str(tmp_path / "totals/batch_id=2"))
    compact.main([str(tmp_path / "totals"), str(tmp_path / "small"), "--keys", "bucket", "product_id"])
    kept = outputs.read_totals(spark, str(tmp_path / "small"), "bucket", "product_id").collect()
    assert [(r.product_id, r.views) for r in kept] == [("1", 2)]
