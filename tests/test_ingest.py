import base64
import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from conftest import CSV, T0, at, events_of, naive
from cartpulse import schema
from cartpulse.operators import normalise, ordered, quality, replay, trailing
from cartpulse.sinks import payloads, tables
from cartpulse.sources import files, records


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(CSV)
    return str(path)


def test_reads_rows_by_header_name(spark, csv_file, tmp_path):
    rows = normalise.accepted(files.read_shop_csv(spark, csv_file)).orderBy("seq").collect()
    assert len(rows) == 8
    first = rows[0]
    assert first.event_time == T0.replace(tzinfo=None) and first.source_event_time == first.event_time
    assert (first.event_type, first.product_id, first.session_id, first.user_id) == ("view", "100", "s1", "u1")
    assert (first.category_id, first.category_code, first.brand, first.price) == ("10", "shop.100", "acme", 100.5)
    shuffled = tmp_path / "other.csv"
    shuffled.write_text(
        "user_session,price,product_id,user_id,event_type,event_time\n"
        's1,,"1,00",u,AddToCart,1569888000\n'
    )
    row = normalise.accepted(files.read_shop_csv(spark, str(shuffled))).first()
    assert (row.product_id, row.event_type, row.price, row.brand) == ("1,00", "cart", None, "")


def test_gzip_gives_the_same_rows(spark, csv_file, tmp_path):
    path = tmp_path / "events.csv.gz"
    path.write_bytes(gzip.compress(CSV.encode()))
    drop = ("source_file",)
    plain = files.read_shop_csv(spark, csv_file).drop(*drop)
    assert files.read_shop_csv(spark, str(path)).drop(*drop).exceptAll(plain).count() == 0


def test_missing_columns_are_named_in_order(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text("event_time,product_id\n1,2\n")
    with pytest.raises(ValueError, match=r"\['event_type', 'user_id', 'user_session'\]"):
        files.read_shop_csv(spark, str(path))


def test_rejects_carry_row_number_reason_and_row(spark, tmp_path):
    good = "2019-10-01 00:00:00 UTC,view,100,u1,s1,\n"
    bad = [
        ("soon,view,100,u1,s1,\n", normalise.BAD_TIME),
        ("2019-10-01,checkout,100,u1,s1,\n", normalise.BAD_TYPE),
        ("2019-10-01,view,100,u1,s1,cheap\n", normalise.BAD_PRICE),
        ("2019-10-01,view,,u1,s1,1\n", normalise.NO_PRODUCT),
        ("2019-10-01,view,100,u1,,1\n", normalise.NO_SESSION),
        ("soon,checkout,,u1,,cheap\n", normalise.BAD_TIME),
    ]
    path = tmp_path / "mixed.csv"
    path.write_text(
        "event_time,event_type,product_id,user_id,user_session,price\n"
        + "".join(good + line for line, _ in bad)
    )
    rows = files.read_shop_csv(spark, str(path))
    got = normalise.rejected(rows).orderBy("source_row").collect()
    assert [(r.source_row, r.reason) for r in got] == [
        (3 + 2 * i, reason) for i, (_, reason) in enumerate(bad)
    ]
    assert json.loads(got[1].raw)["event_type"] == "checkout"
    assert normalise.accepted(rows).count() == len(bad)
    summary = quality.ingest_summary(rows).first()
    assert tuple(summary) == (12, 6, 6, 50.0)
    with pytest.raises(Exception, match="invalid event"):
        normalise.accepted(rows, on_invalid="fail").collect()


def test_session_falls_back_to_the_second_column(spark, tmp_path):
    path = tmp_path / "two.csv"
    path.write_text(
        "event_time,event_type,product_id,user_id,user_session,session_id\n"
        "2019-10-01,view,1,u,,backup\n2019-10-01,view,1,u,first,backup\n"
    )
    rows = normalise.accepted(files.read_shop_csv(spark, str(path))).orderBy("seq").collect()
    assert [r.session_id for r in rows] == ["backup", "first"]


def test_row_numbers_and_limit_over_many_splits_and_files(spark, tmp_path):
    header = "event_time,event_type,product_id,user_id,user_session\n"
    counts = {"a.csv": 700, "b.csv": 3000, "c.csv": 50}
    for name, n in counts.items():
        lines = (f"2019-10-01,{'view' if i % 3 else 'junk'},{name[0]}{i},u,s\n" for i in range(n))
        (tmp_path / name).write_text(header + "".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        rows = files.read_shop_csv(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 5
        got = [(r.seq, r.product_id, r.source_row) for r in rows.orderBy("seq").collect()]
        limited = files.read_shop_csv(spark, str(tmp_path), limit=1000)
        assert limited.count() == 1000
        assert limited.filter("product_id like 'b%'").count() == 300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = [(f"{name[0]}{i}", i + 2) for name, n in sorted(counts.items()) for i in range(n)]
    assert got == [(seq, product, row) for seq, (product, row) in enumerate(expected)]
    by_position = replay.limit_source_rows(rows, 1000)
    assert by_position.agg(F.max("seq")).first()[0] == 999


def test_json_lines_round_trip(spark, csv_file, tmp_path):
    events = normalise.accepted(files.read_shop_csv(spark, csv_file))
    out = str(tmp_path / "jsonl")
    payloads.write_json_lines(events, out)
    line = json.loads(spark.read.text(out).filter("value like '%00:01:00%'").first()[0])
    assert list(line) == list(schema.EVENT_COLUMNS)
    assert line["event_time"] == "2019-10-01T00:01:00+00:00" and line["price"] == 100.5
    back = normalise.accepted(files.read_payload_lines(spark, out), on_invalid="fail")
    columns = schema.EVENT_COLUMNS
    assert back.select(*columns).exceptAll(events.select(*columns)).count() == 0
    assert back.count() == 8


def test_ordered_json_lines_read_back_in_order(spark, tmp_path):
    n = 5000
    shuffled = spark.range(n).select(
        F.timestamp_seconds(F.lit(1569888000) + F.floor(F.col("id") / 7)).alias("event_time"),
        F.lit("view").alias("event_type"), F.col("id").cast("string").alias("product_id"),
        *[F.lit("x").alias(c) for c in schema.EVENT_COLUMNS[3:8]], F.lit(1.0).alias("price"),
        F.lit(None).cast("timestamp").alias("source_event_time"), F.col("id").alias("seq"),
    ).orderBy(F.rand(3))
    out = tmp_path / "ordered"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        payloads.write_json_lines(shuffled, str(out), order=("event_time", "seq"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list(out.glob("part-*"))) > 1
    back = normalise.accepted(files.read_payload_lines(spark, str(out)), "fail")
    assert back.filter(F.col("seq") != F.col("product_id").cast("long")).count() == 0 and back.count() == n


def test_strict_json_lines(spark, tmp_path):
    good = {"event_time": 1569888000, "event_type": "view", "product_id": 5, "session_id": "s", "price": None}
    path = tmp_path / "events.jsonl"
    path.write_text(json.dumps(good) + "\n\n   \n" + json.dumps({**good, "event_time": 1569888000.25}) + "\n")
    rows = normalise.accepted(files.read_payload_lines(spark, str(path)), "fail").orderBy("seq").collect()
    assert [(r.product_id, r.user_id, r.price, r.source_event_time) for r in rows] == [("5", "", None, None)] * 2
    assert rows[1].event_time == naive(0) + dt.timedelta(seconds=0.25)
    path.write_text(json.dumps(good) + "\n{broken\n" + json.dumps({**good, "product_id": None}) + "\n")
    bad = normalise.rejected(files.read_payload_lines(spark, str(path))).orderBy("source_row").collect()
    assert [(r.source_row, r.reason) for r in bad] == [(2, normalise.BAD_JSON), (3, normalise.NO_PRODUCT)]
    with pytest.raises(Exception, match="malformed record"):
        normalise.accepted(files.read_payload_lines(spark, str(path)), "fail").collect()


def test_records_decode_and_bad_ones_are_isolated(spark):
    good = {"event_time": "2019-10-01T00:00:00Z", "event_type": "cart", "product_id": "1", "session_id": "s",
            "source_event_time": "nonsense"}
    data = [
        (1, base64.b64encode(json.dumps({**good, "source_event_time": None, "experiment_id": "x"}).encode()).decode()),
        (2, base64.b64encode(json.dumps(good).encode()).decode()),
        (3, base64.b64encode(b"{not json").decode()),
        (4, "%%%"),
        (5, None),
    ]
    rows = records.decode_records(spark.createDataFrame(data, "offset long, data string"))
    kept = normalise.accepted(rows).collect()
    assert [(r.offset, r.event_type, r.experiment_id) for r in kept] == [(1, "cart", "x")]
    reasons = {r.offset: r.reject_reason for r in rows.collect()}
    assert reasons == {
        1: None, 2: normalise.BAD_SOURCE_TIME, 3: normalise.BAD_JSON, 4: normalise.BAD_JSON, 5: normalise.BAD_JSON,
    }


def test_keyed_records_carry_experiment_and_session(spark, csv_file, tmp_path):
    events = normalise.accepted(files.read_shop_csv(spark, csv_file))
    record = payloads.keyed_records(events.filter("seq = 0"), "load-7").first()
    assert record.key == "s1" and record.value.endswith("}\n")
    assert json.loads(record.value)["experiment_id"] == "load-7"
    assert "experiment_id" not in json.loads(payloads.keyed_records(events).first().value)


def test_keyed_files_keep_each_session_in_order(spark, tmp_path):
    n = 4000
    events = spark.range(n).select(
        F.timestamp_seconds(F.lit(1569888000) + F.lit(n) - F.col("id")).alias("event_time"),
        F.lit("view").alias("event_type"), F.lit("1").alias("product_id"), F.lit("u").alias("user_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("session_id"),
        F.lit("").alias("category_id"), F.lit("").alias("category_code"), F.lit("").alias("brand"),
        F.lit(1.0).alias("price"), F.lit(None).cast("timestamp").alias("source_event_time"), F.col("id").alias("seq"),
    )
    out = tmp_path / "keyed"
    payloads.write_keyed_files(events, str(out))
    seen = {}
    for part in sorted(out.glob("part-*")):
        for r in spark.read.parquet(str(part)).collect():
            seen.setdefault(r.key, []).append(json.loads(r.value)["event_time"])
    assert sum(map(len, seen.values())) == n and all(times == sorted(times) for times in seen.values())


def test_interpreted_rows_split_in_one_pass(spark, csv_file, tmp_path):
    out = str(tmp_path / "split")
    tables.write_interpreted(files.read_shop_csv(spark, csv_file), out)
    assert spark.read.parquet(out).filter("status = 'accepted'").count() == 8


def test_archive_bounds_prune_folders_and_reach_the_scan(spark, csv_file, tmp_path):
    out = str(tmp_path / "archive")
    events = normalise.accepted(files.read_shop_csv(spark, csv_file))
    later = events.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 3 DAYS"))
    kept = [*schema.EVENT_COLUMNS, "seq"]
    tables.write_archive(events.select(*kept).unionAll(later.select(*kept)), out)
    part = files.read_archive(spark, out, since=at(3 * 1440 + 4))
    assert part.count() == 4
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "GreaterThanOrEqual(event_time" in plan
    assert files.read_archive(spark, out, until=at(10)).count() == 7


def test_unusable_canonical_events_are_filtered(spark):
    rows = [
        (T0, "view", "1", "s"), (None, "view", "1", "s"), (T0, "click", "1", "s"), (T0, "view", "", "s"),
        (T0, "view", None, "s"), (T0, "view", "1", ""), (T0, None, "1", "s"),
    ]
    df = spark.createDataFrame(rows, "event_time timestamp, event_type string, product_id string, session_id string")
    assert normalise.usable(df).count() == 1


def test_blank_lines_count_as_lines(spark, tmp_path):
    good = '{"event_time":"2019-10-01T00:00:00Z","event_type":"view","product_id":"1","session_id":"s"}'
    (tmp_path / "lines.json").write_text(f"{good}\n\n  \nnot json\n{good}\n")
    rows = files.read_payload_lines(spark, str(tmp_path / "lines.json"))
    assert [(r.source_row, r.reason) for r in normalise.rejected(rows).collect()] == [(4, normalise.BAD_JSON)]
    assert sorted(r.source_row for r in normalise.accepted(rows).collect()) == [1, 5]


def test_trailing_window_reads_only_the_dates_it_needs(spark, tmp_path):
    rows = [(day * 1440 + i, "view", str(i), "s") for day in range(5) for i in range(3)]
    tables.write_archive(events_of(spark, rows), str(tmp_path / "archive"))
    recent = trailing.in_window(files.read_archive(spark, str(tmp_path / "archive")))
    assert sorted(r.product_id for r in recent.collect()) == ["0", "1", "2"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan.split("Subquery")[0]


def test_first_rows_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(ordered, "CHUNK", 10)
    rows = spark.createDataFrame([(i * 7,) for i in range(40)], "seq long")
    for n in (0, 1, 15, 40, 99):
        got = ordered.first_rows(rows, n)
        assert sorted(r.seq for r in got.collect()) == [i * 7 for i in range(min(n, 40))]
