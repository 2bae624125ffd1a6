import json

from pyspark.sql import functions as F

from conftest import EIGHT, events_of, naive
from cartpulse import schema
from cartpulse.functions import metrics
from cartpulse.operators import baseline, replay, serving, trailing
from cartpulse.plans import documents
from cartpulse.sinks import tables
from cartpulse.sources import files

BASELINE = "product_id string, avg_views_5m double, avg_carts_5m double, avg_purchases_5m double, avg_trend_score_5m double"
RECENT = "product_id string, views long, carts long, removals long, purchases long, trend_score long"


def test_twice_the_mean_is_unusual(spark):
    recent = spark.createDataFrame([("7", 5, 0, 0, 3, 20)], RECENT)
    normal = spark.createDataFrame([("7", 2.0, 1.0, 1.0, 10.0)], BASELINE)
    row = serving.trending(recent, normal).first()
    assert row.activity_lift == 2.0 and row.is_unusually_trending
    assert (row.normal_views_5m, row.normal_trend_score_5m) == (2.0, 10.0)


def test_ranking_and_missing_baselines(spark):
    recent = spark.createDataFrame(
        [("a", 1, 0, 0, 0, 1), ("b", 9, 0, 0, 0, 9), ("c", 4, 0, 0, 0, 4), ("d", 4, 0, 0, 0, 4), ("e", 8, 0, 0, 0, 8)], RECENT
    )
    normal = spark.createDataFrame(
        [("a", 0.1, 0.0, 0.0, 0.1), ("c", 4.0, 0.0, 0.0, 4.0), ("d", 4.0, 0.0, 0.0, 4.0), ("e", 0.0, 0.0, 0.0, 0.0)], BASELINE
    )
    ranked = serving.trending(recent, normal).collect()
    assert [(r.product_id, r.activity_lift, r.is_unusually_trending) for r in ranked] == [
        ("a", 10.0, True), ("c", 1.0, False), ("d", 1.0, False), ("b", None, False), ("e", None, False),
    ]
    # with candidates by score the small product with the large lift is not seen
    assert "a" not in [r.product_id for r in serving.trending(recent, normal, candidates=3).collect()]
    assert len(serving.trending(recent, normal, n=2).collect()) == 2


def test_baseline_columns_may_be_missing(spark, tmp_path):
    path = tmp_path / "baseline.json"
    path.write_text(json.dumps([
        {"product_id": 100, "avg_views_5m": 1.5, "avg_trend_score_5m": 7.0},
        {"product_id": "200", "avg_trend_score_5m": 0.3},
    ], indent=2))
    normal = files.read_baseline_json(spark, str(path))
    recent = spark.createDataFrame([("100", 1, 0, 0, 0, 7), ("200", 1, 0, 0, 0, 1)], RECENT)
    got = {r.product_id: r for r in serving.compare(recent, normal).collect()}
    assert (got["100"].activity_lift, got["100"].normal_carts_5m) == (1.0, 0.0)
    assert got["200"].activity_lift == round(1 / 0.3, 3)
    slim = normal.select("product_id", "avg_trend_score_5m")
    assert serving.compare(recent, slim).filter("normal_views_5m = 0").count() == 2


def test_threshold_sensitivity(spark):
    compared = spark.createDataFrame([(20, 10.0), (30, 10.0), (5, 0.0)], "trend_score long, normal_score_exact double")
    got = serving.threshold_sensitivity(compared, [1.0, 2.0, 2.5, 4.0]).orderBy("threshold").collect()
    assert [(r.threshold, r.flagged_products, r.products) for r in got] == [(1.0, 2, 3), (2.0, 2, 3), (2.5, 1, 3), (4.0, 0, 3)]


def test_replayed_fixture_answers_the_question(spark, eight, tmp_path):
    """Replay everything inside one window, then snapshot, baseline and serving document."""
    moved = replay.rebase(eight, F.lit(naive(10_000)).cast("timestamp"), events_per_second=1000)
    normal = baseline.baseline(moved)
    snapshot = documents.snapshot_document(moved)
    stored = str(tmp_path / "snapshot")
    tables.write_document(snapshot, stored)
    again = files.read_snapshot(spark, stored)
    assert again.first() == snapshot.first()
    doc = documents.serving_document(again, normal).first().asDict(recursive=True)
    first, second = doc["trending_products"]
    assert (first["product_id"], first["trend_score"], first["normal_trend_score_5m"]) == ("200", 5, 2.5)
    assert (first["activity_lift"], first["is_unusually_trending"]) == (2.0, True)
    assert (second["product_id"], second["trend_score"], second["activity_lift"]) == ("100", 13, 1.0)
    assert not second["is_unusually_trending"]
    assert (doc["funnel"]["view_to_cart_dropoff"], doc["funnel"]["cart_to_purchase_dropoff"]) == (0.25, 0.6667)
    assert doc["definition"] == schema.DEFINITION and doc["abandoned_cart_signals_total"] == 0
    assert doc["performance"] == {"events_in_window": 8, "processed_events_total": 8}
    row = trailing.with_larger_loss(snapshot.select("funnel.*")).first()
    assert row.larger_loss == "cart_to_purchase"
    assert [r.product_id for r in documents.trending_now(moved).collect()] == ["200", "100"]
    written = json.loads(spark.read.text(stored).first()[0])
    assert written["window_seconds"] == 300 and written["latest_abandoned_carts"] == []
    assert written["as_of"].endswith("+00:00")


def test_null_lift_is_exported(spark, tmp_path):
    recent = events_of(spark, EIGHT[5:])
    doc = documents.serving_document(
        documents.snapshot_document(recent), spark.createDataFrame([], BASELINE)
    )
    out = str(tmp_path / "serving")
    tables.write_document(doc, out)
    product = json.loads(spark.read.text(out).first()[0])["trending_products"][0]
    assert product["activity_lift"] is None and product["is_unusually_trending"] is False


def test_lift_threshold_column(spark):
    df = spark.createDataFrame([(3.0, 2.0)], "c double, n double")
    assert df.select(metrics.is_unusual(F.col("c"), F.col("n"), 1.5)).first()[0]


def test_last_row_of_a_repeated_product_counts(spark, tmp_path):
    row = {c: None for c in schema.BASELINE_SCHEMA.fieldNames()}
    lines = [json.dumps({**row, "product_id": "1", "avg_trend_score_5m": s}) for s in (2.0, 5.0)]
    (tmp_path / "base.json").write_text(f"[{','.join(lines)}]")
    normal = files.read_baseline_json(spark, str(tmp_path / "base.json"))
    recent = spark.createDataFrame([("1", 10)], "product_id string, trend_score long")
    assert [r.activity_lift for r in serving.compare(recent, normal).collect()] == [2.0]
    ordered = normal.withColumn("place", -F.col("avg_trend_score_5m"))
    assert [r.activity_lift for r in serving.compare(recent, ordered, order="place").collect()] == [5.0]


def test_only_the_history_of_recent_products_is_aggregated(spark, eight):
    plan = documents.trending_now(eight, window="1 minute")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    semi = [i for i, line in enumerate(plan) if "Join LeftSemi" in line]
    expand = next(i for i, line in enumerate(plan) if "Expand" in line)
    # The semi join lies below the expansion into grouping sets of the baseline.
    assert any(i > expand and depth(plan[i]) > depth(plan[expand]) for i in semi)
    got = documents.trending_now(eight, window="1 minute").collect()
    assert [r.product_id for r in got] == ["200"]
