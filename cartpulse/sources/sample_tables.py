"""Adapters that read the sample tables as shop data.

``events(event_id, ts, user_id, event_type, value, props)`` becomes the event stream:
a click counts as a cart, an error as a removal, a signup has no meaning in a shop and is
refused; the product is ``props.k``, the session the user, the price the value. The value
also serves as processing delay in seconds, and the user id modulo 7 as load experiment.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartpulse.sinks.payloads import latency_line

_KINDS = {"view": "view", "click": "cart", "error": "remove_from_cart", "purchase": "purchase"}
_SPELLINGS = {"view": " VIEW", "click": "AddToCart ", "error": "removefromcart", "purchase": "Transaction"}


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _spelled(words: dict[str, str]):
    kind = F.col("event_type")
    result = None
    for source, word in words.items():
        result = F.when(kind == source, word) if result is None else result.when(kind == source, word)
    return result


def canonical(rows: DataFrame) -> DataFrame:
    """Canonical events of ``events`` rows, batch or stream; refused rows are left out."""
    time = F.col("ts").cast("timestamp")
    experiment = F.concat(F.lit("run-"), F.pmod("user_id", F.lit(7)))
    delay_us = F.round(F.col("value") * 1000).cast("bigint") * 1000
    return (
        rows.filter(F.col("event_type").isin(*_KINDS))
        .select(
            time.alias("event_time"),
            _spelled(_KINDS).alias("event_type"),
            F.get_json_object("props", "$.k").alias("product_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.col("user_id").cast("string").alias("session_id"),
            F.lit("").alias("category_id"),
            F.lit("").alias("category_code"),
            F.lit("").alias("brand"),
            F.col("value").alias("price"),
            time.alias("source_event_time"),
            F.col("event_id").alias("seq"),
            F.nullif(experiment, F.lit("run-0")).alias("experiment_id"),
            F.timestamp_micros(F.unix_micros(time) + delay_us).alias("processed_at"),
        )
        .filter((F.col("product_id") != "") & (F.col("session_id") != ""))
    )


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(_events(spark, sf_dir))


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as untrusted text: mixed spellings of types, five notations of
    time by event id, and some rows without session or with a broken price."""
    ts, n = F.col("ts"), F.pmod("event_id", F.lit(5))
    micros = F.unix_micros(ts.cast("timestamp"))
    time = (
        F.when(n == 0, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))
        .when(n == 1, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
        .when(n == 2, F.call_function("div", micros, F.lit(1_000_000)).cast("string"))
        .when(n == 3, F.call_function("div", micros, F.lit(1_000)).cast("string"))
        .otherwise(F.date_format(ts, "yyyyMMdd'T'HHmmss"))
    )
    session = F.when(F.col("value") < 0.5, "").otherwise(F.col("user_id").cast("string"))
    price = F.when(F.col("value") > 150, "n/a").otherwise(F.col("value").cast("string"))
    return _events(spark, sf_dir).select(
        time.alias("event_time"),
        F.coalesce(_spelled(_SPELLINGS), F.col("event_type")).alias("event_type"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.col("user_id").cast("string").alias("user_id"),
        session.alias("user_session"),
        price.alias("price"),
        F.col("event_id").alias("seq"),
    )


def catalogued_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The untrusted rows with the shop's own brand and category, both missing for some products."""
    k = F.col("product_id").cast("int")
    return raw_rows(spark, sf_dir).withColumns(
        {
            "category_id": (F.lit(2_000) + k % 7).cast("string"),
            "category_code": F.when(k % 7 > 0, F.concat(F.lit("shop.c"), k % 7)),
            "brand": F.when(k % 5 > 0, F.concat(F.lit("Brand "), k % 5)),
        }
    )


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a feed in key order; their dates jump back and forth."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("seq"), F.col("o_orderdate").alias("event_time")
    )


def load_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load run per product of ``events``: every event was sent, refused ones were not
    processed unless the run id is even."""
    processed = F.col("event_type").isin(*_KINDS) | (F.pmod("user_id", F.lit(10)) > 0)
    runs = (
        _events(spark, sf_dir)
        .groupBy(F.get_json_object("props", "$.k").cast("int").alias("k"))
        .agg(
            F.min(F.col("ts").cast("timestamp")).alias("started_at_utc"),
            F.max(F.col("ts").cast("timestamp")).alias("completed_at_utc"),
            F.count("*").alias("sent_records"),
            F.count_if(processed | (F.pmod(F.get_json_object("props", "$.k").cast("int"), F.lit(2)) == 0))
            .alias("processed_records"),
            F.min("value").alias("p50_latency_ms"),
            F.max("value").alias("p95_latency_ms"),
        )
    )
    seconds = (F.unix_micros("completed_at_utc") - F.unix_micros("started_at_utc")) / 1e6
    return runs.select(
        F.concat(F.lit("run-"), "k").alias("experiment_id"),
        "started_at_utc",
        "completed_at_utc",
        (100 * (1 + F.pmod("k", F.lit(3)))).alias("target_rate_eps"),
        "sent_records",
        "processed_records",
        seconds.alias("producer_seconds"),
        "p50_latency_ms",
        "p95_latency_ms",
    )


def worker_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as cluster trials: line number = workers, price = duration."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_linenumber").alias("worker_count"),
        F.col("l_extendedprice").alias("duration_seconds"),
        F.when(F.col("l_linestatus") == "F", "completed").otherwise("failed").alias("status"),
    )


def worker_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cluster sample per minute that has events; the workers are the distinct types."""
    minute = F.call_function("div", F.unix_seconds(F.col("ts").cast("timestamp")), F.lit(60))
    return _events(spark, sf_dir).groupBy((minute * 60).alias("elapsed_seconds")).agg(
        F.count_distinct("event_type").alias("total_workers")
    )


def latency_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines as a processor would print them, one per event."""
    return shop_events(spark, sf_dir).select(latency_line().alias("message"))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_brand").alias("part_brand"),
        F.col("p_type").alias("part_category"),
    )

