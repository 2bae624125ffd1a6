"""Raw text events to canonical events, with a reason for every reject."""

from pyspark.sql import Column, DataFrame, functions as F

from cartpulse.functions import cleaning
from cartpulse.schema import EVENT_COLUMNS, EVENT_TYPES

BAD_TIME = "invalid event_time"
BAD_SOURCE_TIME = "invalid source_event_time"
BAD_TYPE = "unsupported event_type"
BAD_PRICE = "invalid price"
NO_PRODUCT = "product_id is required"
NO_SESSION = "session_id is required"
BAD_JSON = "malformed record"

# Where a row came from; not part of the row as delivered.
_ENGINE_COLUMNS = ("seq", "source_row", "partition", "delivery")


def _column(raw: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in raw.columns else F.lit(None).cast("string")


def interpret_shop_rows(raw: DataFrame) -> DataFrame:
    """Adapter for the shop CSV columns: the event clock is also the source clock,
    and the session is ``user_session``, or ``session_id`` where that is empty."""
    session = F.coalesce(
        F.nullif(_column(raw, "user_session"), F.lit("")), _column(raw, "session_id")
    )
    return _interpret(raw, session, source_clock=None, fractional_epoch=False)


def interpret_payloads(raw: DataFrame) -> DataFrame:
    """Adapter for canonical JSON payloads read as text (``JSON_TEXT_SCHEMA``)."""
    return _interpret(
        raw, _column(raw, "session_id"), source_clock=_column(raw, "source_event_time"),
        fractional_epoch=True,
    )


def _interpret(
    raw: DataFrame, session: Column, source_clock: Column | None, fractional_epoch: bool
) -> DataFrame:
    """Canonical columns, ``reject_reason`` (null = accepted) and ``raw`` (the row as
    JSON text); further raw columns such as ``seq`` are passed through."""
    time = cleaning.event_time_of(_column(raw, "event_time"), fractional_epoch)
    price_text = _column(raw, "price")
    given = {"_price_given": F.coalesce(price_text, F.lit("")) != ""}
    if source_clock is None:
        source_time = time
    else:
        given["_source_given"] = F.coalesce(source_clock, F.lit("")) != ""
        source_time = cleaning.event_time_of(source_clock, fractional_epoch)
    canonical = {
        "event_time": time,
        "event_type": cleaning.event_type_of(_column(raw, "event_type")),
        "product_id": cleaning.text_or_empty(_column(raw, "product_id")),
        "user_id": cleaning.text_or_empty(_column(raw, "user_id")),
        "session_id": cleaning.text_or_empty(session),
        "category_id": cleaning.text_or_empty(_column(raw, "category_id")),
        "category_code": cleaning.text_or_empty(_column(raw, "category_code")),
        "brand": cleaning.text_or_empty(_column(raw, "brand")),
        "price": cleaning.price_of(price_text),
        "source_event_time": source_time,
    }
    passed = [c for c in raw.columns if c not in {*EVENT_COLUMNS, "user_session", "_corrupt_record"}]
    payload = [c for c in raw.columns if not c.startswith("source_file") and c not in _ENGINE_COLUMNS]
    if "_corrupt_record" in raw.columns:
        given["_corrupt"] = F.col("_corrupt_record").isNotNull()
    parsed = raw.select(
        *[column.alias(name) for name, column in {**canonical, **given}.items()],
        *passed,
        F.to_json(F.struct(*payload)).alias("raw"),
    )

    def unreadable(flag: str, value: str) -> Column:
        return F.col(flag) & F.col(value).isNull() if flag in given else F.lit(False)

    # The order of the checks decides which reason a row with several faults gets.
    reason = (
        F.when(F.col("_corrupt") if "_corrupt" in given else F.lit(False), BAD_JSON)
        .when(F.col("event_time").isNull(), BAD_TIME)
        .when(unreadable("_source_given", "source_event_time"), BAD_SOURCE_TIME)
        .when(F.col("event_type").isNull(), BAD_TYPE)
        .when(unreadable("_price_given", "price"), BAD_PRICE)
        .when(F.col("product_id") == "", NO_PRODUCT)
        .when(F.col("session_id") == "", NO_SESSION)
    )
    return parsed.withColumn("reject_reason", reason).drop(*given)


def accepted(interpreted: DataFrame, on_invalid: str = "quarantine") -> DataFrame:
    """Valid events. ``on_invalid="fail"`` stops the job at the first bad row instead
    of leaving it to ``rejected``."""
    reason = F.col("reject_reason")
    if on_invalid == "fail":
        message = F.concat(F.lit("invalid event: "), reason, F.lit(": "), F.col("raw"))
        keep = F.when(reason.isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    elif on_invalid == "quarantine":
        keep = reason.isNull()
    else:
        raise ValueError("on_invalid must be 'quarantine' or 'fail'")
    return interpreted.filter(keep).drop("reject_reason", "raw")


def rejected(interpreted: DataFrame) -> DataFrame:
    """Dead letters: where the row came from, why it was refused, and the row itself."""
    origin = [c for c in ("seq", "source_file", "source_row") if c in interpreted.columns]
    return interpreted.filter(F.col("reject_reason").isNotNull()).select(
        *origin, F.col("reject_reason").alias("reason"), "raw"
    )


def usable(events: DataFrame) -> DataFrame:
    """Events that already have canonical columns, reduced to the valid ones."""
    return events.filter(
        F.col("event_time").isNotNull()
        & F.col("event_type").isin(*EVENT_TYPES)
        & (F.col("product_id") != "")
        & (F.col("session_id") != "")
    )
