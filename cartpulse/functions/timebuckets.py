"""Clock, bucket and latency expressions."""

from pyspark.sql import Column, functions as F

from cartpulse.schema import RETENTION

_UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def micros_of(span: str) -> int:
    """Length of a span such as ``5 minutes`` in microseconds."""
    amount, unit = span.split()
    return int(amount) * _UNITS[unit.rstrip("s")]


def interval(span: str) -> Column:
    return F.expr(f"INTERVAL {span}")


def history_clock() -> Column:
    """The source clock where known, else the replay clock."""
    return F.coalesce(F.col("source_event_time"), F.col("event_time"))


def minute_of(time: Column) -> Column:
    return F.date_trunc("minute", time)


def slot_of(time: Column, micros: int) -> Column:
    """Number of the epoch-aligned slot of the given width that holds ``time``."""
    at = F.unix_micros(time)
    return whole_div(at - F.pmod(at, F.lit(micros)), micros)


def whole_div(number: Column, divisor: int) -> Column:
    """Integer quotient as bigint."""
    return F.call_function("div", number, F.lit(divisor).cast("bigint"))


def stream_key(time: Column, seq: Column) -> Column:
    """(time, seq) as one number that sorts the same way. Unlike a struct it can be the
    buffer of a hash aggregation, which spares a sort of all rows."""
    whole = "decimal(19,0)"
    return F.unix_micros(time).cast(whole) * F.lit(str(1 << 63)).cast(whole) + seq.cast(whole)


def expires_at(time: Column, retention: str = RETENTION) -> Column:
    return F.unix_seconds(time + interval(retention))


def latency_ms(processed_at: Column, event_time: Column) -> Column:
    """Whole milliseconds from event to processing, never negative."""
    micros = F.unix_micros(processed_at) - F.unix_micros(event_time)
    return F.greatest(F.lit(0).cast("bigint"), whole_div(micros, 1000))


def utc_text(time: Column) -> Column:
    """ISO text with a ``+00:00`` offset; the fraction is written only when there is one."""
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.when(
        F.unix_micros(time) % 1_000_000 != 0, F.date_format(time, ".SSSSSS")
    ).otherwise("")
    return F.concat(whole, fraction, F.lit("+00:00"))
