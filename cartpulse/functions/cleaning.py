"""Text-to-value rules applied to raw events (all built-in expressions)."""

from pyspark.sql import Column, functions as F

from cartpulse.schema import EVENT_TYPE_ALIASES, MILLISECOND_EPOCH_FLOOR

_LAST_SECOND = 253_402_300_799  # 9999-12-31T23:59:59Z
_PLAIN_TIME = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?( UTC|Z|[+-]\d{2}:\d{2})?)?$"
)
_ANY_ISO_TIME = (
    r"^(\d{4}-\d{2}-\d{2}|\d{8})"
    r"([\s\S](\d{2}|\d{2}:\d{2}(:\d{2}([.,]\d+)?)?|\d{4}(\d{2}([.,]\d+)?)?)( UTC|Z|[+-]\d{2}(:?\d{2})?)?)?$"
)
_FLOAT = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
# Fixed value: the characters that count as white space around a value.
_WHITE_SPACE = "".join(
    chr(c)
    for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)


def strip(text: Column) -> Column:
    """Remove every kind of surrounding white space, not only blanks."""
    return F.trim(text, F.lit(_WHITE_SPACE))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def event_type_of(text: Column) -> Column:
    """Canonical event type, or null when the text names none."""
    word = F.lower(strip(text))
    result = None
    for canonical, words in EVENT_TYPE_ALIASES.items():
        match = word.isin(*words)
        result = F.when(match, canonical) if result is None else result.when(match, canonical)
    return result


def _epoch(number: Column) -> Column:
    return F.when(number <= MILLISECOND_EPOCH_FLOOR, F.timestamp_seconds(number)).when(
        number <= _LAST_SECOND * 1000 + 999, F.timestamp_millis(number)
    )


def _iso_rewritten(text: Column) -> Column:
    """Bring the rarer ISO spellings (basic form, odd separator, short offset, long or
    comma fraction, hour only) to the plain one."""
    steps = (
        (r" UTC|Z", "+00:00"),
        (r"^(\d{4})-?(\d{2})-?(\d{2})[\s\S]?", "$1-$2-$3T"),
        (r"T(\d{2}):?(\d{2})?:?(\d{2})?", "T$1:$2:$3"),
        (r"[.,](\d{1,6})\d*", ".$1"),
        (r"(:.*[+-]\d{2}):?(\d{2})?$", "$1:$2"),
        (r":(?!\d)", ":00"),
        (r"T$", ""),
    )
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def event_time_of(text: Column, fractional_epoch: bool = False) -> Column:
    """UTC timestamp of an epoch number (seconds or milliseconds) or ISO text;
    null when unreadable. Text without an offset counts as UTC.

    ``fractional_epoch`` also reads numbers with a fraction, which JSON can carry.
    The session time zone must be UTC. The shape is checked first because the
    lenient parser would turn a bare ``12:00:00`` into today.
    """
    parsed = F.when(text.rlike(_PLAIN_TIME), text.try_cast("timestamp"))
    text = strip(text)
    parsed = parsed.when(text.rlike(r"^\d+$"), _epoch(text.try_cast("bigint")))
    if fractional_epoch:
        number = text.try_cast("double")
        seconds = F.when(number > MILLISECOND_EPOCH_FLOOR, number / 1000).otherwise(number)
        parsed = parsed.when(
            text.rlike(r"(?i)^-?\d+(\.\d+)?(e[+-]?\d+)?$"),
            F.when(
                F.abs(seconds) <= _LAST_SECOND,
                F.timestamp_micros(F.rint(seconds * 1000000).cast("bigint")),
            ),
        )
    return parsed.when(text.rlike(_ANY_ISO_TIME), _iso_rewritten(text).try_cast("timestamp"))


def price_of(text: Column) -> Column:
    """Price as double; null when absent, unreadable or not finite. The shape is checked because the
    cast also takes suffixes such as ``12.5d``."""
    plain = F.when(text.contains("_"), F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")).otherwise(text)
    price = F.when(plain.rlike(_FLOAT), plain.try_cast("double"))
    return F.when(F.abs(price) < float("inf"), price)
