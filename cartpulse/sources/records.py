"""Stream records: an encoded JSON payload with a key."""

from pyspark.sql import DataFrame, functions as F, types as T

from cartpulse.operators.normalise import interpret_payloads
from cartpulse.schema import JSON_TEXT_SCHEMA

_PARSED = T.StructType([*JSON_TEXT_SCHEMA.fields, T.StructField("_corrupt_record", T.StringType())])


def decode_records(records: DataFrame, data: str = "data", base64: bool = True) -> DataFrame:
    """Interpreted events from records, batch or stream. ``data`` holds base64 text, or
    with ``base64=False`` plain bytes or text such as a Kafka value. The other columns
    (key, offset, sequence number, …) are kept, so a reject can be traced."""
    payload = F.try_to_binary(data, F.lit("base64")) if base64 else F.col(data)
    text = F.coalesce(payload.cast("string"), F.lit("undecodable"))
    kept = [c for c in records.columns if c != data]
    parsed = records.select(
        *kept,
        F.from_json(
            text, _PARSED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
        ).alias("p"),
    ).select(*kept, "p.*")
    return interpret_payloads(parsed)
