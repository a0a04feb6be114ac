"""Broker messages to typed readings, accepted and rejected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgauge import contract as C
from fieldgauge.functions import clock
from fieldgauge.functions.sql import every, first_match, named, text

_CORRUPT = "_corrupt_record"
_MISNAMED = "device_id"
_AUDIT_SCHEMA = T.StructType(
    [
        *C.READING_SCHEMA.fields,
        T.StructField(_MISNAMED, T.StringType()),
        T.StructField(_CORRUPT, T.StringType()),
    ]
)

ENVELOPE = ("kafka_key", "topic", "partition", "offset", "kafka_timestamp")
USABLE = "deviceId IS NOT NULL AND sensor_timestamp IS NOT NULL"


def envelope(messages: DataFrame) -> DataFrame:
    """Broker columns with key and value as text."""
    return messages.selectExpr(
        "string(key) AS kafka_key",
        "topic",
        "partition",
        "offset",
        "timestamp AS kafka_timestamp",
        "string(value) AS original_json",
    )


def unpack_json(rows: DataFrame, json: str, keep: list[str], schema=C.READING_SCHEMA) -> DataFrame:
    """``keep`` plus one column per JSON field.

    The parsed struct goes through ``inline`` because a generator is a place
    the optimizer does not move expressions across. As a plain column the parse
    would be copied into every filter on a parsed field and run once per copy.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = F.from_json(F.col(json), schema, options)
    return rows.select(*keep, F.inline(F.array(parsed)))


def parse(
    messages: DataFrame, epoch_unit: str = "ms", processing_time: str | None = None
) -> DataFrame:
    """Flat readings with event time and calendar parts; bad ones have nulls.

    ``processing_time`` is an expression, say ``current_timestamp()`` on a stream.
    """
    rows = unpack_json(envelope(messages), "original_json", [*ENVELOPE, "original_json"])
    timed = rows.selectExpr("*", f"{clock.event_time('timestamp', epoch_unit)} AS sensor_timestamp")
    extra = clock.calendar_parts("sensor_timestamp")
    if processing_time is not None:
        extra["processing_time"] = processing_time
    return timed.selectExpr(
        *ENVELOPE,
        "deviceId",
        "sensor_timestamp",
        *C.MEASURED,
        "location",
        "timestamp",
        *(f"metadata.{name}" for name in C.METADATA),
        "original_json",
        *named(extra),
    )


def accept(parsed: DataFrame) -> DataFrame:
    """Readings that name a device and a usable time."""
    return parsed.where(USABLE)


def raw_rows(accepted: DataFrame) -> DataFrame:
    """What the raw lake stores: the message as sent, and its date parts."""
    return accepted.select(F.col("original_json").alias("value"), *C.RAW_PARTITIONS)


def record_id(*origin: str, json: str = "original_json") -> str:
    """Stable id: a digest of the message and, where known, its broker position."""
    parts = ", ".join((*(f"string({name})" for name in origin), json))
    return f"sha2(concat_ws('|', {parts}), 256)"


def judge(messages: DataFrame, epoch_unit: str = "ms") -> DataFrame:
    """Every message with ``usable`` and the first reason against it, null if there is none.

    ``event_date`` is the day of arrival. A message without a place is usable and has a reason.
    """
    rows = unpack_json(
        envelope(messages), "original_json", [*ENVELOPE, "original_json"], _AUDIT_SCHEMA
    )
    nothing_read = every(f"{f.name} IS NULL" for f in _AUDIT_SCHEMA if f.name != _CORRUPT)
    blank = "trim(coalesce(original_json, '')) = ''"
    # a JSON null is well-formed, though it names no device
    malformed = f"{_CORRUPT} IS NOT NULL AND trim(original_json) <> 'null'"
    time = clock.event_time("timestamp", epoch_unit)
    reason = first_match(
        [
            (f"{blank} OR ({nothing_read} AND {malformed})", "'unparseable'"),
            ("deviceId IS NULL", "'missing_device_id'"),
            (f"({time}) IS NULL", f"'{C.NO_TIME}'"),
            ("location IS NULL", "'missing_location'"),
        ]
    )
    return rows.selectExpr(
        *ENVELOPE,
        "original_json",
        f"{reason} AS reason",
        f"deviceId IS NULL AND {_MISNAMED} IS NOT NULL AS misnamed_device_id",
        f"deviceId IS NOT NULL AND ({time}) IS NOT NULL AS usable",
        "to_date(kafka_timestamp) AS event_date",
    )


def dead_letter(messages: DataFrame, epoch_unit: str = "ms") -> DataFrame:
    """Rejected or incomplete messages, each with the first reason that applies."""
    return judge(messages, epoch_unit).where("reason IS NOT NULL").drop("usable", "event_date")


def dead_letter_sample(rejected: DataFrame, size: int = 10) -> DataFrame:
    """A few rejects to look at, the same ones on every run."""
    return rejected.orderBy("topic", "partition", "offset").limit(size)


def required_fields(messages: DataFrame, names: list[str]) -> DataFrame:
    """For each message, which of the named top-level JSON fields are absent."""
    wanted = ", ".join(map(text, names))
    found = "coalesce(json_object_keys(original_json), array())"
    return (
        envelope(messages)
        .selectExpr(*ENVELOPE, f"array_except(array({wanted}), {found}) AS missing")
        .selectExpr(
            *ENVELOPE,
            "size(missing) = 0 AS is_complete",
            "concat_ws(',', missing) AS missing_fields",
        )
    )
