"""A sensor feed derived from the ``events`` table.

There is no sensor table among the given data. Every event becomes one reading,
with missing values, values out of range and values between category bands
planted by arithmetic on the event id. ``FIXTURES.md`` states the rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldgauge import contract as C
from fieldgauge.functions.sql import first_match, named, text

TOPIC = "iot-sensor-data"
TOPIC_PARTITIONS = 3

_SITES = ("warehouse-a", "warehouse-b", "field-a", "field-b")
_LAST_SITE = "lab-a"

_READING = {
    "deviceId": "location || '-' || lpad(cast(user_id as string), 3, '0')",
    "temperature": """case when event_id % 97 = 0 then null
                           when event_id % 211 = 0 then -60.0D
                           when event_id % 50 = 0 then 95.5D
                           else cast((event_id * 37) % 500 as double) / 10.0D - 5.0D end""",
    "humidity": "cast((event_id * 53) % 1020 as double) / 10.0D",
    "pressure": """case when event_id % 61 = 0 then 850.0D
                        else 990.0D + cast((event_id * 29) % 500 as double) / 10.0D end""",
    "motion": """case when event_id % 101 = 0 then null
                      else event_type in ('click', 'purchase') end""",
    "light": "value * 6.0D",
    "acidity": """case when event_id % 127 = 0 then 14.5D
                       else 3.0D + cast((event_id * 17) % 80 as double) / 10.0D end""",
    "battery_level": """cast(cast(get_json_object(props, '$.k') as int) % 40
                        + (user_id % 4) * 20 + 1 as int)""",
    "signal_strength": "cast(-50 - (event_id % 45) as int)",
    "firmware_version": "'1.2.' || cast(event_id % 10 as string)",
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream of its files; the glob fits one file or a folder."""
    schema = events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events.parquet}}")


def readings(source: DataFrame) -> DataFrame:
    """One reading per event, batch or stream."""
    site = first_match(
        [(f"user_id % 5 = {n}", text(name)) for n, name in enumerate(_SITES)], text(_LAST_SITE)
    )
    return source.selectExpr("*", f"{site} AS location").selectExpr(
        "event_id",
        "location",
        "date_trunc('second', ts) AS sensor_timestamp",
        "unix_millis(timestamp(ts)) AS timestamp",
        *named(_READING),
    )


def _json() -> str:
    flat = ", ".join(f.name for f in C.READING_SCHEMA if f.name != "metadata")
    return f"to_json(struct({flat}, struct({', '.join(C.METADATA)}) AS metadata))"


def _messages(rows: DataFrame, value: str) -> DataFrame:
    return rows.selectExpr("*", f"{_json()} AS json").selectExpr(
        "binary(deviceId) AS key",
        f"binary({value}) AS value",
        f"{text(TOPIC)} AS topic",
        f"int(event_id % {TOPIC_PARTITIONS}) AS partition",
        "event_id AS offset",
        "timestamp_millis(timestamp) AS timestamp",
    )


def messages(rows: DataFrame) -> DataFrame:
    """Readings as broker messages: JSON in ``value``, absent fields left out."""
    return _messages(rows, "json")


# every way a producer gets a message wrong, by event number
_DAMAGE = [
    ("event_id % 71 = 0", "''"),
    ("event_id % 73 = 0", "concat('{', json)"),
    ("event_id % 79 = 0", """replace(json, '"deviceId"', '"device_id"')"""),
    ("event_id % 83 = 0", """replace(json, '"deviceId"', '"sensorId"')"""),
    ("event_id % 89 = 0", """replace(json, '"timestamp":', '"timestamp":"soon","was":')"""),
    ("event_id % 103 = 0", """replace(json, '"location"', '"place"')"""),
]


def damaged_messages(rows: DataFrame) -> DataFrame:
    """The same messages, some of them broken."""
    return _messages(rows, first_match(_DAMAGE, "json"))
