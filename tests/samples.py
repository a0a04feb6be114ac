"""Hand-made readings and messages."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import types as T

from fieldgauge import contract as C

NORMAL = {
    "deviceId": "warehouse-a-001",
    "temperature": 25.0,
    "humidity": 50.0,
    "pressure": 1013.0,
    "motion": False,
    "light": 400.0,
    "acidity": 7.0,
    "location": "warehouse-a",
    "timestamp": 1640995200000,
    "battery_level": 80,
    "signal_strength": -60,
    "firmware_version": "1.0.0",
}

_FLAT = T.StructType(
    [f for f in C.READING_SCHEMA if f.name != "metadata"]
    + list(C.READING_SCHEMA["metadata"].dataType)
    + [T.StructField("case", T.IntegerType())]
)


def readings(spark, *changes: dict):
    """One reading per dict of changes to a normal one, with its event time."""
    rows = [{**NORMAL, **change, "case": n} for n, change in enumerate(changes)]
    flat = spark.createDataFrame([tuple(r[f] for f in _FLAT.names) for r in rows], _FLAT)
    return flat.selectExpr("*", "timestamp_millis(timestamp) AS sensor_timestamp")


def message(**changes) -> str:
    flat = {**NORMAL, **changes}
    meta = {name: flat.pop(name) for name in C.METADATA}
    return json.dumps({**{k: v for k, v in flat.items() if v is not None}, "metadata": meta})


def envelopes(spark, *values: str | None, first_offset: int = 0):
    at = dt.datetime(2022, 1, 1)
    rows = [
        (b"k", None if v is None else v.encode(), "t", 0, n, at)
        for n, v in enumerate(values, first_offset)
    ]
    return spark.createDataFrame(rows, C.ENVELOPE_SCHEMA)
