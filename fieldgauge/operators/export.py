"""Gold tables to the three serving marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.functions.sql import timestamp

TIMESERIES, DAILY, DEVICES = "iot_timeseries", "daily_report", "device_status"


def _exported(as_of: dt.datetime) -> str:
    return f"{timestamp(as_of)} AS exported_at"


def timeseries(hourly: DataFrame, as_of: dt.datetime) -> DataFrame:
    return hourly.selectExpr(
        "timestampadd(HOUR, hour_of_day, timestamp(event_date)) AS time",
        "avg_temperature AS temperature",
        "avg_humidity AS humidity",
        "avg_pressure AS pressure",
        "avg_quality_score AS data_quality",
        "total_readings AS sensor_readings",
        "deviceType AS device_type",
        "location",
        "unique_devices",
        _exported(as_of),
    )


def daily_report(daily: DataFrame, as_of: dt.datetime) -> DataFrame:
    return daily.selectExpr(
        "location",
        "deviceType AS device_type",
        "daily_readings AS total_readings",
        "active_devices",
        "active_hours",
        "daily_avg_temp AS avg_temperature",
        "daily_min_temp AS min_temperature",
        "daily_max_temp AS max_temperature",
        "daily_avg_humidity AS avg_humidity",
        "daily_avg_pressure AS avg_pressure",
        "daily_quality_score AS quality_score",
        "comfort_percentage",
        "optimal_readings",
        "good_readings",
        "poor_readings",
        "event_date AS report_date",
        _exported(as_of),
    )


def device_status(device: DataFrame, as_of: dt.datetime) -> DataFrame:
    return device.selectExpr(
        "deviceId AS device_id",
        "deviceType AS device_type",
        "location",
        "total_readings",
        "active_hours",
        "device_quality_score AS quality_score",
        "device_health AS health_status",
        "avg_temperature",
        "avg_humidity",
        "avg_pressure",
        "first_reading",
        "last_reading",
        "event_date AS report_date",
        _exported(as_of),
    )


def ordered(name: str, mart: DataFrame) -> DataFrame:
    """A mart in its row order.

    The last columns make the order total. They also give the range partitioner
    enough distinct keys, where health and score alone would send most devices
    to one task.
    """
    if name == TIMESERIES:
        return mart.orderBy("time", "location", "device_type")
    if name == DAILY:
        return mart.orderBy(F.desc("total_readings"), "report_date", "location", "device_type")
    return mart.orderBy("health_status", F.desc("quality_score"), "report_date", "device_id")


# The column that holds each mart's day.
DAY = {TIMESERIES: "time", DAILY: "report_date", DEVICES: "report_date"}


def marts(gold: dict[str, DataFrame], as_of: dt.datetime) -> dict[str, DataFrame]:
    """The serving tables from ``{"hourly", "daily", "device"}``."""
    return {
        TIMESERIES: timeseries(gold["hourly"], as_of),
        DAILY: daily_report(gold["daily"], as_of),
        DEVICES: device_status(gold["device"], as_of),
    }
