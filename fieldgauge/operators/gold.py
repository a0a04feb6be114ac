"""Silver rows to the three gold tables, by way of mergeable partials.

``partials`` reduces the readings once to one row per day and device (or per
day, device and hour), holding sums, counts, extremes and a bit set of active
hours. Each gold table is a second, much smaller aggregation of those rows. The
device is part of the partial key, so counting partial rows counts distinct
devices, and the bit set counts distinct hours: no distinct aggregate, and so
no row expansion, ever touches the readings. A device that sends a third of all
readings is collapsed inside each map task before anything is shuffled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from fieldgauge.functions import labels
from fieldgauge.functions.sql import date, measures, named, number, timestamp

DEVICE_KEY = ("event_date", "location", "deviceType", "deviceId")
HOUR_KEY = (*DEVICE_KEY, "hour_of_day")

# A valid row has all of these, so their count is the count of readings ...
_PRESENT = ("temperature", "humidity", "pressure", "light", "acidity", "data_quality_score")
# ... while these may be missing, and are counted on their own.
_OPTIONAL = ("battery_level", "signal_strength")
_COUNTED = {
    "motion_detections": "motion",
    "optimal_readings": "comfort_index = 'optimal'",
    "good_readings": "comfort_index = 'good'",
    "poor_readings": "comfort_index = 'poor'",
    "bright_light_readings": "light_category = 'bright'",
    "neutral_acidity_readings": "acidity_category = 'neutral'",
}


def partials(silver: DataFrame, by_hour: bool = True) -> DataFrame:
    """Mergeable measures of valid rows per device and day, split by hour if asked."""
    found = {
        "readings": "count(1)",
        **{f"{name}_sum": f"sum({name})" for name in (*_PRESENT, *_OPTIONAL)},
        **{f"{name}_n": f"count({name})" for name in _OPTIONAL},
        "temperature_min": "min(temperature)",
        "temperature_max": "max(temperature)",
        **{name: f"count_if({test})" for name, test in _COUNTED.items()},
        "hour_bits": "bit_or(shiftleft(1, hour_of_day))",
        "first_reading": "min(sensor_timestamp)",
        "last_reading": "max(sensor_timestamp)",
    }
    return silver.groupBy(*(HOUR_KEY if by_hour else DEVICE_KEY)).agg(*measures(found))


def fingerprints(silver: DataFrame) -> DataFrame:
    """(event_date, readings, digest): equal for a day whose rows are the same, in any order.

    The digest is the sum of a hash of each row, of all that gold uses; so it needs no sort,
    and one small row for each day and task is shuffled.
    """
    used = [*HOUR_KEY, *_PRESENT, *_OPTIONAL, "motion", "comfort_index", "light_category", "acidity_category", "sensor_timestamp"]
    digest = f"string(sum(CAST(xxhash64({', '.join(used)}) AS decimal(20, 0))))"
    return silver.groupBy("event_date").agg(*measures({"readings": "count(1)", "digest": digest}))


def merge_hours(parts: DataFrame) -> DataFrame:
    """Partials by hour, merged to one row per device and day."""
    added = ["readings", *_COUNTED]
    added += [f"{name}_sum" for name in (*_PRESENT, *_OPTIONAL)]
    added += [f"{name}_n" for name in _OPTIONAL]
    merged = {
        **{name: f"sum({name})" for name in added},
        "temperature_min": "min(temperature_min)",
        "temperature_max": "max(temperature_max)",
        "hour_bits": "bit_or(hour_bits)",
        "first_reading": "min(first_reading)",
        "last_reading": "max(last_reading)",
    }
    return parts.groupBy(*DEVICE_KEY).agg(*measures(merged))


def _mean(name: str) -> str:
    return f"try_divide(sum({name}_sum), sum(readings))"


def _percent(part: str, total: str) -> str:
    return f"({part}) * 100.0D / {total}"


def _finished(table: DataFrame, as_of: dt.datetime, derived: dict[str, str]) -> DataFrame:
    """Add what is derived from the measures, and the time of the run."""
    run = {"processing_time": timestamp(as_of), "processing_date": date(as_of)}
    return table.selectExpr("*", *named({**derived, **run}))


_MOTION = {"motion_percentage": _percent("motion_detections", "total_readings")}
_HOURLY_KEY = ("event_date", "hour_of_day", "location", "deviceType")


def hourly(by_hour: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Per day, hour, location and device type, from partials by hour."""
    found = {
        "total_readings": "sum(readings)",
        "unique_devices": "count(deviceId)",
        "avg_temperature": _mean("temperature"),
        "min_temperature": "min(temperature_min)",
        "max_temperature": "max(temperature_max)",
        "avg_humidity": _mean("humidity"),
        "avg_pressure": _mean("pressure"),
        "avg_light": _mean("light"),
        "avg_acidity": _mean("acidity"),
        "motion_detections": "sum(motion_detections)",
        "avg_quality_score": _mean("data_quality_score"),
    }
    return _finished(by_hour.groupBy(*_HOURLY_KEY).agg(*measures(found)), as_of, _MOTION)


def hourly_approx(silver: DataFrame, as_of: dt.datetime, rsd: float = 0.05) -> DataFrame:
    """Hourly table in one shuffle, with an estimated device count.

    Also runs on a stream, where exact distinct counts are refused. ``rsd`` is
    the relative standard deviation of the estimate.
    """
    found = {
        "total_readings": "count(1)",
        "unique_devices": f"approx_count_distinct(deviceId, {number(float(rsd))})",
        "avg_temperature": "avg(temperature)",
        "min_temperature": "min(temperature)",
        "max_temperature": "max(temperature)",
        "avg_humidity": "avg(humidity)",
        "avg_pressure": "avg(pressure)",
        "avg_light": "avg(light)",
        "avg_acidity": "avg(acidity)",
        "motion_detections": "count_if(motion)",
        "avg_quality_score": "avg(data_quality_score)",
    }
    return _finished(silver.groupBy(*_HOURLY_KEY).agg(*measures(found)), as_of, _MOTION)


# Sketches of 2**12 registers: a relative standard error of 1.04 / 64.
SKETCH_LOG = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG / 2)


def sketches(by_hour: DataFrame) -> DataFrame:
    """A sketch of the devices of each hourly row, from partials by hour."""
    devices = {"readings": "sum(readings)", "devices": f"hll_sketch_agg(deviceId, {SKETCH_LOG})"}
    return by_hour.groupBy(*_HOURLY_KEY).agg(*measures(devices))


def devices(stored_sketches: DataFrame, *keys: str) -> DataFrame:
    """Estimated distinct devices by any of the sketches' keys, over whatever days they hold.

    Exact distinct counts of two days cannot be added up; sketches are united instead, at a
    few kilobytes a row, without going back to the readings.
    """
    found = {"devices": "hll_sketch_estimate(hll_union_agg(devices))", "readings": "sum(readings)"}
    return stored_sketches.groupBy(*keys).agg(*measures(found))


def daily(by_device: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Per day, location and device type, from partials per device."""
    found = {
        "daily_readings": "sum(readings)",
        "active_devices": "count(deviceId)",
        "active_hours": "bigint(bit_count(bit_or(hour_bits)))",
        "daily_avg_temp": _mean("temperature"),
        "daily_min_temp": "min(temperature_min)",
        "daily_max_temp": "max(temperature_max)",
        "daily_avg_humidity": _mean("humidity"),
        "daily_avg_pressure": _mean("pressure"),
        "daily_avg_light": _mean("light"),
        "daily_avg_acidity": _mean("acidity"),
        "daily_motion_detections": "sum(motion_detections)",
        "daily_quality_score": _mean("data_quality_score"),
        **{name: f"sum({name})" for name in _COUNTED if name != "motion_detections"},
    }
    shares = {
        "comfort_percentage": "optimal_readings + good_readings",
        "motion_percentage": "daily_motion_detections",
        "bright_light_percentage": "bright_light_readings",
        "neutral_acidity_percentage": "neutral_acidity_readings",
    }
    return _finished(
        by_device.groupBy("event_date", "location", "deviceType").agg(*measures(found)),
        as_of,
        {name: _percent(part, "daily_readings") for name, part in shares.items()},
    )


def device(by_device: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Per day and device, from partials per device; no further shuffle."""

    def mean(name):
        return f"try_divide({name}_sum, {'readings' if name in _PRESENT else name + '_n'})"

    table = by_device.selectExpr(
        "event_date",
        "deviceId",
        "deviceType",
        "location",
        *named(
            {
                "total_readings": "readings",
                "active_hours": "bigint(bit_count(hour_bits))",
                "avg_temperature": mean("temperature"),
                "avg_humidity": mean("humidity"),
                "avg_pressure": mean("pressure"),
                "avg_light": mean("light"),
                "avg_acidity": mean("acidity"),
                "motion_detections": "motion_detections",
                "device_quality_score": mean("data_quality_score"),
                "avg_battery_level": mean("battery_level"),
                "avg_signal_strength": mean("signal_strength"),
            }
        ),
        "first_reading",
        "last_reading",
    )
    health = labels.device_health("device_quality_score", "active_hours", "avg_battery_level")
    return _finished(table, as_of, {**_MOTION, "device_health": health})
