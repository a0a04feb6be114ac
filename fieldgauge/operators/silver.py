"""Bronze rows to validated, enriched silver rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from fieldgauge import contract as C
from fieldgauge.functions import clock, labels, rules
from fieldgauge.functions.sql import date, named, one_of, text, timestamp

_CARRIED = (
    "bronze_ingestion_time",
    "bronze_date",
    "year",
    "month",
    "day",
    "event_date",
    "data_source",
    "ingestion_job",
    "record_id",
    "deviceId",
    "deviceType",
    "location",
    "temperature",
    "humidity",
    "pressure",
    "motion",
    "light",
    "acidity",
)


def standardize(bronze: DataFrame) -> DataFrame:
    """The columns silver works with: event time typed, metadata as a struct."""
    return bronze.selectExpr(
        *_CARRIED,
        f"{clock.event_time('timestamp')} AS sensor_timestamp",
        f"struct({', '.join(C.METADATA)}) AS sensor_metadata",
    )


def _enrichment(bands: str) -> dict[str, str]:
    time, battery, signal = "sensor_timestamp", "sensor_metadata.battery_level", (
        "sensor_metadata.signal_strength"
    )
    low_battery = f"{battery} < {C.LOW_BATTERY_BELOW}"
    poor_signal = f"{signal} < {C.POOR_SIGNAL_BELOW}"
    return {
        "temperature_celsius": "temperature",
        "temperature_fahrenheit": "temperature * 9 / 5 + 32",
        "temperature_kelvin": "temperature + 273.15D",
        **{f"{b.metric}_category": labels.band(b, bands) for b in C.CATEGORY_BANDS},
        "motion_status": "CASE WHEN motion THEN 'active' ELSE 'inactive' END",
        "hour_of_day": f"hour({time})",
        "day_of_week": f"dayofweek({time})",
        "is_weekend": one_of(f"dayofweek({time})", C.WEEKEND),
        "season": labels.season(time),
        **{name: f"sensor_metadata.{name}" for name in C.METADATA},
        "low_battery": low_battery,
        "poor_signal": poor_signal,
        "device_health_status": labels.condition(f"({low_battery})", f"({poor_signal})"),
    }


def enrich(rows: DataFrame, bands: str = "reference") -> DataFrame:
    """Units, categories, calendar and device condition; comfort from the categories."""
    enriched = rows.selectExpr("*", *named(_enrichment(bands)))
    return enriched.selectExpr("*", f"{labels.comfort()} AS comfort_index")


def label(rows: DataFrame, as_of: dt.datetime) -> DataFrame:
    return rows.selectExpr(
        "*",
        *named(
            {
                "silver_processing_time": timestamp(as_of),
                "silver_processing_date": date(as_of),
                "data_lineage": text(C.SILVER_LINEAGE),
                "processing_job": text(C.SILVER_JOB),
                "silver_tier_version": text(C.SILVER_VERSION),
            }
        ),
    )


def from_standard(standardized: DataFrame, as_of: dt.datetime, bands: str = "reference"):
    """Valid rows only, filtered before anything is computed for them.

    Past the filter every flag is true and every score is one, so they are
    written as constants.
    """
    valid = standardized.where(rules.all_rules())
    flagged = valid.selectExpr("*", *named(rules.passed_columns()))
    return label(enrich(flagged, bands), as_of)


def from_bronze(bronze: DataFrame, as_of: dt.datetime, bands: str = "reference") -> DataFrame:
    return from_standard(standardize(bronze), as_of, bands)
