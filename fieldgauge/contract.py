"""Schemas and fixed values shared by every tier.

Everything in this module is data: column names, bounds, labels and wording
that producers, dashboards and mail recipients already depend on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------

METRICS = ("temperature", "humidity", "pressure", "light", "acidity")
# What a reading measures, in the order of its columns. Fixed values.
MEASURED = ("temperature", "humidity", "pressure", "motion", "light", "acidity")
METADATA = ("battery_level", "signal_strength", "firmware_version")

READING_SCHEMA = T.StructType(
    [
        T.StructField("deviceId", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("pressure", T.DoubleType()),
        T.StructField("motion", T.BooleanType()),
        T.StructField("light", T.DoubleType()),
        T.StructField("acidity", T.DoubleType()),
        T.StructField("location", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("battery_level", T.IntegerType()),
                    T.StructField("signal_strength", T.IntegerType()),
                    T.StructField("firmware_version", T.StringType()),
                ]
            ),
        ),
    ]
)

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

RAW_PARTITIONS = ("year", "month", "day", "hour")
RAW_SCHEMA = T.StructType(
    [T.StructField("value", T.StringType())]
    + [T.StructField(name, T.IntegerType()) for name in RAW_PARTITIONS]
)

BRONZE_COLUMNS = (
    "deviceId",
    *MEASURED,
    "location",
    "timestamp",
    *METADATA,
    "raw_year",
    "raw_month",
    "raw_day",
    "raw_hour",
    "bronze_ingestion_time",
    "bronze_date",
    "year",
    "month",
    "day",
    "data_source",
    "ingestion_job",
    "record_id",
    "processing_status",
    "deviceType",
    "event_date",
)

# Table partitioning. Every tier is cut by the date of the reading.
BRONZE_PARTITIONS = ("event_date",)
SILVER_PARTITIONS = ("event_date", "deviceType")
GOLD_PARTITIONS = ("event_date",)

# --------------------------------------------------------------------------
# Lineage labels
# --------------------------------------------------------------------------

RAW_SOURCE = "raw-s3-json"
RAW_JOB = "bronze-batch-job-v2"
HISTORICAL_SOURCE = "batch-{format}"
HISTORICAL_JOB = "bronze-batch-job-v1"
INGESTED = "ingested"
NO_TIME = "missing_timestamp"
SILVER_LINEAGE = "bronze_to_silver_v2"
SILVER_JOB = "silver-batch-job"
SILVER_VERSION = "2.0"

# Device type by location prefix, first match wins
DEVICE_TYPES = (("warehouse", "temperature-sensor"), ("field", "environmental-sensor"))
DEFAULT_DEVICE_TYPE = "iot-sensor"

# --------------------------------------------------------------------------
# Validity rules (inclusive bounds) and the first-failure flag
# --------------------------------------------------------------------------

NON_EMPTY = ("deviceId", "deviceType", "location")
PRESENT = {"timestamp": "sensor_timestamp", "motion": "motion"}
VALID_RANGES = {
    "temperature": (-50, 100),
    "humidity": (0, 100),
    "pressure": (500, 1500),
    "light": (0, 100000),
    "acidity": (0, 14),
}
RULES = (
    "deviceId",
    "deviceType",
    "timestamp",
    "temperature",
    "humidity",
    "pressure",
    "location",
    "motion",
    "light",
    "acidity",
)

# (label, column, low, high); None leaves that side open
FLAG_RULES = (
    ("INVALID_TEMP", "temperature", -50, 100),
    ("INVALID_HUMIDITY", "humidity", 0, 100),
    ("INVALID_PRESSURE", "pressure", 0, None),
)
FLAG_OK = "VALID"

# Report grades by valid percentage, lower edge inclusive
GRADES = ((95, "EXCELLENT"), (90, "GOOD"), (80, "ACCEPTABLE"))
LOWEST_GRADE = "POOR"


# --------------------------------------------------------------------------
# Category bands
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Bands:
    """Labels along one metric: an open low end, closed steps, and the rest."""

    metric: str
    floor: tuple[str, float]  # label for values strictly below the edge
    steps: tuple[tuple[str, float, float], ...]  # label, low, high, both inclusive
    rest: str


TEMPERATURE_BANDS = Bands(
    "temperature",
    ("freezing", 0),
    (("cold", 0, 15), ("comfortable", 16, 25), ("warm", 26, 35)),
    "hot",
)
HUMIDITY_BANDS = Bands(
    "humidity",
    ("dry", 30),
    (("comfortable", 30, 60), ("humid", 61, 80)),
    "very_humid",
)
PRESSURE_BANDS = Bands("pressure", ("low", 1000), (("normal", 1000, 1025),), "high")
LIGHT_BANDS = Bands(
    "light",
    ("dark", 1),
    (("dim", 1, 50), ("indoor", 51, 500), ("bright", 501, 10000)),
    "very_bright",
)
ACIDITY_BANDS = Bands(
    "acidity",
    ("very_acidic", 3),
    (("acidic", 3, 6), ("neutral", 6, 8), ("basic", 8, 11)),
    "very_basic",
)
CATEGORY_BANDS = (
    TEMPERATURE_BANDS,
    HUMIDITY_BANDS,
    PRESSURE_BANDS,
    LIGHT_BANDS,
    ACIDITY_BANDS,
)

# Comfort index, first match wins; None means any value
COMFORT_LEVELS = (
    (
        "optimal",
        {
            "temperature_category": ("comfortable",),
            "humidity_category": ("comfortable",),
            "light_category": ("indoor", "bright"),
        },
    ),
    (
        "good",
        {
            "temperature_category": ("comfortable", "warm"),
            "humidity_category": ("comfortable", "humid"),
        },
    ),
)
LOWEST_COMFORT = "poor"

# Seasons by month, weekend days (1 = Sunday)
SEASONS = (("winter", (12, 1, 2)), ("spring", (3, 4, 5)), ("summer", (6, 7, 8)))
LAST_SEASON = "autumn"
WEEKEND = (1, 7)

# Device condition limits
LOW_BATTERY_BELOW = 20
POOR_SIGNAL_BELOW = -80

# Device health, (label, min score, min hours, min battery)
HEALTH_LEVELS = (
    ("excellent", 0.9, 20, 80),
    ("good", 0.8, 16, 60),
    ("acceptable", 0.7, 12, 40),
)
LOWEST_HEALTH = "needs_attention"

# --------------------------------------------------------------------------
# streaming
# --------------------------------------------------------------------------

WATERMARK = "10 minutes"
WINDOW = "5 minutes"

# --------------------------------------------------------------------------
# Alert wording
# --------------------------------------------------------------------------

# (label, column, unit after the value and the last bound, unit after the first bound)
RANGE_ALERTS = (
    ("Temperature", "temperature", "°C", "°C"),
    ("Humidity", "humidity", "%", "%"),
    ("Pressure", "pressure", " hPa", ""),
    ("Light", "light", " lux", ""),
    ("Acidity", "acidity", " pH", ""),
)
BATTERY_ALERT = "Low Battery"
SUBJECT_PREFIX = "[IoT Alert]"
MESSAGE_HEAD = "Device: {device}\nLocation: {location}\nTimestamp: {time}\n\nAnomalies detected:\n"
MESSAGE_TAIL = "\n\nPlease investigate this issue immediately.\n\n---\nIoT Monitoring System"

# The simple range alert on three metrics
SIMPLE_RANGES = {
    "temperature": (10.0, 35.0),
    "humidity": (20.0, 80.0),
    "pressure": (1000.0, 1040.0),
}

# --------------------------------------------------------------------------
# Dashboard panels
# --------------------------------------------------------------------------

# average humidity inside [low, high] scores this much, first match wins
IRRIGATION_SCORES = ((40, 70, 100), (30, 80, 75), (20, 90, 50))
LOWEST_IRRIGATION = 25
GROWING_BASE_C = 10

# panel colour steps, lower edge inclusive
PANEL_STEPS = {
    "temperature": ("dark-blue", ((15, "dark-green"), (20, "red"))),
    "irrigation": ("red", ((30, "semi-dark-green"), (85, "dark-green"))),
    "humidity": ("green", ((70, "orange"), (85, "red"))),
}
