"""Five-minute device windows, for a batch or a watermarked stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge import contract as C
from fieldgauge.functions.sql import measures


def by_window(readings: DataFrame, width: str = C.WINDOW) -> DataFrame:
    """Tumbling windows per device. Location depends on the device, so any will do."""
    found = {
        "avg_temperature": "avg(temperature)",
        "min_temperature": "min(temperature)",
        "max_temperature": "max(temperature)",
        "avg_humidity": "avg(humidity)",
        "avg_pressure": "avg(pressure)",
        "record_count": "count(1)",
        "location": "min(location)",
    }
    windows = readings.groupBy(F.window("sensor_timestamp", width), "deviceId")
    return windows.agg(*measures(found)).selectExpr(
        "window.start AS window_start", "window.end AS window_end", "deviceId", *found
    )
