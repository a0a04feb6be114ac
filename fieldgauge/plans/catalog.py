"""Every operator as a registered query: (spark, sf_dir) -> DataFrame.

All of them run over the whole ``events`` table, as the sensor feed derived from
it. Averages are rounded on both sides of the comparison with the oracle,
because engines add doubles in different orders.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge import contract as C
from fieldgauge import session
from fieldgauge.config import Settings, Thresholds
from fieldgauge.functions import clock
from fieldgauge.functions.sql import named, timestamp
from fieldgauge.operators import (
    alerts,
    bronze,
    export,
    gold,
    ingest,
    quality,
    reports,
    silver,
    windows,
)
from fieldgauge.plans import daily_job
from fieldgauge.sources import broker, feed, serving, tables
from fieldgauge.streaming import queries as streams

AS_OF = dt.datetime(2024, 1, 31)
FIRST, LAST = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
SLICE = dt.date(2024, 1, 15)
LOCATION = "field-a"
RECIPIENT = "admin@company.com"

# The narrow limits of the custom-threshold case
NARROW = Thresholds(
    temperature=(20.0, 25.0),
    humidity=(40.0, 60.0),
    pressure=(1000.0, 1020.0),
    light=(100.0, 500.0),
    acidity=(6.0, 8.0),
    battery_low=50,
)

REQUIRED = ["deviceId", "location", "timestamp", "temperature", "motion"]
WRONGLY_REQUIRED = ["deviceId", "deviceType", "location", "value", "timestamp"]

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def _register_as(name: str):
    def register(run: Query) -> Query:
        @wraps(run)
        def in_session(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(session.prepared(spark), sf_dir)

        _REGISTRY[name] = in_session
        return in_session

    return register


def _register(run: Query) -> Query:
    return _register_as(run.__name__)(run)


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# -- shared inputs ---------------------------------------------------------


def _readings(spark, sf) -> DataFrame:
    return feed.readings(feed.events(spark, sf))


def _messages(spark, sf) -> DataFrame:
    return feed.messages(_readings(spark, sf))


def _message_stream(spark, sf) -> DataFrame:
    return feed.messages(feed.readings(feed.event_stream(spark, sf)))


def _raw(spark, sf) -> DataFrame:
    return ingest.raw_rows(ingest.accept(ingest.parse(_messages(spark, sf))))


def _bronze(spark, sf) -> DataFrame:
    """Bronze rows straight from readings, without the JSON round trip."""
    rows = _readings(spark, sf).selectExpr("*", "sha2(string(event_id), 256) AS record_id")
    return bronze.stamp(rows, AS_OF)


def _standard(spark, sf) -> DataFrame:
    return silver.standardize(_bronze(spark, sf))


def _silver(spark, sf) -> DataFrame:
    return silver.from_bronze(_bronze(spark, sf), AS_OF)


def _device_partials(spark, sf) -> DataFrame:
    return gold.partials(_silver(spark, sf), by_hour=False)


def _hourly(spark, sf) -> DataFrame:
    return gold.hourly(gold.partials(_silver(spark, sf)), AS_OF)


def _daily(spark, sf) -> DataFrame:
    return gold.daily(_device_partials(spark, sf), AS_OF)


def _device(spark, sf) -> DataFrame:
    return gold.device(_device_partials(spark, sf), AS_OF)


def _steady(value: str) -> str:
    """Six decimals. The first rounding removes summation noise, so that a value
    halfway between two results goes the same way in every engine."""
    return f"round(round({value}, 9), 6)"


def _rounded(rows: DataFrame, names) -> DataFrame:
    return rows.selectExpr(
        *named({n: _steady(f"`{n}`") if n in names else f"`{n}`" for n in rows.columns})
    )


def _steadied(rows: DataFrame, prefixes=("avg_", "daily_avg_")) -> DataFrame:
    """Round averages, scores and percentages."""

    def unsteady(name):
        return name.startswith(prefixes) or name.endswith(("_score", "_percentage"))

    return _rounded(rows, [name for name in rows.columns if unsteady(name)])


_CLOCK = ("processing_time", "processing_date", "exported_at")


def _daily_mart(spark, sf) -> DataFrame:
    """The mart the dashboard reads, rounded before the panels cut it to tenths."""
    return _steadied(export.daily_report(_daily(spark, sf), AS_OF))


def _stored(spark, rows: DataFrame) -> DataFrame:
    """A small table that is used more than once: written, so it is computed once."""
    path = session.scratch(spark, "table")
    rows.write.parquet(path)
    return spark.read.parquet(path)


# -- ingest ----------------------------------------------------------------


@_register
def ingest_envelope(spark, sf):
    rows = ingest.envelope(_messages(spark, sf))
    return rows.select(
        "kafka_key", "topic", "partition", "offset", "kafka_timestamp",
        F.length("original_json").alias("message_length"),
    )


_READING = [
    "deviceId", "sensor_timestamp", *C.MEASURED, "location",
    "timestamp", *C.METADATA,
]


@_register
def ingest_parse(spark, sf):
    return ingest.parse(_messages(spark, sf)).select("offset", *_READING)


@_register
def ingest_valid(spark, sf):
    rows = ingest.accept(ingest.parse(feed.damaged_messages(_readings(spark, sf))))
    return rows.select("offset", *_READING, *C.RAW_PARTITIONS)


@_register
def epoch_to_timestamp(spark, sf):
    times = {
        "from_millis": clock.event_time("timestamp"),
        "from_seconds": clock.event_time("(timestamp div 1000)", "s"),
        # puts half of the feed before 1970
        "around_epoch": clock.event_time("(timestamp - 1705000000000)"),
    }
    return _readings(spark, sf).selectExpr("event_id", *named(times))


@_register
def calendar_parts(spark, sf):
    rows = _readings(spark, sf)
    return rows.selectExpr("event_id", *named(clock.calendar_parts("sensor_timestamp")))


@_register
def dead_letter(spark, sf):
    rows = ingest.dead_letter(feed.damaged_messages(_readings(spark, sf)))
    return rows.select("topic", "partition", "offset", "reason", "misnamed_device_id")


@_register
def dead_letter_sample(spark, sf):
    rows = ingest.dead_letter(feed.damaged_messages(_readings(spark, sf)))
    return ingest.dead_letter_sample(rows).select("partition", "offset", "reason")


@_register
def required_fields(spark, sf):
    messages = ingest.required_fields(feed.damaged_messages(_readings(spark, sf)), REQUIRED)
    return messages.select("offset", "is_complete", "missing_fields")


# -- raw and bronze --------------------------------------------------------


@_register
def raw_scan(spark, sf):
    path = session.scratch(spark, "raw")
    tables.write_raw(_raw(spark, sf), path)
    rows = bronze.unpack(tables.read_raw(spark, path))
    return rows.drop("record_id")


@_register_as("bronze")
def bronze_rows(spark, sf):
    return bronze.from_raw(_raw(spark, sf), AS_OF).drop("record_id")



@_register
def bronze_record_ids(spark, sf):
    return bronze.from_raw(_raw(spark, sf), AS_OF).select("deviceId", "timestamp", "record_id")


@_register
def bronze_device_type(spark, sf):
    return _bronze(spark, sf).select("event_id", "location", "deviceType")


@_register
def bronze_historical(spark, sf):
    """An earlier Parquet export, loaded with its own schema."""
    path = session.scratch(spark, "earlier")
    rows = _readings(spark, sf)
    fields = [f.name for f in C.READING_SCHEMA if f.name != "metadata"]
    nested = rows.select("event_id", *fields, F.struct(*C.METADATA).alias("metadata"))
    nested.write.parquet(path)
    loaded = tables.read_historical(spark, path, "parquet")
    done = bronze.historical(loaded, AS_OF, "parquet")
    return done.select(
        "event_id", *fields, *(f"metadata.{name}" for name in C.METADATA),
        "bronze_date", "year", "month", "day", "data_source", "ingestion_job",
    )


@_register
def bronze_partition_counts(spark, sf):
    rows = tables.read_days(spark, _bronze_table(spark, sf))
    return rows.groupBy("event_date").agg(F.count("*").alias("n"))


def _bronze_table(spark, sf) -> str:
    """Bronze, written: events come in no known order, so they are gathered by day."""
    path = session.scratch(spark, "bronze")
    rows = tables.packed(_bronze(spark, sf))
    tables.replace_days(spark, rows, path, C.BRONZE_PARTITIONS, FIRST, LAST)
    return path


@_register
def bronze_slice(spark, sf):
    rows = tables.bronze_days(spark, _bronze_table(spark, sf), SLICE, SLICE)
    return rows.select("event_id", "event_date", *_BRONZE_FACTS)


_BRONZE_FACTS = ["deviceId", "deviceType", *C.METRICS, "motion", "location", "timestamp"]


@_register
def bronze_quality(spark, sf):
    return bronze.report(_bronze(spark, sf))


@_register
def bronze_dist_type(spark, sf):
    return bronze.distribution(_bronze(spark, sf), "deviceType")


@_register
def bronze_dist_location(spark, sf):
    return bronze.distribution(_bronze(spark, sf), "location")


# -- silver and quality ----------------------------------------------------


@_register
def silver_standardized(spark, sf):
    rows = _standard(spark, sf)
    return rows.select(
        *(n for n in rows.columns if n not in ("sensor_metadata", "bronze_ingestion_time")),
        "sensor_metadata.*",
    )


def _flags(spark, sf) -> DataFrame:
    kept = silver.standardize(_bronze(spark, sf))
    return quality.flag_rules(kept)


@_register
def silver_rule_flags(spark, sf):
    flags = [f"{name}_valid" for name in C.RULES]
    return _flags(spark, sf).select("record_id", *flags, "is_valid_record")


@_register
def quality_score(spark, sf):
    return _flags(spark, sf).select("record_id", "data_quality_score")


@_register
def quality_flag(spark, sf):
    rows = quality.flag_first_failure(_readings(spark, sf))
    return rows.select("event_id", "data_quality_flag")


@_register
def quality_report(spark, sf):
    return _steadied(quality.report(_standard(spark, sf)))


@_register
def quality_by_device(spark, sf):
    return _steadied(quality.by_device(_standard(spark, sf)))


_UNITS = [f"temperature_{unit}" for unit in ("celsius", "fahrenheit", "kelvin")]


@_register_as("silver")
def silver_rows(spark, sf):
    rows = _silver(spark, sf)
    clocks = ("sensor_metadata", "bronze_ingestion_time", "silver_processing_time")
    rows = rows.select(*(n for n in rows.columns if n not in clocks))
    return _rounded(rows, _UNITS)


@_register
def silver_units(spark, sf):
    return _rounded(_silver(spark, sf).select("record_id", *_UNITS), _UNITS)


@_register
def silver_categories(spark, sf):
    names = [f"{b.metric}_category" for b in C.CATEGORY_BANDS]
    return _silver(spark, sf).select("record_id", *names, "motion_status")


@_register
def silver_categories_contiguous(spark, sf):
    rows = silver.from_bronze(_bronze(spark, sf), AS_OF, bands="contiguous")
    names = [f"{b.metric}_category" for b in C.CATEGORY_BANDS]
    return rows.select("record_id", *names)


@_register
def silver_comfort(spark, sf):
    return _silver(spark, sf).select("record_id", "comfort_index")


@_register
def silver_calendar(spark, sf):
    return _silver(spark, sf).select(
        "record_id", "hour_of_day", "day_of_week", "is_weekend", "season"
    )


@_register
def silver_health(spark, sf):
    return _silver(spark, sf).select(
        "record_id", "low_battery", "poor_signal", "device_health_status"
    )


def _silver_table(spark, sf) -> str:
    path = session.scratch(spark, "silver")
    rows = tables.packed(_silver(spark, sf), *C.SILVER_PARTITIONS)
    tables.replace_days(spark, rows, path, C.SILVER_PARTITIONS, FIRST, LAST)
    return path


@_register
def silver_partition_counts(spark, sf):
    rows = tables.read_days(spark, _silver_table(spark, sf))
    return rows.groupBy("event_date", "deviceType").agg(F.count("*").alias("n"))


@_register
def silver_slice(spark, sf):
    rows = tables.silver_days(spark, _silver_table(spark, sf), SLICE, SLICE)
    return rows.select("record_id", "event_date", "deviceType", "deviceId", "comfort_index")


@_register
def silver_summary(spark, sf):
    return quality.silver_summary(_silver(spark, sf))


@_register
def silver_dist_health(spark, sf):
    return bronze.distribution(_silver(spark, sf), "device_health_status")


@_register
def silver_dist_temp(spark, sf):
    return bronze.distribution(_silver(spark, sf), "temperature_category")


@_register
def silver_dist_comfort(spark, sf):
    return bronze.distribution(_silver(spark, sf), "comfort_index")


# -- gold ------------------------------------------------------------------


@_register
def gold_hourly(spark, sf):
    return _steadied(_hourly(spark, sf).drop(*_CLOCK))


@_register
def gold_daily(spark, sf):
    return _steadied(_daily(spark, sf).drop(*_CLOCK))


@_register
def gold_device(spark, sf):
    return _steadied(_device(spark, sf).drop(*_CLOCK))


def _within(estimate: str, exact: str, error: float) -> str:
    """Whether an estimate is within three standard errors, rounded to whole devices."""
    return f"abs({estimate} - {exact}) <= ceil(3 * {error:.6f}D * {exact})"


@_register
def gold_hourly_approx(spark, sf):
    """The hourly table by estimated device counts, and whether those are within their bound."""
    keys = ["event_date", "hour_of_day", "location", "deviceType"]
    guessed = gold.hourly_approx(_silver(spark, sf), AS_OF).withColumnRenamed("unique_devices", "estimate")
    exact = _hourly(spark, sf).select(*keys, "unique_devices")
    judged = guessed.join(exact, keys).withColumn(
        "devices_within_bound", F.expr(_within("estimate", "unique_devices", 0.05))
    )
    return _steadied(judged.drop("estimate", "unique_devices", *_CLOCK))


@_register
def gold_devices_sketch(spark, sf):
    """Devices of all days by stored hourly sketches, against the exact count."""
    by_hour = gold.partials(_silver(spark, sf))
    keys = ["location", "deviceType"]
    path = session.scratch(spark, "sketches")
    tables.replace_days(spark, tables.packed(gold.sketches(by_hour)), path, C.GOLD_PARTITIONS, FIRST, LAST)
    united = gold.devices(tables.read_days(spark, path), *keys).withColumnRenamed("devices", "estimate")
    exact = by_hour.groupBy(*keys).agg(F.count_distinct("deviceId").alias("devices"))
    within = F.expr(_within("estimate", "devices", gold.SKETCH_ERROR)).alias("within_bound")
    return united.join(exact, keys).select(*keys, "devices", within)


@_register
def window_agg_batch(spark, sf):
    return _steadied(windows.by_window(_readings(spark, sf)))


# -- alerts ----------------------------------------------------------------

_ALERT_KEY = ["event_id", "deviceId", "location", "sensor_timestamp"]


@_register
def alert_anomalies(spark, sf):
    found = alerts.anomalies(alerts.alerting(_readings(spark, sf)), _ALERT_KEY)
    return found


@_register
def alert_readings(spark, sf):
    found = alerts.alerting(_readings(spark, sf))
    return found.select(*_ALERT_KEY, F.size("anomalies").alias("n_anomalies"))


@_register
def alert_types(spark, sf):
    found = alerts.types(alerts.alerting(_readings(spark, sf)), timestamp(AS_OF))
    return found.select(*_ALERT_KEY, "anomaly_types", "alert_timestamp")


@_register
def alert_types_without_battery(spark, sf):
    found = alerts.types(alerts.alerting(_readings(spark, sf), battery=False))
    return found.select(*_ALERT_KEY, "anomaly_types")


@_register
def alert_messages(spark, sf):
    found = alerts.alerting(_readings(spark, sf))
    return alerts.messages(found, RECIPIENT, C.SUBJECT_PREFIX, ["event_id"])


@_register
def alert_custom_thresholds(spark, sf):
    return alerts.anomalies(alerts.alerting(_readings(spark, sf), NARROW), ["event_id"])


@_register
def alert_simple_range(spark, sf):
    found = alerts.simple_range(_readings(spark, sf))
    return found.select("event_id", "deviceId", *C.SIMPLE_RANGES)


@_register
def alert_batch_stats(spark, sf):
    batched = _readings(spark, sf).withColumn("batch_id", F.expr("event_id div 1000"))
    return alerts.batch_stats(batched, "batch_id")


# -- serving ---------------------------------------------------------------


@_register
def export_timeseries(spark, sf):
    mart = export.ordered(export.TIMESERIES, export.timeseries(_hourly(spark, sf), AS_OF))
    averages = ("temperature", "humidity", "pressure", "data_quality")
    return _rounded(mart.drop(*_CLOCK), averages)


@_register
def export_daily(spark, sf):
    mart = export.ordered(export.DAILY, _daily_mart(spark, sf))
    return _steadied(mart.drop(*_CLOCK))


@_register
def export_device_status(spark, sf):
    mart = export.ordered(export.DEVICES, export.device_status(_device(spark, sf), AS_OF))
    return _steadied(mart.drop(*_CLOCK))


@_register
def export_summary(spark, sf):
    by_hour = _stored(spark, gold.partials(_silver(spark, sf)))
    by_device = gold.merge_hours(by_hour)
    tier = {
        "hourly": gold.hourly(by_hour, AS_OF),
        "daily": gold.daily(by_device, AS_OF),
        "device": gold.device(by_device, AS_OF),
    }
    target = serving.ParquetTarget(session.scratch(spark, "marts"))
    outcome = daily_job.export_step(spark, export.marts(tier, AS_OF), target)
    return daily_job.export_summary(outcome, AS_OF)


# -- feeds that reach the branches that the usual one does not --------------------


def _health_feed(spark, sf) -> DataFrame:
    """One day of devices that differ in the hours they send and in their battery."""
    hours = "event_id % (6 + 6 * (user_id % 4))"
    day = 1705276800  # 2024-01-15, a fixed value
    rows = feed.events(spark, sf).selectExpr("event_id", "user_id")
    time = rows.selectExpr(
        "event_id", f"timestamp_seconds({day} + 3600 * ({hours})) AS sensor_timestamp",
        f"1000 * ({day} + 3600 * ({hours})) AS timestamp",
        "int(case user_id % 5 when 4 then null else 25 + 20 * (user_id % 5) end) AS battery_level",
    )
    return _readings(spark, sf).drop("sensor_timestamp", "timestamp", "battery_level").join(time, "event_id")


def _year_feed(spark, sf) -> DataFrame:
    """The same readings over a year."""
    later = "event_id % 366"
    return _readings(spark, sf).withColumns(
        {
            "timestamp": F.expr(f"timestamp + ({later}) * 86400000"),
            "sensor_timestamp": F.expr(f"sensor_timestamp + make_dt_interval(int({later}))"),
        }
    )


_BROKEN = {
    "deviceId": "if(event_id % 11 = 0, '', deviceId)",
    "location": "if(event_id % 13 = 0, '', location)",
    "timestamp": "if(event_id % 17 = 0, null, timestamp)",
    "sensor_timestamp": "if(event_id % 17 = 0, null, sensor_timestamp)",
    "humidity": "if(event_id % 19 = 0, 100.5D, humidity)",
    "pressure": "if(event_id % 23 = 0, if(event_id % 2 = 0, -1.0D, 499.0D), pressure)",
    "light": "if(event_id % 29 = 0, -0.5D, light)",
}


def _broken_feed(spark, sf) -> DataFrame:
    """Readings that break every rule but the one on the device type, which has a default."""
    return _readings(spark, sf).withColumns({name: F.expr(rule) for name, rule in _BROKEN.items()})


def _bronze_of(rows: DataFrame) -> DataFrame:
    return bronze.stamp(rows.selectExpr("*", "sha2(string(event_id), 256) AS record_id"), AS_OF)


@_register
def silver_calendar_year(spark, sf):
    rows = silver.from_bronze(_bronze_of(_year_feed(spark, sf)), AS_OF)
    return rows.select("record_id", "hour_of_day", "day_of_week", "is_weekend", "season")


@_register
def gold_device_health(spark, sf):
    rows = silver.from_bronze(_bronze_of(_health_feed(spark, sf)), AS_OF)
    table = gold.device(gold.partials(rows, by_hour=False), AS_OF)
    return table.select("deviceId", "active_hours", "total_readings", "device_health")


@_register
def silver_rule_flags_broken(spark, sf):
    flagged = quality.flag_rules(silver.standardize(_bronze_of(_broken_feed(spark, sf))))
    flags = [f"{name}_valid" for name in C.RULES]
    return flagged.select("record_id", *flags, "is_valid_record", "data_quality_score")


@_register
def quality_flag_broken(spark, sf):
    return quality.flag_first_failure(_broken_feed(spark, sf)).select("event_id", "data_quality_flag")


# -- the stored job: raw to marts through tables, and read back -----------------


def _lake(spark) -> daily_job.Lake:
    return daily_job.Lake(session.scratch(spark, "lake"))


def _run_job(spark, lake) -> None:
    daily_job.run(spark, lake, FIRST, LAST, AS_OF)


def _stored_daily(spark, lake) -> DataFrame:
    return _steadied(tables.read_days(spark, lake.gold("daily")).drop(*_CLOCK))


@_register
def job_gold_daily(spark, sf):
    """The daily table after a run of all steps, each of which reads what the last one stored."""
    lake = _lake(spark)
    tables.write_raw(_raw(spark, sf), lake.raw)
    _run_job(spark, lake)
    return _stored_daily(spark, lake)


@_register
def job_after_correction(spark, sf):
    """Devices sent under a wrong site, then corrected in raw: the second run leaves no trace."""
    lake = _lake(spark)
    wrong = F.regexp_replace("value", "field-[ab]", "moved-x")
    tables.write_raw(_raw(spark, sf).withColumn("value", wrong), lake.raw)
    _run_job(spark, lake)
    tables.write_raw(_raw(spark, sf), lake.raw)
    _run_job(spark, lake)
    return _stored_daily(spark, lake)


def _export_files(spark, rows: DataFrame) -> str:
    """Readings as an earlier Parquet export: metadata nested, no date parts."""
    path = session.scratch(spark, "export")
    fields = [f.name for f in C.READING_SCHEMA if f.name != "metadata"]
    rows.select("event_id", *fields, F.struct(*C.METADATA).alias("metadata")).write.parquet(path)
    return path


@_register
def job_with_history(spark, sf):
    """A third of all readings from an export that is loaded twice, the rest by the daily load."""
    lake, rows = _lake(spark), _readings(spark, sf)
    export_path = _export_files(spark, rows.where("event_id % 3 = 0"))
    for _ in range(2):
        daily_job.load_historical(spark, lake, export_path, AS_OF, "parquet")
    sent = feed.messages(rows.where("event_id % 3 <> 0"))
    tables.write_raw(ingest.raw_rows(ingest.accept(ingest.parse(sent))), lake.raw)
    _run_job(spark, lake)
    return _stored_daily(spark, lake)


@_register
def bronze_history_quarantine(spark, sf):
    """Rows of an export without a time: kept apart, with the reason, whole."""
    lake = _lake(spark)
    timeless = F.when(F.col("event_id") % 89 != 0, F.col("timestamp"))
    rows = _readings(spark, sf).withColumn("timestamp", timeless)
    daily_job.load_historical(spark, lake, _export_files(spark, rows), AS_OF, "parquet")
    return daily_job.quarantine(spark, lake).select(
        "deviceId", "deviceType", "location", *C.METRICS, *C.METADATA, "event_date", "reason"
    )


# -- dashboard -------------------------------------------------------------


@_register
def dash_locations_in(spark, sf):
    mart = _stored(spark, _daily_mart(spark, sf))
    return reports.locations_in(mart, [LOCATION, "lab-a"], AS_OF)


@_register
def dash_temperature(spark, sf):
    mart = _stored(spark, _daily_mart(spark, sf))
    shown = reports.temperature(mart, LOCATION, AS_OF)
    return _rounded(shown, ["Temperature Range"])


@_register
def dash_irrigation(spark, sf):
    return reports.irrigation(_daily_mart(spark, sf), LOCATION, AS_OF)


@_register
def dash_irrigation_status(spark, sf):
    score = reports.irrigation(_daily_mart(spark, sf), LOCATION, AS_OF)
    return reports.with_status("irrigation", score, "irrigation_efficiency")


@_register
def dash_growing_degree_days(spark, sf):
    return reports.growing_degree_days(_daily_mart(spark, sf), LOCATION, AS_OF)


@_register
def dash_conditions(spark, sf):
    return reports.conditions(_stored(spark, _daily_mart(spark, sf)), LOCATION, AS_OF)


@_register
def dash_field_health(spark, sf):
    return reports.field_health(_daily_mart(spark, sf), LOCATION, AS_OF)


@_register
def dash_location_list(spark, sf):
    return reports.location_list(_daily_mart(spark, sf))


@_register
def dash_status_bands(spark, sf):
    mart = _daily_mart(spark, sf)
    colored = reports.with_status("temperature", mart, "avg_temperature")
    colored = colored.withColumnRenamed("status", "temperature_status")
    colored = reports.with_status("humidity", colored, "avg_humidity")
    return colored.select(
        "report_date", "location", "device_type", "temperature_status",
        F.col("status").alias("humidity_status"),
    )


# -- streams, run to the end of the table and read back ----------------------


@_register
def stream_raw_roundtrip(spark, sf):
    path, at = session.scratch(spark, "raw"), session.scratch(spark, "checkpoint")
    streams.drain(streams.raw_sink(_message_stream(spark, sf), path, at, streams.DRAIN))
    return bronze.unpack(tables.read_raw(spark, path)).drop("record_id")


@_register
def stream_window_agg(spark, sf):
    path, at = session.scratch(spark, "windows"), session.scratch(spark, "checkpoint")
    streams.drain(streams.window_sink(_message_stream(spark, sf), path, at, streams.DRAIN))
    return _steadied(spark.read.parquet(path).drop("window_date"))


@_register
def stream_flow_metrics(spark, sf):
    messages = feed.damaged_messages(feed.readings(feed.event_stream(spark, sf)))
    at, path = session.scratch(spark, "checkpoint"), session.scratch(spark, "flow")
    streams.drain(streams.flow_probe(messages, at, path, streams.DRAIN))
    counts = streams.flow_counts(spark, path)
    return counts.agg(F.sum("received").alias("received"), F.sum("accepted").alias("accepted"))


@_register
def stream_alerts(spark, sf):
    path, at = session.scratch(spark, "alerts"), session.scratch(spark, "checkpoint")
    settings = Settings(recipient=RECIPIENT)
    query = streams.alert_sink(_message_stream(spark, sf), path, at, settings, streams.DRAIN)
    streams.drain(query)
    return streams.alert_table(spark, path).select(
        "deviceId", "location", "sensor_timestamp", "anomaly_types", "recipient", "subject",
        "body", "status", "attempts",
    )


def _in_turns(spark, sf, turns: int = 4) -> str:
    """The feed's messages as files that arrive one after another, in no order of time."""
    path = session.scratch(spark, "arrived")
    messages = _messages(spark, sf)
    for k in range(turns):
        messages.where(F.pmod(F.xxhash64("offset"), F.lit(turns)) == k).coalesce(1).write.mode("append").parquet(path)
    return path


@_register
def stream_window_latest(spark, sf):
    """Windows corrected by readings of later batches, all within the watermark's delay.

    The delay is the feed's whole span, so that no reading is too late."""
    path, at = session.scratch(spark, "windows"), session.scratch(spark, "checkpoint")
    source = broker.file_stream(spark, _in_turns(spark, sf), files_per_trigger=1)
    streams.drain(streams.window_update_sink(source, path, at, streams.DRAIN, watermark="400 days"))
    return _steadied(streams.latest_windows(spark, path))


@_register
def stream_late_rows(spark, sf):
    """Windows that lack readings which came too late.

    Every eleventh reading arrives after all others; those more than five days old by then
    are behind the watermark."""
    path, at = session.scratch(spark, "windows"), session.scratch(spark, "checkpoint")
    arrived, messages = session.scratch(spark, "arrived"), _messages(spark, sf)
    for behind in ("`offset` % 11 != 0", "`offset` % 11 = 0"):
        messages.where(behind).write.mode("append").parquet(arrived)
        source = broker.file_stream(spark, arrived)
        streams.drain(streams.window_update_sink(source, path, at, streams.DRAIN, watermark="5 days"))
    # messages as they arrived, not made anew; those without an offset never did
    sent = spark.read.schema(C.ENVELOPE_SCHEMA).parquet(arrived).unionByName(messages.where("`offset` IS NULL"))
    return streams.late_counts(streams.accepted(sent), streams.latest_windows(spark, path))


@_register
def stream_window_state(spark, sf):
    """Windows that the state still holds after a restart: those that the watermark leaves open."""
    path, at = session.scratch(spark, "windows"), session.scratch(spark, "checkpoint")
    for _ in range(2):  # the second run starts from the checkpoint and finds nothing new
        streams.drain(streams.window_sink(_message_stream(spark, sf), path, at, streams.DRAIN))
    return streams.open_windows(spark, at)


def _twice_delivered(spark, sf) -> DataFrame:
    """Damaged messages as a stream, every seventh of them delivered twice."""
    messages = feed.damaged_messages(feed.readings(feed.event_stream(spark, sf)))
    times = F.explode(F.expr("if(`offset` % 7 = 0, array(0, 1), array(0))"))
    return messages.withColumn("delivery", times).drop("delivery")


@_register
def stream_dead_letter(spark, sf):
    """What the reject stream stores of them: each rejected message once."""
    path, at = session.scratch(spark, "rejects"), session.scratch(spark, "checkpoint")
    streams.drain(streams.reject_sink(_twice_delivered(spark, sf), path, at, streams.DRAIN))
    return tables.read_days(spark, f"{path}/dead_letters").select(
        "topic", "partition", "offset", "reason", "misnamed_device_id"
    )


@_register
def stream_message_counts(spark, sf):
    """Received, accepted, rejected and repeated messages: nothing is lost or counted twice."""
    path, at = session.scratch(spark, "rejects"), session.scratch(spark, "checkpoint")
    ledger = streams.ProgressLedger(spark, f"{path}/progress")
    spark.streams.addListener(ledger)
    try:
        query = streams.drain(streams.reject_sink(_twice_delivered(spark, sf), path, at, streams.DRAIN))
        ledger.wait(query)
    finally:
        spark.streams.removeListener(ledger)
    return streams.message_counts(spark, path, f"{path}/progress")


def _refuse_one_site(recipient: str, subject: str, body: str) -> None:
    if subject.endswith(LOCATION):
        raise ConnectionError("no route")


@_register
def alert_outbox_due(spark, sf):
    """The outbox after two rounds with a sender that fails for one site: what is due, and why."""
    path = session.scratch(spark, "alerting")
    rows = _readings(spark, sf).selectExpr("*", "sha2(string(event_id), 256) AS record_id")
    for run in ("first", "anew"):  # a stream that begins again reads the same messages
        streams.write_alert_batch(rows, 0, path, Settings(recipient=RECIPIENT), run)
    for minutes in (0, 1, 2):  # the last is too early for a third try
        when = AS_OF + dt.timedelta(minutes=minutes)
        streams.deliver_due(spark, path, _refuse_one_site, when)
    later = AS_OF + dt.timedelta(minutes=3)
    return alerts.due_rows(streams.outbox_state(spark, path), later).select(
        "record_id", "deviceId", "sensor_timestamp", "subject", "status", "attempts", "last_error"
    )


@_register
def raw_compacted(spark, sf):
    """Raw days that many batches have left in many files, compacted and read back."""
    path, rows = session.scratch(spark, "raw"), _raw(spark, sf)
    batch = F.pmod(F.xxhash64("value"), F.lit(4))
    for k in (0, 1, 2, 3, 0):  # the first batch is run again
        tables.append_raw(rows.where(batch == k), path, f"stream/{k}")
    tables.compact_raw(spark, path, FIRST, LAST)
    return bronze.unpack(tables.read_raw(spark, path)).drop("record_id")
