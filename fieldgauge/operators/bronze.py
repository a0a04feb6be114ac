"""Raw lake rows to the bronze tier, and reports over it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge import contract as C
from fieldgauge.functions import clock, labels
from fieldgauge.functions.sql import date, named, text, timestamp
from fieldgauge.operators import ingest


def unpack(raw: DataFrame) -> DataFrame:
    """Raw lake rows to flat readings; rows that name no device are dropped."""
    parts = [f"raw_{name}" for name in C.RAW_PARTITIONS]
    rows = raw.selectExpr("value", *named(dict(zip(parts, C.RAW_PARTITIONS))))
    return (
        ingest.unpack_json(rows, "value", ["value", *parts])
        .where("deviceId IS NOT NULL")
        .selectExpr(
            "deviceId",
            *C.MEASURED,
            "location",
            "timestamp",
            *(f"metadata.{name}" for name in C.METADATA),
            *parts,
            f"{ingest.record_id(json='value')} AS record_id",
        )
    )


def _loaded(as_of: dt.datetime, source: str, job: str) -> dict[str, str]:
    return {
        "bronze_ingestion_time": timestamp(as_of),
        "bronze_date": date(as_of),
        "data_source": text(source),
        "ingestion_job": text(job),
    }


def _placed(time: str) -> dict[str, str]:
    return {
        "event_date": f"to_date({time})",
        "processing_status": text(C.INGESTED),
        "deviceType": labels.device_type("location"),
    }


def stamp(
    readings: DataFrame,
    as_of: dt.datetime,
    source: str = C.RAW_SOURCE,
    job: str = C.RAW_JOB,
) -> DataFrame:
    """Add event date, device type and lineage. ``as_of`` is the time of the load."""
    time = clock.event_time("timestamp")
    added = {**_loaded(as_of, source, job), **clock.date_parts(time), **_placed(time)}
    return readings.selectExpr("*", *named(added))


def from_raw(raw: DataFrame, as_of: dt.datetime) -> DataFrame:
    return stamp(unpack(raw), as_of).select(*C.BRONZE_COLUMNS)


def historical(loaded: DataFrame, as_of: dt.datetime, file_format: str = "json") -> DataFrame:
    """Rows of an earlier export with date parts and lineage, all columns kept."""
    time = clock.event_time("bigint(timestamp)")
    source = C.HISTORICAL_SOURCE.format(format=file_format)
    added = {**_loaded(as_of, source, C.HISTORICAL_JOB), **clock.date_parts(time)}
    return loaded.selectExpr("*", *named(added))


def conform(rows: DataFrame) -> DataFrame:
    """Historical rows in the bronze column contract, so that silver can read them.

    Metadata may be nested or flat. Absent columns become null.
    """
    present = dict.fromkeys(rows.columns)
    have = {name: f"`{name}`" for name in present}
    if "metadata" in present:
        nested = rows.schema["metadata"].dataType.fieldNames()
        have |= {name: f"metadata.`{name}`" for name in C.METADATA if name in nested}
    if "record_id" not in present:
        fields = [n for n in (*C.READING_SCHEMA.fieldNames(), *C.METADATA) if n in present]
        have["record_id"] = f"sha2(to_json(struct({', '.join(fields)})), 256)"
    have |= _placed(clock.event_time("bigint(timestamp)"))
    types = {f.name: f.dataType.simpleString() for f in C.READING_SCHEMA if f.name != "metadata"}
    types |= {f.name: f.dataType.simpleString() for f in C.READING_SCHEMA["metadata"].dataType}
    types |= {f"raw_{name}": "int" for name in C.RAW_PARTITIONS}
    return rows.selectExpr(
        *named(
            {
                name: f"CAST({have.get(name, 'NULL')} AS {types[name]})"
                if name in types
                else have[name]
                for name in C.BRONZE_COLUMNS
            }
        )
    )


def report(bronze: DataFrame) -> DataFrame:
    """Rows, distinct devices, types and locations, first and last load time.

    Counted over (device, type, location) groups: the raw rows are reduced once
    map-side, and the three distinct counts expand only that small table.
    """
    groups = bronze.groupBy("deviceId", "deviceType", "location").agg(
        F.count("*").alias("n"),
        F.min("bronze_ingestion_time").alias("first"),
        F.max("bronze_ingestion_time").alias("last"),
    )
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.count_distinct("deviceId").alias("unique_devices"),
        F.count_distinct("deviceType").alias("device_types"),
        F.count_distinct("location").alias("locations"),
        F.min("first").alias("earliest_ingestion"),
        F.max("last").alias("latest_ingestion"),
    )


def distribution(rows: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        rows.groupBy(column)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.asc(column))
    )
