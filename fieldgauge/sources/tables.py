"""Lake tables: partitioned Parquet in versions, and the raw JSON tier."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge import contract as C
from fieldgauge.functions.sql import date, named, text
from fieldgauge.session import delete
from fieldgauge.sources import versions
from fieldgauge.sources.versions import days as days


def between_days(day: str, first, last) -> str:
    """Bounds on a date partition column; they become partition filters."""
    return f"{day} BETWEEN {date(first)} AND {date(last)}"


def write(rows: DataFrame, path: str, partitions: tuple[str, ...], mode: str = "overwrite"):
    """Write Parquet. ``overwrite`` replaces only the partitions that ``rows`` has.

    For tables of batches, which a repeated batch replaces; tables of days are versioned.
    """
    writer = rows.write.mode(mode).partitionBy(*partitions)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def packed(rows: DataFrame, *partitions: str) -> DataFrame:
    """Rows gathered by partition (the day, if none is named) for writing.

    For rows that are not already cut that way: an aggregate, or an unsorted
    load, where every task would write a small file into every partition.
    Adaptive execution splits a partition that is too large for one task, so a
    hot day or hour does not become a long task, and joins small ones.
    """
    return rows.hint("rebalance", *(partitions or ("event_date",)))


replace_days, read_days = versions.replace_days, versions.read


def bronze_days(spark: SparkSession, path: str, first, last, *more: str) -> DataFrame | None:
    """Ingested bronze rows of some days, from one or more tables; None if there are none."""
    rows = None
    for table in (path, *more):
        found = read_days(spark, table, first, last)
        if found is not None:
            rows = found if rows is None else rows.unionByName(found)
    return None if rows is None else rows.where(f"processing_status = {text(C.INGESTED)}")


def silver_days(spark: SparkSession, path: str, first, last) -> DataFrame | None:
    """Valid silver rows of some days; None if there are none."""
    rows = read_days(spark, path, first, last)
    return None if rows is None else rows.where("is_valid_record")


# -- the raw tier: JSON lines in a folder for each day of event time --------------

RAW_LINE = "value string, hour int"


def _raw_lines(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("value", "hour", "make_date(year, month, day) AS event_date")


def _read_lines(spark: SparkSession, path: str, first=None, last=None, only=None) -> DataFrame | None:
    return versions.read(spark, path, first, last, file_format="json", schema=RAW_LINE, only=only)


def read_raw(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """Raw rows of all days or of some; no rows if there are none.

    The manifest names the folders that count, so neither a stream's log of all its files nor
    a listing of other days is read.
    """
    rows = _read_lines(spark, path, first, last)
    if rows is None:
        return spark.createDataFrame([], C.RAW_SCHEMA)
    return rows.selectExpr(
        "value", "year(event_date) AS year", "month(event_date) AS month", "day(event_date) AS day", "hour"
    )


def raw_days(raw: DataFrame, first, last) -> DataFrame:
    """Raw rows of some days; the date is built from date parts only."""
    return raw.where(between_days("make_date(year, month, day)", first, last))


def write_raw(rows: DataFrame, path: str) -> None:
    """Raw rows as JSON lines; the days that they have are replaced."""
    lines = packed(_raw_lines(rows))
    replace_days(rows.sparkSession, lines, path, ("event_date",), None, None, file_format="json")


def append_raw(rows: DataFrame, path: str, source: str) -> bool:
    """A batch of raw rows, added to its days once: one file for a day, if it is not large."""
    lines = packed(_raw_lines(rows))
    return versions.append_once(rows.sparkSession, lines, path, ("event_date",), source, file_format="json")


def compact_raw(spark: SparkSession, path: str, first, last, file_bytes: int = 256 << 20) -> int:
    """Rewrite closed days that many batches have left in many small files; returns how many.

    A day's files are packed into as few of about ``file_bytes`` as hold them; a day that has
    no more than that is left alone. It must get no more rows meanwhile, see ``versions``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/data")
    files = files.selectExpr(
        "regexp_extract(path, '/version=([^/]+)/', 1) AS folder",
        "to_date(regexp_extract(path, '/event_date=([^/]+)/', 1)) AS day",
        "length",
    )
    live = versions.counting(spark, path, between_days("day", first, last))
    sizes = files.join(live, ["folder", "day"]).groupBy("day").agg(
        F.count("*").alias("files"), F.ceil(F.sum("length") / file_bytes).cast("int").alias("needed")
    )
    found = sizes.where("files > needed").select("day", "needed").collect()  # a row per day
    if found:
        lines = _read_lines(spark, path, only=[one.day for one in found])
        wanted = F.broadcast(spark.createDataFrame(found, "event_date date, needed int"))
        # as many parts of a day as files are needed, each written by one task
        part = F.expr("pmod(xxhash64(value), needed)").alias("part")
        cut = lines.join(wanted, "event_date").select("value", "hour", "event_date", part)
        rows = cut.repartition("event_date", "part").drop("part")
        replace_days(spark, rows, path, ("event_date",), None, None, file_format="json")
    return len(found)


def input_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, source) of the files under a path; ``source`` changes if the file does."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    changed = "concat_ws('|', path, length, unix_micros(modificationTime))"
    return files.selectExpr("path", f"sha2({changed}, 256) AS source")


def read_historical(
    spark: SparkSession,
    path: str | list[str],
    file_format: str = "json",
    schema=None,
    multiline: bool = False,
    **options,
) -> DataFrame:
    """An earlier export in any format Spark reads.

    Without ``schema`` it is inferred, which costs a pass over JSON or CSV.
    ``multiline`` is for files that hold one document; such files cannot be
    split, and lines after the first record would be lost in a JSON-lines file.
    """
    reader = spark.read.format(file_format).options(**options)
    if multiline:
        reader = reader.option("multiLine", "true")
    return (reader if schema is None else reader.schema(schema)).load(path)


def probe(spark: SparkSession, path: str) -> None:
    """Fail early, with Spark's own error, if ``path`` cannot be written and read."""
    marker = uuid.uuid4().hex
    target = f"{path.rstrip('/')}/_probe/{marker}"
    spark.range(1).selectExpr(*named({"marker": text(marker)})).write.mode("overwrite").json(target)
    found = spark.read.schema("marker string").json(target).first()
    delete(spark, target)
    if found is None or found.marker != marker:
        raise OSError(f"{path}: what was written could not be read back")
