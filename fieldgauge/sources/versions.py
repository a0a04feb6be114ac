"""Tables of days that change all at once: data in versions, and a manifest of what counts.

A write puts its rows into a folder of its own, ``data/version=.../<day>=.../``, which nobody
reads yet. It takes effect by one more file in ``manifest/``, renamed into place when it is
whole. So a reader sees the days as they were or as they are, never both and never neither,
and a run that ends between the two steps changes nothing. Readers that began before go on
with the files they know, until ``vacuum`` deletes what no longer counts.

Manifest rows, by ``mode``: ``replace`` says that from this commit on, a day has just this
folder's rows, or none; ``append`` adds a folder's rows to a day; ``source`` names an input
file that is part of the commit. Of a day, the folders since its last replacement count.
One writer at a time; a second one that commits meanwhile is an error in both.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from fieldgauge.functions.sql import as_date, date
from fieldgauge.session import delete

MANIFEST = "commit long, mode string, folder string, day date, has_rows boolean, source string"
REPLACE, APPEND, SOURCE = "replace", "append", "source"
_UNDATED = "__HIVE_DEFAULT_PARTITION__"
_DAYS, _NO_DAY = "days_found", "undated_found"


def days(first, last) -> list[dt.date]:
    first, last = as_date(first), as_date(last)
    return [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """All that was committed; no rows if there is no such table."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def counting(spark: SparkSession, path: str, condition: str = "true") -> DataFrame:
    """(day, folder) of the data that counts, for the days that meet a condition."""
    # small rows: one task folds them, without a shuffle
    rows = manifest(spark, path).where(F.col("mode") != SOURCE).where(condition).coalesce(1)
    replaced = F.max(F.when(F.col("mode") == REPLACE, F.struct("commit", "folder")))
    since = rows.withColumn("since", replaced.over(Window.partitionBy("day")))
    kept = since.where("has_rows AND (since IS NULL OR struct(commit, folder) >= since)")
    return kept.select("day", "folder").distinct()


def replace_days(
    spark: SparkSession, rows: DataFrame | None, path: str, partitions: tuple[str, ...], first, last,
    *measures: Column, day: str = "event_date", file_format: str = "parquet", only: list[dt.date] | None = None,
) -> dict:
    """Make a table hold exactly ``rows`` for some days; None or no rows empties them.

    Without ``first``, the days that the rows have are replaced; ``only`` names single days.

    Returns the measures, taken in the pass that writes. Rows of other days are an error.
    """
    commit, folder = _next(spark, path)
    found, seen = set(), {}
    if rows is not None:
        seen = _write(rows, path, folder, partitions, day, measures, file_format)
        found = set(seen.pop(_DAYS))
    if only is None:
        wanted = sorted(found) if first is None else days(first, last)
    else:
        wanted = sorted(only)
    if rows is not None:
        others = found.difference(wanted)
        if others or seen.pop(_NO_DAY):
            raise ValueError(f"{path}: rows outside {wanted[:1]} to {wanted[-1:]}: {sorted(map(str, others)) or 'undated'}")
    entries = [(commit, REPLACE, folder, one, one in found, None) for one in wanted]
    _commit(spark, path, commit, spark.createDataFrame(entries, MANIFEST))
    return seen


def append(
    spark: SparkSession, rows: DataFrame, path: str, partitions: tuple[str, ...],
    sources: DataFrame | None = None, day: str = "event_date", file_format: str = "parquet",
) -> None:
    """Add rows to their days. ``sources`` (source) are remembered in the same commit.

    Rows without a day are kept too, see ``read_undated``.
    """
    commit, folder = _next(spark, path)
    seen = _write(rows, path, folder, partitions, day, (), file_format)
    found = [*sorted(seen[_DAYS]), *([None] if seen[_NO_DAY] else [])]
    entries = spark.createDataFrame([(commit, APPEND, folder, one, True, None) for one in found], MANIFEST)
    if sources is not None:
        entries = entries.unionByName(
            sources.select(
                F.lit(commit).alias("commit"), F.lit(SOURCE).alias("mode"), F.lit(folder).alias("folder"),
                F.lit(None).cast("date").alias("day"), F.lit(False).alias("has_rows"), "source",
            )
        )
    _commit(spark, path, commit, entries)


def append_once(
    spark: SparkSession, rows: DataFrame, path: str, partitions: tuple[str, ...], source: str, **more
) -> bool:
    """Add rows under a name, say of a stream's batch; not again if that name was committed."""
    if not manifest(spark, path).where((F.col("mode") == SOURCE) & (F.col("source") == source)).isEmpty():
        return False
    append(spark, rows, path, partitions, spark.createDataFrame([(source,)], "source string"), **more)
    return True


def read(
    spark: SparkSession, path: str, first=None, last=None, day: str = "event_date",
    file_format: str = "parquet", schema: str | None = None, only: list[dt.date] | None = None,
) -> DataFrame | None:
    """The rows of some days or, without bounds, of all; None if there are none.

    ``only`` names single days instead.

    Only folders of those days are listed, however long the table's history.
    """
    bounds = "{} IS NOT NULL" if first is None else f"{{}} BETWEEN {date(first)} AND {date(last)}"
    if only is not None:
        bounds = f"{{}} IN ({', '.join(map(date, only))})" if only else "false"
    found = counting(spark, path, bounds.format("day")).collect()  # a row per day and load
    if not found:
        return None
    folders = sorted(f"{path}/data/version={r.folder}/{day}={r.day}" for r in found)
    reader = spark.read.format(file_format).option("basePath", f"{path}/data")
    reader = reader if schema is None else reader.schema(f"{schema}, {day} date, version string")
    return reader.load(folders).drop("version").where(bounds.format(day))


def read_undated(spark: SparkSession, path: str, day: str = "event_date") -> DataFrame | None:
    """Rows that were added without a day; None if there are none."""
    found = counting(spark, path, "day IS NULL").collect()  # a row per load
    if not found:
        return None
    folders = sorted(f"{path}/data/version={r.folder}/{day}={_UNDATED}" for r in found)
    rows = spark.read.option("basePath", f"{path}/data").parquet(*folders).drop("version")
    return rows.withColumn(day, F.lit(None).cast("date"))


def sources(spark: SparkSession, path: str) -> DataFrame:
    """(source) of every input file that is part of the table."""
    return manifest(spark, path).where(F.col("mode") == SOURCE).select("source").distinct()


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete versions that no longer count, and gather the manifest in one file.

    For quiet times: readers that began before lose what they read, and a write that has not
    been committed yet loses its rows. Returns the number of versions that were deleted.
    """
    rows, live = manifest(spark, path), counting(spark, path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/data")
    there = files.select(F.regexp_extract("path", "/data/version=([^/]+)/", 1).alias("folder")).distinct()
    stale = [r.folder for r in there.join(live.select("folder").distinct(), "folder", "left_anti").collect()]
    old_files = [r[0] for r in rows.select(F.input_file_name()).distinct().collect()]
    kept = rows.join(live, rows.day.eqNullSafe(live.day) & (rows.folder == live.folder), "left_semi")
    kept = kept.unionByName(rows.where(F.col("mode") == SOURCE))
    # the last replacement of a day counts for its commit number, even if it emptied the day
    last = rows.where(F.col("mode") == REPLACE).groupBy("day").agg(F.max_by(F.struct("*"), "commit").alias("r"))
    kept = kept.unionByName(last.select("r.*")).distinct().coalesce(1)
    kept.write.mode("append").parquet(f"{path}/manifest")  # a row that is there twice counts once
    for name in old_files:
        delete(spark, name)
    for folder in stale:
        delete(spark, f"{path}/data/version={folder}")
    return len(stale)


def _next(spark: SparkSession, path: str) -> tuple[int, str]:
    last = manifest(spark, path).coalesce(1).agg(F.max("commit")).first()[0]
    commit = 1 if last is None else last + 1
    return commit, f"v{commit:09d}-{uuid.uuid4().hex[:8]}"


def _write(rows: DataFrame, path: str, folder: str, partitions, day: str, measures, file_format: str) -> dict:
    seen = Observation()
    found = [F.collect_set(day).alias(_DAYS), F.count_if(F.col(day).isNull()).alias(_NO_DAY)]
    observed = rows.observe(seen, *found, *measures)
    observed.write.partitionBy(*partitions).format(file_format).save(f"{path}/data/version={folder}")
    return {_DAYS: [], _NO_DAY: 0, **seen.get}


def _commit(spark: SparkSession, path: str, commit: int, entries: DataFrame) -> None:
    """One file, so that the rename that ends the write is the moment of the change."""
    entries.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    writers = manifest(spark, path).where(F.col("commit") == commit).coalesce(1)
    if writers.agg(F.count_distinct("folder")).first()[0] > 1:
        raise RuntimeError(f"{path}: another writer committed at the same time; run this one again")
