r"""Raw lake to serving marts for a range of days.

    spark-submit --py-files fieldgauge.zip fieldgauge/plans/daily_job.py \
        --lake PATH --first 2024-01-01 [--last 2024-01-30]

Each step writes its table and the next one reads it back, so nothing is cached
and a lost executor costs only its own tasks. The first failure ends the run.
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldgauge import contract as C
from fieldgauge import session
from fieldgauge.functions.sql import as_date
from fieldgauge.operators import bronze, export, gold, quality, silver
from fieldgauge.sources import serving, tables, versions


@dataclass(frozen=True)
class Lake:
    """Where the tiers are."""

    root: str

    def path(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    @property
    def raw(self):
        return self.path("raw")

    @property
    def bronze(self):
        return self.path("bronze")

    @property
    def history(self):
        return self.path("bronze_history")

    @property
    def silver(self):
        return self.path("silver")

    def gold(self, table: str):
        return self.path("gold", table)


def bronze_step(spark: SparkSession, lake: Lake, first, last, as_of) -> int:
    raw = tables.read_raw(spark, lake.raw, first, last)
    rows = bronze.from_raw(raw, as_of)
    counted = tables.replace_days(
        spark, rows, lake.bronze, C.BRONZE_PARTITIONS, first, last, F.count(F.lit(1)).alias("rows")
    )
    return counted.get("rows", 0)


def append_historical(
    spark: SparkSession, lake: Lake, loaded: DataFrame, as_of, file_format: str, sources=None
) -> None:
    """Add an earlier export to bronze, in a table that the daily load does not replace.

    Rows alone are added as often as this runs; ``load_historical`` knows what it has loaded.
    """
    rows = bronze.conform(bronze.historical(loaded, as_of, file_format))
    versions.append(spark, tables.packed(rows), lake.history, C.BRONZE_PARTITIONS, sources)


def load_historical(
    spark: SparkSession, lake: Lake, path: str, as_of, file_format: str = "json", **options
) -> int:
    """Add the files of an export that were not loaded before; returns how many.

    A file is known by its path, size and time of change. Rows and the list of files take
    effect together, so a load that is run again, or ends half-way, adds nothing twice.
    """
    files = tables.input_files(spark, path)
    new = files.join(versions.sources(spark, lake.history), "source", "left_anti")
    found = new.collect()  # Spark lists the files of a scan on the driver as well
    if not found:
        return 0
    paths = [row.path for row in found]
    whole_folder = not any(c in path for c in "*?[{") and not paths[0].endswith(path.rstrip("/"))
    if whole_folder:  # folders named key=value stay columns
        options = {"basePath": path, **options}
    loaded = tables.read_historical(spark, paths, file_format, **options)
    sources = spark.createDataFrame([(row.source,) for row in found], "source string")
    append_historical(spark, lake, loaded, as_of, file_format, sources)
    return len(found)


def quarantine(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """Historical rows that no day can be given, with the reason; None if there are none."""
    rows = versions.read_undated(spark, lake.history)
    return None if rows is None else rows.withColumn("reason", F.lit(C.NO_TIME))


def silver_step(spark: SparkSession, lake: Lake, first, last, as_of, bands="reference"):
    """Write valid rows; the quality report is counted in the same pass."""
    rows = tables.bronze_days(spark, lake.bronze, first, last, lake.history)
    if rows is None:
        scores, parts = lake.gold("quality_by_device"), C.GOLD_PARTITIONS
        tables.replace_days(spark, None, scores, parts, first, last)
        tables.replace_days(spark, None, lake.silver, C.SILVER_PARTITIONS, first, last)
        counts = {"total_records": 0, "valid_records": 0}
    else:
        standard = silver.standardize(rows)
        scores = tables.packed(quality.by_device(standard))
        path = lake.gold("quality_by_device")
        tables.replace_days(spark, scores, path, C.GOLD_PARTITIONS, first, last)
        counts = _write_silver(standard, lake, first, last, as_of, bands)
    counted = spark.createDataFrame(
        [(counts["total_records"], counts["valid_records"])],
        "total_records long, valid_records long",
    )
    return quality.grade_counts(counted)


def _write_silver(standard: DataFrame, lake: Lake, first, last, as_of, bands):
    seen = Observation()
    rows = silver.from_standard(standard.observe(seen, *quality.counts()), as_of, bands)
    spark = standard.sparkSession
    tables.replace_days(spark, rows, lake.silver, C.SILVER_PARTITIONS, first, last)
    return seen.get


GOLD_TABLES = ("partials", "sketches", "hourly", "daily", "device")
_FINGERPRINTS = "fingerprints"


def gold_step(spark: SparkSession, lake: Lake, first, last, as_of) -> bool:
    """Gold of the days whose silver rows have changed; returns whether any day has rows.

    One scan of silver into hourly partials, the tables from those. A day's fingerprint is
    stored last, so a run that ends before computes the day again.
    """
    rows = tables.silver_days(spark, lake.silver, first, last)
    found = {} if rows is None else {r.event_date: r for r in gold.fingerprints(rows).collect()}
    known = tables.read_days(spark, lake.gold(_FINGERPRINTS), first, last)
    before = {} if known is None else {r.event_date: r for r in known.collect()}  # a row per day

    def same(day):
        now, then = found.get(day), before.get(day)
        return (now and (now.readings, now.digest)) == (then and (then.readings, then.digest))

    changed = [day for day in tables.days(first, last) if not same(day)]
    if changed:
        _write_gold(spark, lake, None if rows is None else rows.where(F.col("event_date").isin(changed)), changed, as_of)
        prints = [found[day] for day in changed if day in found]
        stored = spark.createDataFrame(prints, "event_date date, readings long, digest string").coalesce(1)
        _replace_gold(spark, lake, _FINGERPRINTS, stored, changed)
    return bool(found)


def _replace_gold(spark: SparkSession, lake: Lake, name: str, table: DataFrame | None, changed) -> None:
    tables.replace_days(spark, table, lake.gold(name), C.GOLD_PARTITIONS, None, None, only=changed)


def _write_gold(spark: SparkSession, lake: Lake, rows: DataFrame | None, changed, as_of) -> None:
    if rows is None:
        for name in GOLD_TABLES:
            _replace_gold(spark, lake, name, None, changed)
        return
    _replace_gold(spark, lake, "partials", tables.packed(gold.partials(rows)), changed)
    by_hour = tables.read_days(spark, lake.gold("partials"), only=changed)
    if by_hour is None:  # the last days with rows have lost them
        _write_gold(spark, lake, None, changed, as_of)
        return
    by_device = gold.merge_hours(by_hour)
    for name, table in {
        "sketches": gold.sketches(by_hour),
        "hourly": gold.hourly(by_hour, as_of),
        "daily": gold.daily(by_device, as_of),
        "device": gold.device(by_device, as_of),
    }.items():
        _replace_gold(spark, lake, name, tables.packed(table), changed)


_SERVED = ("hourly", "daily", "device")


def gold_tables(spark: SparkSession, lake: Lake, first, last) -> dict[str, DataFrame]:
    return {name: tables.read_days(spark, lake.gold(name), first, last) for name in _SERVED}


def all_gold_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame | None]:
    return {name: tables.read_days(spark, lake.gold(name)) for name in _SERVED}


def export_step(
    spark: SparkSession, marts: dict[str, DataFrame], target: serving.Target
) -> DataFrame:
    """Replace each mart that has rows. A failure is recorded and the rest go on.

    Returns (table_name, records, error). Rows are counted while they are written.
    """
    outcome = []
    for name, rows in marts.items():
        try:
            # emptying a database table is never meant; by day, no rows replace nothing
            if not target.by_day and rows.isEmpty():
                outcome.append((name, 0, None))
                continue
            laid_out = rows if target.by_day else export.ordered(name, rows)
            outcome.append((name, target.replace(name, export.DAY[name], laid_out), None))
        except Exception as failure:  # reported per table, raised by the job
            outcome.append((name, 0, f"{type(failure).__name__}: {failure}"))
    return spark.createDataFrame(outcome, "table_name string, records long, error string")


def export_summary(outcome: DataFrame, as_of) -> DataFrame:
    """One row: tables that were exported without error, and their records."""
    return outcome.agg(
        F.count_if(F.col("error").isNull()).alias("tables_exported"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records_exported"),
    ).select(F.lit(as_date(as_of)).alias("export_date"), "*")


def run(
    spark: SparkSession,
    lake: Lake,
    first,
    last,
    as_of: dt.datetime,
    target: serving.Target | None = None,
    bands: str = "reference",
) -> dict[str, DataFrame]:
    """All steps for the days from ``first`` to ``last``; returns the two reports.

    A target that replaces whole tables gets all days of gold, so none leaves it.
    """
    session.prepared(spark)
    target = target or serving.ParquetTarget(lake.path("marts"))
    first, last = as_date(first), as_date(last)
    tables.probe(spark, lake.root)
    bronze_step(spark, lake, first, last, as_of)
    report = silver_step(spark, lake, first, last, as_of, bands)
    outcome = spark.createDataFrame([], "table_name string, records long, error string")
    filled = gold_step(spark, lake, first, last, as_of)
    if target.by_day:
        served = gold_tables(spark, lake, first, last) if filled else {}
        target = target.covering(first, last)
        for name, day in export.DAY.items() if not filled else ():
            target.replace(name, day, None)
    else:  # also after a run without rows: its days may have had some before
        served = all_gold_tables(spark, lake)
    if served and None not in served.values():
        outcome = export_step(spark, export.marts(served, as_of), target)
    failed = outcome.where("error is not null").collect()  # at most one row per mart
    if failed:
        raise RuntimeError("; ".join(f"{row.table_name}: {row.error}" for row in failed))
    return {"quality": report, "export": export_summary(outcome, as_of)}


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    args.add_argument("--lake", required=True)
    args.add_argument("--first", required=True, type=dt.date.fromisoformat)
    args.add_argument("--last", type=dt.date.fromisoformat)
    args.add_argument("--as-of", type=dt.datetime.fromisoformat)
    args.add_argument("--bands", choices=("reference", "contiguous"), default="reference")
    args.add_argument("--jdbc-url")
    args.add_argument("--jdbc-driver")
    args.add_argument("--jdbc-user")
    # the password comes from spark conf, so it is not on the command line
    opts = args.parse_args(argv)
    spark = session.builder("fieldgauge-daily").getOrCreate()
    target = None
    if opts.jdbc_url:
        props = {"driver": opts.jdbc_driver, "user": opts.jdbc_user}
        props["password"] = spark.conf.get("spark.fieldgauge.jdbc.password", None)
        target = serving.JdbcTarget(opts.jdbc_url, {k: v for k, v in props.items() if v})
    as_of = opts.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    reports = run(
        spark, Lake(opts.lake), opts.first, opts.last or opts.first, as_of, target, opts.bands
    )
    for name, report in reports.items():
        print(name)
        report.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
