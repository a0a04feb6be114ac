"""Versioned tables: what a reader sees between a write and its commit, and afterwards."""

import datetime as dt

import harness
import pytest
import samples
from pyspark.sql import functions as F

from fieldgauge.operators import export
from fieldgauge.plans import catalog, daily_job
from fieldgauge.sources import feed, serving, tables, versions

SMALL = str(harness.TESTDATA / "sf0.001")
AS_OF = dt.datetime(2024, 1, 31, 6)
D1, D2, D3 = (dt.date(2024, 1, n) for n in (1, 2, 3))
BY_DAY = ("event_date",)


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id long, event_date date")


def ids(frame):
    return [] if frame is None else sorted(r.id for r in frame.collect())


def test_nothing_is_seen_before_the_commit(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.replace_days(spark, rows(spark, (1, D1), (2, D2)), path, BY_DAY, D1, D2)

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as between:
        between.setattr(versions, "_commit", stop)
        with pytest.raises(KeyboardInterrupt):
            versions.replace_days(spark, rows(spark, (10, D1)), path, BY_DAY, D1, D2)
    assert ids(versions.read(spark, path)) == [1, 2]
    versions.replace_days(spark, rows(spark, (11, D1)), path, BY_DAY, D1, D2)
    assert ids(versions.read(spark, path)) == [11]
    # the folder of the run that ended is not read, and goes with the replaced one
    assert versions.vacuum(spark, path) == 2
    assert ids(versions.read(spark, path)) == [11]


def test_a_reader_keeps_what_it_began_with(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace_days(spark, rows(spark, (1, D1)), path, BY_DAY, D1, D1)
    begun = versions.read(spark, path)
    versions.replace_days(spark, rows(spark, (2, D1)), path, BY_DAY, D1, D1)
    assert ids(begun) == [1] and ids(versions.read(spark, path)) == [2]


def test_days_that_lose_their_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace_days(spark, rows(spark, (1, D1), (2, D2), (3, D3)), path, BY_DAY, D1, D3)
    versions.replace_days(spark, None, path, BY_DAY, D2, D2)
    versions.replace_days(spark, rows(spark), path, BY_DAY, D3, D3)
    assert ids(versions.read(spark, path)) == [1]
    assert versions.read(spark, path, D2, D3) is None
    versions.vacuum(spark, path)
    assert ids(versions.read(spark, path)) == [1] and versions.read(spark, path, D2, D3) is None


def test_rows_of_other_days_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    for odd in ((1, D3), (1, None)):
        with pytest.raises(ValueError, match="rows outside"):
            versions.replace_days(spark, rows(spark, odd), path, BY_DAY, D1, D2)
    assert versions.read(spark, path) is None


def test_appended_rows_add_up_until_they_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2):
        versions.append(spark, rows(spark, (n, D1), (10 * n, None)), path, BY_DAY)
    assert ids(versions.read(spark, path)) == [1, 2]
    assert ids(versions.read_undated(spark, path)) == [10, 20]
    versions.replace_days(spark, rows(spark, (3, D1)), path, BY_DAY, D1, D1)
    versions.append(spark, rows(spark, (4, D1)), path, BY_DAY)
    assert ids(versions.read(spark, path)) == [3, 4]
    versions.vacuum(spark, path)
    assert ids(versions.read(spark, path)) == [3, 4] and ids(versions.read_undated(spark, path)) == [10, 20]


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    monkeypatch.setattr(versions, "_next", lambda *_: (1, f"v1-{monkeypatch}-{dt.datetime.now().microsecond}"))
    versions.replace_days(spark, rows(spark, (1, D1)), path, BY_DAY, D1, D1)
    with pytest.raises(RuntimeError, match="another writer"):
        versions.replace_days(spark, rows(spark, (2, D1)), path, BY_DAY, D1, D1)


def test_a_table_of_other_columns_named_alike(spark, tmp_path):
    """Columns of the rows may have the manifest's names."""
    path = str(tmp_path / "t")
    odd = rows(spark, (1, D1)).selectExpr("*", "'a' AS folder", "'b' AS mode", "1 AS commit", "'c' AS source")
    versions.replace_days(spark, odd, path, BY_DAY, D1, D1)
    assert versions.read(spark, path).select("folder", "mode", "commit", "source").first() == ("a", "b", 1, "c")


def test_marts_follow_a_day_that_loses_its_rows(spark, tmp_path):
    lake = daily_job.Lake(str(tmp_path / "lake"))
    raw = catalog._raw(spark, SMALL)
    tables.write_raw(tables.raw_days(raw, D1, D2), lake.raw)
    daily_job.run(spark, lake, D1, D2, AS_OF)
    # the second day's readings lose their motion, so none is valid
    broken = tables.raw_days(raw, D2, D2).withColumn("value", F.regexp_replace("value", '"motion":(true|false)', '"x":0'))
    tables.write_raw(broken, lake.raw)
    daily_job.run(spark, lake, D2, D2, AS_OF)
    for name in (export.TIMESERIES, export.DAILY, export.DEVICES):
        left = serving.ParquetTarget(lake.path("marts")).read(spark, name)
        assert {r[0] for r in left.select("report_date").collect()} == {D1}, name


def test_gold_is_computed_for_changed_days_only(spark, tmp_path):
    lake = daily_job.Lake(str(tmp_path / "lake"))
    raw = catalog._raw(spark, SMALL)
    tables.write_raw(tables.raw_days(raw, D1, D3), lake.raw)

    def run(as_of):
        daily_job.run(spark, lake, D1, D3, as_of)
        commits = {n: versions.manifest(spark, lake.gold(n)).count() for n in daily_job.GOLD_TABLES}
        rows = tables.read_days(spark, lake.gold("daily")).select("event_date", "processing_time").distinct()
        return commits, {r.event_date: r.processing_time for r in rows.collect()}

    first = run(AS_OF)
    later = AS_OF + dt.timedelta(hours=1)
    assert run(later) == first  # nothing has changed, nothing is written
    moved = F.regexp_replace("value", "field-[ab]", "moved-x")
    tables.write_raw(tables.raw_days(raw, D2, D2).withColumn("value", moved), lake.raw)
    commits, times = run(later)
    assert commits == {name: n + 1 for name, n in first[0].items()}
    assert times == {D1: AS_OF, D2: later, D3: AS_OF}
    daily = tables.read_days(spark, lake.gold("daily"))
    assert {r[0] for r in daily.where("location = 'moved-x'").select("event_date").collect()} == {D2}
    # a day that loses its rows
    broken = F.regexp_replace("value", '"motion":(true|false)', '"x":0')
    tables.write_raw(tables.raw_days(raw, D3, D3).withColumn("value", broken), lake.raw)
    assert set(run(later)[1]) == {D1, D2}


# -- historical loads ------------------------------------------------------------


def _export(spark, path, first, last):
    source = feed.readings(feed.events(spark, SMALL)).where(f"event_id BETWEEN {first} AND {last}")
    catalog_rows = source.withColumn("timestamp", F.when(F.col("event_id") % 10 != 0, F.col("timestamp")))
    catalog_rows.coalesce(1).write.mode("append").json(path)


def test_loading_twice_adds_nothing_and_new_files_are_added(spark, tmp_path):
    lake, path = daily_job.Lake(str(tmp_path / "lake")), str(tmp_path / "export")
    _export(spark, path, 0, 99)
    assert daily_job.load_historical(spark, lake, path, AS_OF) == 1
    assert daily_job.load_historical(spark, lake, path, AS_OF) == 0
    assert versions.read(spark, lake.history).count() == 90
    _export(spark, path, 100, 199)
    assert daily_job.load_historical(spark, lake, path, AS_OF) == 1
    assert versions.read(spark, lake.history).count() == 180
    kept = daily_job.quarantine(spark, lake)
    assert kept.count() == 20 and kept.select("reason").distinct().first()[0] == "missing_timestamp"
    assert kept.where("deviceId IS NULL OR event_date IS NOT NULL").count() == 0
    versions.vacuum(spark, lake.history)
    assert daily_job.load_historical(spark, lake, path, AS_OF) == 0
    assert versions.read(spark, lake.history).count() == 180


def test_a_load_that_ends_half_way_can_be_run_again(spark, tmp_path, monkeypatch):
    lake, path = daily_job.Lake(str(tmp_path / "lake")), str(tmp_path / "export")
    _export(spark, path, 0, 49)

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as between:
        between.setattr(versions, "_commit", stop)
        with pytest.raises(KeyboardInterrupt):
            daily_job.load_historical(spark, lake, path, AS_OF)
    assert versions.read(spark, lake.history) is None
    assert daily_job.load_historical(spark, lake, path, AS_OF) == 1
    assert versions.read(spark, lake.history).count() == 45


def test_folders_named_by_value_stay_columns(spark, tmp_path):
    lake, path = daily_job.Lake(str(tmp_path / "lake")), str(tmp_path / "export")
    rows = samples.readings(spark, {}).select(*[k for k in samples.NORMAL if k not in samples.C.METADATA])
    rows.write.partitionBy("location").json(path)
    daily_job.load_historical(spark, lake, path, AS_OF)
    assert versions.read(spark, lake.history).first().location == rows.first().location


def test_a_file_given_by_name(spark, tmp_path):
    lake, path = daily_job.Lake(str(tmp_path / "lake")), tmp_path / "export"
    _export(spark, str(path), 0, 9)
    (one,) = path.glob("part-*.json")
    assert daily_job.load_historical(spark, lake, str(one), AS_OF) == 1
    assert daily_job.load_historical(spark, lake, f"{path}/*.json", AS_OF) == 0
