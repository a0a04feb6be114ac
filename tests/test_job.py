"""The daily job over a small lake."""

import datetime as dt

import harness
import pytest
import samples

from fieldgauge.operators import export, gold, ingest, reports
from fieldgauge.plans import catalog, daily_job
from fieldgauge.sources import feed, serving, tables

SMALL = str(harness.TESTDATA / "sf0.001")
AS_OF = dt.datetime(2024, 1, 31, 6)
D1, D3, D4 = dt.date(2024, 1, 1), dt.date(2024, 1, 3), dt.date(2024, 1, 4)
GOLD = ("hourly", "daily", "device")


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Raw lake of the first four days of the feed."""
    path = str(tmp_path_factory.mktemp("raw") / "raw")
    messages = feed.messages(feed.readings(feed.events(spark, SMALL)))
    rows = ingest.raw_rows(ingest.accept(ingest.parse(messages)))
    tables.write_raw(tables.raw_days(rows, D1, D4), path)
    return path


class _Lake(daily_job.Lake):
    """A lake whose raw tier is the shared one."""

    raw_path = ""

    @property
    def raw(self):
        return self.raw_path


@pytest.fixture
def lake(tmp_path, raw):
    made = _Lake(str(tmp_path / "lake"))
    object.__setattr__(made, "raw_path", raw)
    return made


def table(spark, path):
    return tables.read_days(spark, path)


def mart(spark, lake, name):
    return serving.ParquetTarget(f"{lake.root}/marts").read(spark, name)


def same(left, right):
    columns = sorted(left.columns)
    left, right = left.select(*columns), right.select(*columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_one_day_is_that_days_slice_of_many(spark, lake, tmp_path, raw):
    daily_job.run(spark, lake, D1, D4, AS_OF)
    single = _Lake(str(tmp_path / "single"))
    object.__setattr__(single, "raw_path", raw)
    daily_job.run(spark, single, D3, D3, AS_OF)
    for name in (*GOLD, "quality_by_device"):
        many = table(spark, lake.gold(name)).where(f"event_date = DATE '{D3}'")
        assert many.count() > 0
        assert same(catalog._steadied(many), catalog._steadied(table(spark, single.gold(name))))


def test_running_again_changes_nothing_and_keeps_other_days(spark, lake):
    first = daily_job.run(spark, lake, D1, D4, AS_OF)
    before = {n: table(spark, lake.gold(n)).count() for n in GOLD}
    silver_rows = table(spark, lake.silver).count()
    daily_job.run(spark, lake, D3, D3, AS_OF)
    assert {n: table(spark, lake.gold(n)).count() for n in GOLD} == before
    assert table(spark, lake.silver).count() == silver_rows
    assert mart(spark, lake, export.DAILY).count() == before["daily"]
    summary = first["export"].first()
    assert summary.tables_exported == 3 and summary.records_exported == sum(before.values())
    report = first["quality"].first()
    assert report.valid_records == silver_rows
    assert report.total_records == table(spark, lake.bronze).count()


def test_job_matches_the_registered_query(spark, lake):
    daily_job.run(spark, lake, D1, D4, AS_OF)
    for name in GOLD:
        rows = table(spark, lake.gold(name)).drop("processing_time", "processing_date")
        whole = catalog.queries()[f"gold_{name}"](spark, SMALL)
        expected = whole.where(f"event_date <= DATE '{D4}'")
        assert same(catalog._steadied(rows), expected), name


def test_merged_hours_equal_direct_partials(spark):
    rows = catalog._silver(spark, SMALL)
    merged = gold.daily(gold.merge_hours(gold.partials(rows)), AS_OF)
    direct = gold.daily(gold.partials(rows, by_hour=False), AS_OF)
    assert same(catalog._steadied(merged), catalog._steadied(direct))


def test_gold_with_one_hot_device(spark):
    """A third of all readings from one device, and metrics that may be missing."""
    many = spark.range(3000).selectExpr(
        "DATE '2024-01-01' AS event_date", "'l' AS location", "'t' AS deviceType",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE string(id % 50) END AS deviceId",
        "int(id % 24) AS hour_of_day", "double(id % 10) AS temperature", "1.0D AS humidity",
        "1.0D AS pressure", "1.0D AS light", "1.0D AS acidity", "1.0D AS data_quality_score",
        "CASE WHEN id % 2 = 0 THEN int(id % 100) END AS battery_level", "-50 AS signal_strength",
        "id % 2 = 0 AS motion", "'poor' AS comfort_index", "'dim' AS light_category",
        "'neutral' AS acidity_category", "timestamp_seconds(id) AS sensor_timestamp",
    )
    day = gold.daily(gold.partials(many, by_hour=False), AS_OF).first()
    assert (day.daily_readings, day.active_devices, day.active_hours) == (3000, 51, 24)
    assert (day.daily_motion_detections, day.daily_avg_temp) == (1500, 4.5)
    hot = gold.device(gold.partials(many, by_hour=False), AS_OF).where("deviceId = 'hot'").first()
    known = [n % 100 for n in range(0, 3000, 6)]
    assert hot.total_readings == 1000 and hot.active_hours == 8
    assert hot.avg_battery_level == pytest.approx(sum(known) / len(known))
    hours = gold.hourly(gold.partials(many), AS_OF)
    exact = many.groupBy("hour_of_day").agg({"deviceId": "count"}).count()
    assert hours.count() == exact
    distinct = many.selectExpr("count(DISTINCT deviceId, hour_of_day)").first()[0]
    assert hours.agg({"unique_devices": "sum"}).first()[0] == distinct


def test_empty_days(spark, lake):
    late = dt.date(2031, 1, 1)
    reports_ = daily_job.run(spark, lake, late, late, AS_OF)
    assert tuple(reports_["quality"].first())[:2] == (0, 0)
    assert reports_["export"].first().records_exported == 0
    assert tables.bronze_days(spark, lake.bronze, late, late) is None
    assert tables.silver_days(spark, str(lake.root) + "/nothing", late, late) is None


def test_a_failed_mart_ends_the_job_but_not_the_others(spark, lake):
    class Refusing(serving.ParquetTarget):
        def replace(self, name, day, rows):
            if name == export.DAILY:
                raise ConnectionError("no route")
            return super().replace(name, day, rows)

    with pytest.raises(RuntimeError, match="daily_report: ConnectionError: no route"):
        daily_job.run(spark, lake, D1, D1, AS_OF, Refusing(f"{lake.root}/marts"))
    assert mart(spark, lake, export.DEVICES).count() > 0


def test_whole_table_target_gets_the_look_back_in_order(spark, lake):
    daily_job.run(spark, lake, D1, D4, AS_OF)
    seen = {}

    class Whole:
        by_day = False

        def replace(self, name, day, rows):
            seen[name] = rows.collect()
            return len(seen[name])

    daily_job.run(spark, lake, D4, D4, AS_OF, Whole())
    daily = seen[export.DAILY]
    assert {r.report_date for r in daily} == set(tables.days(D1, D4))
    assert [r.total_readings for r in daily] == sorted(
        (r.total_readings for r in daily), reverse=True
    )
    times = [r.time for r in seen[export.TIMESERIES]]
    assert times == sorted(times)


def test_empty_mart_is_not_written_over_a_table(spark):
    class Never:
        by_day = False

        def replace(self, name, day, rows):
            raise AssertionError("must not be called")

    empty = {export.DAILY: spark.createDataFrame([], "report_date date, location string")}
    outcome = daily_job.export_step(spark, empty, Never())
    assert [tuple(r) for r in outcome.collect()] == [(export.DAILY, 0, None)]


def test_historical_rows_reach_silver(spark, lake):
    daily_job.append_historical(spark, lake, _earlier(spark), AS_OF, "json")
    day = dt.date(2022, 1, 1)
    daily_job.silver_step(spark, lake, day, day, AS_OF)
    row = tables.silver_days(spark, lake.silver, day, day).first()
    assert (row.deviceId, row.data_source) == ("warehouse-a-001", "batch-json")


def test_a_run_owns_its_days_and_keeps_history(spark, tmp_path):
    """A location corrected in raw, an earlier load, and then no valid row at all."""
    day = dt.date(2024, 1, 1)
    lake = daily_job.Lake(str(tmp_path / "lake"))
    messages = feed.messages(feed.readings(feed.events(spark, SMALL)))
    good = tables.raw_days(ingest.raw_rows(ingest.accept(ingest.parse(messages))), day, day)

    def run(value="value"):
        rows = good.selectExpr(f"{value} AS value", *[c for c in good.columns if c != "value"])
        tables.write_raw(rows, lake.raw)
        daily_job.run(spark, lake, day, day, AS_OF)
        return {n: table(spark, lake.gold(n)).count() for n in GOLD}

    def silver_rows():
        return tables.silver_days(spark, lake.silver, day, day)

    run("regexp_replace(value, 'field-[ab]', 'moved-x')")
    corrected = run()
    fresh = daily_job.Lake(str(tmp_path / "fresh"))
    tables.write_raw(good, fresh.raw)
    daily_job.run(spark, fresh, day, day, AS_OF)
    for name in GOLD:
        assert same(table(spark, lake.gold(name)), table(spark, fresh.gold(name))), name
    before = silver_rows().count()
    old = samples.readings(spark, {"timestamp": 1704067200000}).select(
        *[k for k in samples.NORMAL if k not in samples.C.METADATA], *samples.C.METADATA
    )
    daily_job.append_historical(spark, lake, old, AS_OF, "json")
    for _ in range(2):
        run()
        assert silver_rows().count() == before + 1
    assert sum(corrected.values()) > 0


def test_days_without_rows_are_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(4).selectExpr("id", f"date_add(DATE '{D1}', int(id)) AS event_date")
    tables.replace_days(spark, rows, path, ("event_date",), D1, D4)
    tables.replace_days(spark, rows.where("id = 0"), path, ("event_date",), D1, D3)
    assert sorted(r.id for r in table(spark, path).collect()) == [0, 3]
    tables.replace_days(spark, None, path, ("event_date",), D1, D1)
    assert tables.read_days(spark, path, D1, D3) is None
    assert tables.read_days(spark, path, D1, D4).count() == 1


def _earlier(spark):
    flat = {k: v for k, v in samples.NORMAL.items() if k not in samples.C.METADATA}
    rows = samples.readings(spark, {}).select(*flat, *samples.C.METADATA)
    nested = f"struct({', '.join(samples.C.METADATA)}) AS metadata"
    return rows.selectExpr(*flat, nested)


def test_probe(spark, tmp_path):
    tables.probe(spark, str(tmp_path))
    blocked = tmp_path / "file"
    blocked.write_text("x")
    with pytest.raises(Exception):  # noqa: B017 - whatever the file system raises
        tables.probe(spark, str(blocked))


def test_jdbc_options():
    target = serving.JdbcTarget("jdbc:x", {"user": "u", "driver": "d"}, connections=4)
    assert target.options("daily_report") == {
        "url": "jdbc:x", "dbtable": "daily_report", "truncate": "true", "numPartitions": "4",
        "batchsize": "10000", "user": "u", "driver": "d",
    }


def test_dashboards_use_the_last_day_up_to_as_of(spark):
    rows = [("a", dt.date(2024, 1, d), 40.0 + d, float(d)) for d in (1, 2, 9)]
    mart = spark.createDataFrame(
        rows, "location string, report_date date, avg_humidity double, avg_temperature double"
    )
    known = reports.latest(mart, dt.date(2024, 1, 8)).collect()
    assert [r.report_date.day for r in known] == [2]
    score = reports.irrigation(mart, "a", dt.date(2024, 1, 9)).first()
    assert (str(score.soil_moisture), score.irrigation_efficiency) == ("45.5", 100)
    days = reports.growing_degree_days(mart, "a", dt.date(2024, 1, 9)).collect()
    assert [r.date.day for r in days] == [9, 2, 1]
    assert {str(r.growing_degree_days) for r in days} == {"0.0"}
    assert reports.irrigation(mart, "o'neil", dt.date(2024, 1, 9)).count() == 0


@pytest.mark.parametrize(
    ("humidity", "score"),
    [(40.0, 100), (70.0, 100), (39.9, 75), (30.0, 75), (80.0, 75), (29.9, 50), (90.0, 50),
     (19.9, 25), (90.1, 25)],
)
def test_irrigation_scores(spark, humidity, score):
    mart = spark.createDataFrame(
        [("a", D1, humidity)], "location string, report_date date, avg_humidity double"
    )
    assert reports.irrigation(mart, "a", D1).first().irrigation_efficiency == score


def test_panel_steps(spark):
    rows = spark.createDataFrame([(14.9,), (15.0,), (20.0,)], "v double")
    found = reports.with_status("temperature", rows, "v").collect()
    assert [r.status for r in found] == ["dark-blue", "dark-green", "red"]
    rows = spark.createDataFrame([(25,), (50,), (100,)], "v int")
    found = reports.with_status("irrigation", rows, "v").collect()
    assert [r.status for r in found] == ["red", "semi-dark-green", "dark-green"]
