"""What the optimizer makes of the queries: the properties that matter at scale."""

import datetime as dt
import re

import harness
import pytest

from fieldgauge.operators import alerts, bronze, gold, ingest, quality, reports, silver
from fieldgauge.plans import catalog
from fieldgauge.sources import feed, tables

SMALL = str(harness.TESTDATA / "sf0.001")
AS_OF = dt.datetime(2024, 1, 31)
STREAMED = [name for name in catalog.queries() if name.startswith("stream_")]


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def logical(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def shuffles(frame) -> int:
    return len(re.findall(r"Exchange (?:hash|range|Single|Round)", plan(frame)))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze"))
    rows = tables.packed(catalog._bronze(spark, SMALL))
    tables.replace_days(spark, rows, path, ("event_date",), catalog.FIRST, catalog.LAST)
    return path


@pytest.mark.parametrize("name", [n for n in catalog.queries() if n not in STREAMED])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(catalog.queries()[name](spark, SMALL))
    for word in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert word not in text


@pytest.mark.parametrize(
    "name", ["ingest_parse", "ingest_valid", "dead_letter", "alert_messages", "silver",
             "alert_anomalies", "silver_rule_flags", "quality_flag"],
)
def test_row_by_row_queries_do_not_shuffle(spark, name):
    assert shuffles(catalog.queries()[name](spark, SMALL)) == 0


def test_json_is_parsed_once(spark):
    messages = feed.messages(feed.readings(feed.events(spark, SMALL)))
    assert logical(ingest.accept(ingest.parse(messages))).count("from_json") == 1
    assert logical(ingest.dead_letter(messages)).count("from_json") == 1
    raw = spark.createDataFrame([], tables.C.RAW_SCHEMA)
    assert logical(bronze.unpack(raw)).count("from_json") <= 1


def test_anomalies_are_built_once(spark):
    rows = spark.read.parquet(f"{SMALL}/events.parquet")
    found = alerts.anomalies(alerts.alerting(feed.readings(rows)), ["event_id"])
    assert logical(found).count("format_string") == 5


def test_one_day_reads_one_partition(spark, lake):
    day = dt.date(2024, 1, 15)
    rows = tables.bronze_days(spark, lake, day, day)
    text = plan(rows)
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", text)
    assert len(rows.inputFiles()) == 1
    assert "EqualTo(processing_status,ingested)" in text


def test_raw_days_prune_partitions(spark, tmp_path):
    messages = feed.messages(feed.readings(feed.events(spark, SMALL)))
    rows = ingest.raw_rows(ingest.accept(ingest.parse(messages)))
    first, last = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    tables.write_raw(tables.raw_days(rows, first, last), str(tmp_path / "raw"))
    one = tables.raw_days(tables.read_raw(spark, str(tmp_path / "raw")), last, last)
    assert re.search(r"PartitionFilters: \[[^\]]*make_date", plan(one))
    days = one.select("day").distinct().collect()
    assert [r.day for r in days] == [3]


def test_validity_filter_reaches_the_scan(spark, lake):
    text = plan(silver.from_bronze(tables.read_days(spark, lake), AS_OF).select("comfort_index"))
    assert "PushedFilters: [IsNotNull(" in text
    shown = re.search(r"ReadSchema: (\S+)", text)[1]
    assert "firmware_version" not in shown and "record_id" not in shown


def test_gold_shuffles(spark, lake):
    rows = silver.from_bronze(tables.read_days(spark, lake), AS_OF)
    by_device = gold.partials(rows, by_hour=False)
    assert shuffles(gold.device(by_device, AS_OF)) == 1
    assert shuffles(gold.daily(by_device, AS_OF)) == 2
    assert shuffles(gold.hourly(gold.partials(rows), AS_OF)) == 2
    assert shuffles(gold.hourly_approx(rows, AS_OF)) == 1
    for table in (gold.daily(by_device, AS_OF), gold.hourly(gold.partials(rows), AS_OF)):
        assert "Expand" not in plan(table)


def test_partials_carry_only_what_is_used(spark, lake):
    rows = silver.from_bronze(tables.read_days(spark, lake), AS_OF)
    slim = gold.daily(gold.partials(rows, by_hour=False), AS_OF).select("location", "active_hours")
    assert "temperature_sum" not in logical(slim)


def test_bronze_report_expands_groups_not_rows(spark, lake):
    text = plan(bronze.report(tables.read_days(spark, lake)))
    assert text.index("Expand") < text.index("partial_min(bronze_ingestion_time")


def test_every_aggregate_combines_before_its_shuffle(spark, lake):
    rows = tables.read_days(spark, lake)
    for table in (quality.by_device(silver.standardize(rows)), bronze.distribution(rows, "location")):
        assert "partial_count" in plan(table)


def test_sample_is_a_bounded_sort(spark):
    messages = feed.damaged_messages(feed.readings(feed.events(spark, SMALL)))
    assert "TakeOrderedAndProject" in plan(ingest.dead_letter_sample(ingest.dead_letter(messages)))


def test_latest_day_prunes_the_mart(spark, tmp_path):
    mart = catalog._daily_mart(spark, SMALL)
    mart.write.partitionBy("report_date").parquet(str(tmp_path / "mart"))
    text = plan(reports.conditions(spark.read.parquet(str(tmp_path / "mart")), "lab-a", AS_OF))
    assert re.search(r"PartitionFilters: \[[^\]]*subquery", text, re.IGNORECASE)


def test_wide_rows_stay_compiled(spark):
    """No whole-stage method above the size that HotSpot refuses to compile."""
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_late_rows_are_counted_from_the_messages_that_arrived(spark, tmp_path):
    """Not from messages made anew, but for those without an offset, which never arrive."""
    spark.range(44).selectExpr(
        "if(id = 2, null, id) AS event_id",
        "timestamp_ntz'2024-01-01' + make_dt_interval(int(id)) AS ts",
        "id AS user_id", "'view' AS event_type", "1.0D AS value", """'{"k": 1}' AS props""",
    ).write.parquet(f"{tmp_path}/events.parquet")
    found = catalog.queries()["stream_late_rows"](spark, str(tmp_path))
    late = found.selectExpr("dayofyear(window_start) - 1 AS day", "accepted", "held", "late")
    assert sorted(tuple(r) for r in late.collect()) == [(day, 1, 0, 1) for day in (0, 2, 11, 22, 33)]
    scans = [line for line in plan(found).splitlines() if "FileScan" in line and "event_id#" in line]
    assert scans and all("IsNull(event_id)" in line for line in scans)
