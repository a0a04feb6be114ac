"""Whole jobs: older days in whole-table targets, flow counts of many batches, all alert rules."""

import datetime as dt

import harness
import pytest
import samples

from fieldgauge.operators import export, ingest
from fieldgauge.plans import catalog, daily_job, oracles
from fieldgauge.sources import broker, feed, tables
from fieldgauge.streaming import queries as streams

SMALL = str(harness.TESTDATA / "sf0.001")
AS_OF = dt.datetime(2024, 3, 31, 6)


def test_whole_table_target_keeps_days_of_more_than_a_month_ago(spark, tmp_path):
    lake = daily_job.Lake(str(tmp_path / "lake"))
    old, new = dt.date(2024, 1, 1), dt.date(2024, 3, 15)
    messages = feed.messages(feed.readings(feed.events(spark, SMALL)))
    rows = tables.raw_days(ingest.raw_rows(ingest.accept(ingest.parse(messages))), old, old)
    tables.write_raw(rows, lake.raw)
    seen = {}

    class Whole:
        by_day = False

        def replace(self, name, day, rows):
            seen[name] = {r[0] for r in rows.selectExpr(f"to_date({day})").collect()}
            return 1

    daily_job.run(spark, lake, old, old, AS_OF, Whole())
    silver = tables.read_days(spark, lake.silver)
    assert {d for days in seen.values() for d in days} == {old} and silver.count() > 0
    # a later day, put into raw by moving the readings' time
    later = int((new - old).days) * 86_400_000
    moved = rows.selectExpr(
        *[c for c in rows.columns if c not in ("value", "year", "month", "day")],
        f"regexp_replace(value, '\"timestamp\":\\\\s*[0-9]+', concat('\"timestamp\":', "
        f"string(bigint(get_json_object(value, '$.timestamp')) + {later}))) AS value",
        "2024 AS year", "3 AS month", "15 AS day",
    ).select(*rows.columns)
    tables.write_raw(moved, lake.raw)
    daily_job.run(spark, lake, new, new, AS_OF, Whole())
    assert set(seen) == {export.TIMESERIES, export.DAILY, export.DEVICES}
    assert all(days == {old, new} for days in seen.values()), seen


def test_flow_counts_of_more_batches_than_the_query_remembers(spark, tmp_path):
    arrived, at, path = tmp_path / "in", str(tmp_path / "at"), str(tmp_path / "flow")
    for k in range(5):
        samples.envelopes(spark, samples.message(), "{", first_offset=2 * k).coalesce(1).write.mode(
            "append"
        ).parquet(str(arrived))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        source = broker.file_stream(spark, str(arrived), files_per_trigger=1)
        streams.drain(streams.flow_probe(source, at, path, streams.DRAIN))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    found = streams.flow_counts(spark, path).select("batch_id", "received", "accepted").collect()
    assert sorted(map(tuple, found)) == [(k, 2, 1) for k in range(5)]


@pytest.mark.parametrize("name", ["alert_messages", "stream_alerts"])
def test_messages_have_all_six_rules(spark, name):
    frame = catalog.queries()[name](spark, SMALL).cache()
    assert frame.where("body LIKE '%- Light: %'").count() > 0
    assert harness.differences(frame, harness.duck(SMALL), oracles.oracle_sql()[name]) == ""
