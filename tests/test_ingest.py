"""Messages: malformed, incomplete and odd ones."""

import datetime as dt

import samples

from fieldgauge.operators import bronze, ingest
from fieldgauge.sources import tables

BAD = {
    "": "unparseable",
    "   ": "unparseable",
    None: "unparseable",
    "{": "unparseable",
    '{"deviceId": }': "unparseable",
    "not json": "unparseable",
    "null": "missing_device_id",
    "{}": "missing_device_id",
    '{"unknownField":"value"}': "missing_device_id",
    '{"device_id":"x","timestamp":1,"location":"l"}': "missing_device_id",
    '{"temperature": 25.0}': "missing_device_id",
    '{"deviceId":"test"}': "missing_timestamp",
    '{"deviceId":"test","timestamp":"not-a-number"}': "missing_timestamp",
    '{"deviceId":"test","metadata":"not-an-object"}': "missing_timestamp",
    '{"deviceId":"test","timestamp":9223372036854775807}': "missing_timestamp",
    '{"deviceId":"test","timestamp":123}': "missing_location",
}


def test_dead_letter_reasons(spark):
    rows = ingest.dead_letter(samples.envelopes(spark, *BAD, samples.message()))
    found = {r.offset: r for r in rows.collect()}
    assert [found[n].reason for n in range(len(BAD))] == list(BAD.values())
    assert len(found) == len(BAD)
    assert [n for n, r in found.items() if r.misnamed_device_id] == [9]


def test_nothing_is_lost_between_accepted_and_rejected(spark):
    messages = samples.envelopes(spark, *BAD, samples.message())
    accepted = ingest.accept(ingest.parse(messages))
    # a missing location is reported, but the reading goes on and silver rejects it
    kept = [n for n, reason in enumerate(BAD.values()) if reason == "missing_location"]
    assert [r.offset for r in accepted.orderBy("offset").collect()] == [*kept, len(BAD)]


def test_dead_letter_sample_is_small_and_stable(spark):
    rejected = ingest.dead_letter(samples.envelopes(spark, *["{"] * 30))
    assert [r.offset for r in ingest.dead_letter_sample(rejected).collect()] == list(range(10))


def test_wrong_types_null_one_field_only(spark):
    odd = '{"deviceId":"d","temperature":"25.0","motion":"false","humidity":40.5,"timestamp":5000}'
    row = ingest.parse(samples.envelopes(spark, odd)).first()
    assert (row.deviceId, row.temperature, row.motion, row.humidity) == ("d", None, None, 40.5)
    assert str(row.sensor_timestamp) == str(dt.datetime(1970, 1, 1, 0, 0, 5))


def test_long_and_foreign_text_is_kept(spark):
    names = ["x" * 10_000, "センサー-🌡️", 'quo"te\\']
    rows = ingest.parse(samples.envelopes(spark, *(samples.message(deviceId=n) for n in names)))
    assert [r.deviceId for r in rows.orderBy("offset").collect()] == names


def test_seconds_are_read_when_asked_for(spark):
    messages = samples.envelopes(spark, samples.message(timestamp=1640995200))
    parts = ingest.parse(messages, epoch_unit="s", processing_time="current_timestamp()").first()
    assert (parts.year, parts.month, parts.day, parts.hour) == (2022, 1, 1, 0)
    assert parts.processing_time is not None


def test_required_fields(spark):
    wanted = ["deviceId", "deviceType", "location", "value", "timestamp"]
    messages = samples.envelopes(spark, samples.message(), "{", '{"deviceId":null}')
    rows = ingest.required_fields(messages, wanted).orderBy("offset").collect()
    assert [r.missing_fields for r in rows] == [
        "deviceType,value", ",".join(wanted), "deviceType,location,value,timestamp",
    ]
    assert not any(r.is_complete for r in rows)
    assert ingest.required_fields(messages, ["deviceId"]).where("is_complete").count() == 2


def test_record_ids_are_stable_and_positioned(spark):
    twice = samples.envelopes(spark, samples.message(), samples.message())
    parsed = ingest.parse(twice)
    by_text = parsed.selectExpr(ingest.record_id()).distinct().count()
    by_place = parsed.selectExpr(ingest.record_id("topic", "partition", "offset")).distinct()
    assert by_text == 1 and by_place.count() == 2


def test_historical_rows_join_the_contract(spark, tmp_path):
    earlier = tmp_path / "earlier"
    earlier.mkdir()
    (earlier / "a.json").write_text("\n".join(samples.message(deviceId=f"d{n}") for n in range(3)))
    loaded = tables.read_historical(spark, str(earlier))
    assert loaded.count() == 3
    one = tables.read_historical(spark, str(earlier), multiline=True)
    assert one.count() == 1  # the option is for one document per file
    as_of = dt.datetime(2024, 1, 31, 6)
    history = bronze.historical(loaded, as_of)
    row = history.first()
    assert (row.data_source, row.ingestion_job, row.year) == (
        "batch-json", "bronze-batch-job-v1", 2022,
    )
    conformed = bronze.conform(history)
    assert conformed.columns == bronze.from_raw(
        spark.createDataFrame([], tables.C.RAW_SCHEMA), as_of
    ).columns
    full = conformed.orderBy("deviceId").first()
    assert (full.battery_level, full.deviceType, full.raw_hour) == (80, "temperature-sensor", None)
    assert conformed.select("record_id").distinct().count() == 3
