"""Streams: same result as the batch, restarts, late data, replays."""

import datetime as dt

import harness
import pytest
import samples

from fieldgauge import session
from fieldgauge.config import Settings
from fieldgauge.operators import alerts, bronze, ingest, windows
from fieldgauge.plans import stream_job
from fieldgauge.sources import broker, feed, tables
from fieldgauge.streaming import queries as streams

SMALL = str(harness.TESTDATA / "sf0.001")
T0 = 1704067200000  # 2024-01-01 00:00:00


def minute(n, **changes):
    return samples.message(timestamp=T0 + n * 60_000, **changes)


def arrive(spark, path, *values, first_offset=0):
    """One more file of messages in a folder that a stream reads."""
    samples.envelopes(spark, *values, first_offset=first_offset).coalesce(1).write.mode(
        "append"
    ).parquet(str(path))


def rows_of(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_raw_lake_survives_a_restart(spark, tmp_path):
    arrived, lake, at = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "at")
    arrive(spark, arrived, minute(0), "{", minute(1))
    streams.drain(streams.raw_sink(broker.file_stream(spark, str(arrived)), lake, at, streams.DRAIN))
    arrive(spark, arrived, minute(61), first_offset=3)
    for _ in range(2):  # the second run finds nothing new
        source = broker.file_stream(spark, str(arrived))
        streams.drain(streams.raw_sink(source, lake, at, streams.DRAIN))
    rows = tables.read_raw(spark, lake)
    assert rows_of(rows, "year", "month", "day", "hour") == [
        (2024, 1, 1, 0), (2024, 1, 1, 0), (2024, 1, 1, 1),
    ]
    assert rows_of(rows, "value") == sorted((v,) for v in (minute(0), minute(1), minute(61)))


def test_bronze_of_the_stream_is_bronze_of_the_batch(spark, tmp_path):
    lake, at = str(tmp_path / "lake"), str(tmp_path / "at")
    source = feed.messages(feed.readings(feed.event_stream(spark, SMALL)))
    streams.drain(streams.raw_sink(source, lake, at, streams.DRAIN))
    as_of = dt.datetime(2024, 1, 31)
    batch = feed.messages(feed.readings(feed.events(spark, SMALL)))
    direct = bronze.from_raw(ingest.raw_rows(ingest.accept(ingest.parse(batch))), as_of)
    stored = bronze.from_raw(tables.read_raw(spark, lake), as_of)
    assert stored.exceptAll(direct).isEmpty() and direct.exceptAll(stored).isEmpty()


def test_late_readings_are_dropped(spark, tmp_path):
    """Three files in turn: on time, far ahead, and behind the watermark."""
    arrived, out, at = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "at")
    for n, values in enumerate([[minute(1), minute(2)], [minute(40)], [minute(3), minute(39)]]):
        arrive(spark, arrived, *values, first_offset=n * 10)
        source = broker.file_stream(spark, str(arrived), files_per_trigger=1)
        streams.drain(streams.window_sink(source, out, at, streams.DRAIN))
    arrive(spark, arrived, minute(100), first_offset=90)
    source = broker.file_stream(spark, str(arrived))
    streams.drain(streams.window_sink(source, out, at, streams.DRAIN))
    found = spark.read.parquet(out).selectExpr("minute(window_start) AS m", "record_count AS n")
    assert rows_of(found, "m", "n") == [(0, 2), (35, 1), (40, 1)]


def test_late_readings_are_counted_by_window(spark, tmp_path):
    """Windows and late readings add up to what was accepted, also after a restart."""
    arrived, out, at = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "at")
    batches = [[minute(1), minute(2)], [minute(40)], [minute(3), minute(39), minute(11)]]
    for n, values in enumerate(batches):
        arrive(spark, arrived, *values, first_offset=n * 10)
        source = broker.file_stream(spark, str(arrived), files_per_trigger=1)
        streams.drain(streams.window_update_sink(source, out, at, streams.DRAIN))
    accepted = streams.accepted(spark.read.parquet(str(arrived)))
    held = streams.latest_windows(spark, out)
    late = streams.late_counts(accepted, held).selectExpr("minute(window_start) AS m", "accepted", "held", "late")
    assert rows_of(late, "m", "accepted", "held", "late") == [(0, 3, 2, 1), (10, 1, 0, 1)]
    assert held.agg({"record_count": "sum"}).first()[0] + 2 == accepted.count()
    assert streams.late_counts(accepted.limit(0), held).isEmpty()


def test_windows_by_device_folder(spark, tmp_path):
    arrived, out, at = tmp_path / "in", tmp_path / "out", str(tmp_path / "at")
    arrive(spark, arrived, minute(0), minute(0, deviceId="other"), minute(60))
    source = broker.file_stream(spark, str(arrived))
    streams.drain(streams.window_sink(source, str(out), at, streams.DRAIN, ("deviceId",)))
    assert {p.name for p in out.glob("deviceId=*")} == {"deviceId=other", "deviceId=warehouse-a-001"}


def test_window_measures(spark):
    rows = samples.readings(spark, {"temperature": 10.0}, {"temperature": 20.0}, {"humidity": None})
    row = windows.by_window(rows).first()
    assert (row.record_count, row.min_temperature, row.max_temperature) == (3, 10.0, 25.0)
    assert (row.avg_humidity, row.location) == (50.0, "warehouse-a")
    assert row.window_end - row.window_start == dt.timedelta(minutes=5)


def test_alerts_survive_a_restart_and_a_replay(spark, tmp_path):
    arrived, out, at = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "at")
    settings = Settings(recipient="a@example.org", subject_prefix="[Farm]")
    arrive(spark, arrived, minute(0), minute(1, temperature=95.0), minute(2, temperature=None))
    for round_ in range(2):
        source = broker.file_stream(spark, str(arrived))
        streams.drain(streams.alert_sink(source, out, at, settings, streams.DRAIN))
        if round_ == 0:
            arrive(spark, arrived, minute(3, acidity=1.0, battery_level=2), first_offset=3)
    found = streams.alert_table(spark, out)
    assert rows_of(found, "batch_id", "anomaly_types", "status") == [
        (0, "Temperature", "pending"), (1, "Acidity, Low Battery", "pending"),
    ]
    assert found.select("record_id").distinct().count() == 2
    assert found.where("subject LIKE '[Farm] %'").count() == 2
    assert streams.anomaly_table(spark, out).count() == 3
    stats = spark.read.parquet(f"{out}/batch_stats")
    expected = [(0, 3, 1, 1), (1, 1, 2, 1)]
    assert rows_of(stats, "batch_id", "records", "anomalies", "alerts") == expected

    # the batch that ran last is run again, as after a crash before its commit
    again = samples.envelopes(spark, minute(3, acidity=1.0, battery_level=2), first_offset=3)
    readings = ingest.accept(ingest.parse(again)).selectExpr(
        "*", f"{ingest.record_id('topic', 'partition', 'offset')} AS record_id"
    )
    run = found.first().run
    streams.write_alert_batch(readings, 1, out, settings, run)
    assert streams.alert_table(spark, out).count() == 2
    assert spark.read.parquet(f"{out}/batch_stats").count() == 2
    # a stream that begins anew overwrites nothing, and its messages are the same ones
    source = broker.file_stream(spark, str(arrived))
    streams.drain(streams.alert_sink(source, out, str(tmp_path / "anew"), settings, streams.DRAIN))
    both = streams.alert_table(spark, out)
    assert both.select("run").distinct().count() == 2 and both.count() == 4
    assert streams.outbox_state(spark, out).count() == 2


def test_stream_alerts_equal_batch_alerts(spark, tmp_path):
    out, at = str(tmp_path / "out"), str(tmp_path / "at")
    source = feed.messages(feed.readings(feed.event_stream(spark, SMALL)))
    streams.drain(streams.alert_sink(source, out, at, Settings(), streams.DRAIN))
    batch = alerts.alerting(feed.readings(feed.events(spark, SMALL)))
    expected = alerts.messages(batch, Settings().recipient, "[IoT Alert]", ["deviceId"])
    found = streams.alert_table(spark, out).select(*expected.columns)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_several_streams_in_one_session(spark, tmp_path):
    arrived, lake = tmp_path / "in", tmp_path / "lake"
    arrive(spark, arrived, minute(0), minute(1, temperature=95.0), minute(60))
    source = broker.file_stream(spark, str(arrived))
    started = stream_job.start(
        source, str(lake), str(tmp_path / "at"), Settings(), trigger=streams.DRAIN
    )
    streams.supervise(spark)
    spark.streams.resetTerminated()
    for query in started:
        streams.drain(query)
    assert tables.read_raw(spark, str(lake / "raw")).count() == 3
    assert spark.read.parquet(str(lake / "windows")).count() == 1
    assert streams.alert_table(spark, str(lake / "alerting")).count() == 1
    assert {p.name for p in (tmp_path / "at").iterdir()} == set(stream_job.STREAMS)


def test_a_failed_stream_is_raised(spark, tmp_path):
    arrived = tmp_path / "in"
    arrive(spark, arrived, minute(0))
    (tmp_path / "taken").write_text("a file, not a folder")
    source = broker.file_stream(spark, str(arrived))
    with pytest.raises(Exception, match="(?i)taken|directory|STREAM_FAILED"):
        streams.drain(
            streams.alert_sink(
                source, str(tmp_path / "taken"), str(tmp_path / "at"), trigger=streams.DRAIN
            )
        )


def test_flow_counts(spark, tmp_path):
    arrived = tmp_path / "in"
    arrive(spark, arrived, minute(0), "{", "{}")
    path = str(tmp_path / "flow")
    assert streams.flow_counts(spark, path).count() == 0
    query = streams.flow_probe(
        broker.file_stream(spark, str(arrived)), str(tmp_path / "at"), path, streams.DRAIN
    )
    streams.drain(query)
    assert rows_of(streams.flow_counts(spark, path), "batch_id", "received", "accepted") == [(0, 3, 1)]


def test_a_message_delivered_twice_is_stored_and_counted_once(spark, tmp_path):
    """Repeated within a batch, in a later batch and after a restart."""
    arrived, path, at = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "at")
    ledger = streams.ProgressLedger(spark, f"{path}/progress")
    spark.streams.addListener(ledger)
    try:
        for values in ([minute(0), "{"], ["{"], [minute(2), minute(2, deviceId=None)]):
            offset = 1 if values == ["{"] else 0 if len(values[0]) > 1 and values[0] == minute(0) else 2
            arrive(spark, arrived, *values, first_offset=offset)
            query = streams.reject_sink(broker.file_stream(spark, str(arrived)), path, at, streams.DRAIN)
            ledger.wait(streams.drain(query), 300)
    finally:
        spark.streams.removeListener(ledger)
    letters = tables.read_days(spark, f"{path}/dead_letters")
    assert rows_of(letters, "offset", "reason") == [(1, "unparseable"), (3, "missing_device_id")]
    counts = streams.message_counts(spark, path, f"{path}/progress").first()
    assert tuple(counts) == (5, 2, 2, 1, 0)
    assert counts.received == counts.accepted + counts.rejected + counts.repeated


def test_a_reject_batch_run_again_adds_nothing(spark, tmp_path, monkeypatch):
    """The run ends after the letters are stored and before the counts are."""
    arrived, path, at = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "at")
    arrive(spark, arrived, minute(0), "{")

    def stop(*_):
        raise KeyError("stopped")

    with monkeypatch.context() as between, pytest.raises(Exception, match="stopped"):
        between.setattr(tables, "write", stop)
        streams.drain(streams.reject_sink(broker.file_stream(spark, str(arrived)), path, at, streams.DRAIN))
    streams.drain(streams.reject_sink(broker.file_stream(spark, str(arrived)), path, at, streams.DRAIN))
    assert tables.read_days(spark, f"{path}/dead_letters").count() == 1
    # a batch without messages may follow, which only moves the watermark
    counts = spark.read.parquet(f"{path}/counts").where("accepted + rejected > 0")
    assert rows_of(counts, "accepted", "rejected") == [(1, 1)]


def test_sent_messages_are_never_rewritten(spark, tmp_path):
    """Retries with growing pauses, up to a limit; files that exist stay as they are."""
    path, settings = str(tmp_path / "out"), Settings(recipient="a@example.org")
    bad = samples.envelopes(spark, minute(0, temperature=95.0), minute(1, acidity=1.0))
    readings = ingest.accept(ingest.parse(bad)).selectExpr("*", "string(offset) AS record_id")
    streams.write_alert_batch(readings, 0, path, settings, "r")

    def send(recipient, subject, body):
        if "Temperature" in body:
            raise ConnectionError("no route")

    start, tried = dt.datetime(2024, 1, 1, 12), []
    for minutes in range(12):
        before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}
        streams.deliver_due(spark, path, send, start + dt.timedelta(minutes=minutes), max_retries=3)
        assert all(p.stat().st_mtime_ns == t for p, t in before.items())
        state = {r.record_id: r for r in streams.outbox_state(spark, path).collect()}
        tried.append(state["0"].attempts)
    # tries at once, then after one, two and four minutes
    assert tried == [1, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4, 4]
    assert (state["1"].status, state["1"].attempts, state["1"].last_error) == ("sent", 1, None)
    assert (state["0"].status, state["0"].last_error) == ("failed", "ConnectionError: no route")


def test_raw_files_are_few_and_compacted(spark, tmp_path):
    path = str(tmp_path / "raw")
    messages = feed.messages(feed.readings(feed.events(spark, SMALL)))
    rows = ingest.raw_rows(ingest.accept(ingest.parse(messages)))
    day = dt.date(2024, 1, 5)
    for k in range(3):
        assert tables.append_raw(rows.where(f"hour % 3 = {k}"), path, f"run/{k}")
    assert not tables.append_raw(rows.where("hour % 3 = 0"), path, "run/0")
    one = tables.read_raw(spark, path, day, day)
    assert len(one.inputFiles()) == 3
    assert all("event_date=2024-01-05" in name for name in one.inputFiles())
    expected = tables.raw_days(rows, day, day).count()
    assert tables.compact_raw(spark, path, day, day) == 1 and tables.compact_raw(spark, path, day, day) == 0
    again = tables.read_raw(spark, path, day, day)
    assert len(again.inputFiles()) == 1 and again.count() == expected == one.count()
    assert tables.read_raw(spark, path).count() == rows.count()
    # a batch whose day was compacted is still known
    assert not tables.append_raw(rows.where("hour % 3 = 1"), path, "run/1")
    assert tables.read_raw(spark, str(tmp_path / "none")).count() == 0


def test_kafka_options():
    found = broker.kafka_options("b:9092", "t", "g", "latest", max_offsets_per_trigger=1000)
    assert found["subscribe"] == "t" and found["startingOffsets"] == "latest"
    assert found["failOnDataLoss"] == "true" and found["minPartitions"] == "3"
    assert found["maxOffsetsPerTrigger"] == "1000" and found["kafka.group.id"] == "g"
    assert "minPartitions" not in broker.kafka_options("b", "t", min_partitions=None)


def test_scratch_is_in_the_shared_folder(spark):
    assert session.scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.scratch(spark, "x") != session.scratch(spark, "x")


def test_checkpoint_must_be_named(monkeypatch):
    monkeypatch.delenv("SPARK_CHECKPOINT_LOCATION", raising=False)
    with pytest.raises(ValueError, match="SPARK_CHECKPOINT_LOCATION"):
        stream_job.main(["--lake", "/nowhere"])


def test_each_run_of_a_stream_is_waited_for(spark, tmp_path):
    """The end of an earlier run of the same checkpoint is not that of this one."""
    from types import SimpleNamespace

    ledger = streams.ProgressLedger(spark, str(tmp_path))
    first, second = (SimpleNamespace(id="stream", runId=run) for run in ("first", "second"))
    ledger.onQueryStarted(first)
    ledger.onQueryTerminated(first)
    ledger.wait(first, 1)
    ledger.onQueryStarted(second)
    with pytest.raises(TimeoutError):
        ledger.wait(second, 0.01)
    ledger.onQueryTerminated(second)
    ledger.wait(second, 1)
