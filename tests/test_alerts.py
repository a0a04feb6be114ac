"""Threshold rules, alert text and delivery."""

import random

import pytest
import samples

from fieldgauge.config import ConfigError, Settings, Thresholds
from fieldgauge.operators import alerts
from fieldgauge.plans.catalog import NARROW

INF = float("inf")


def kinds(spark, thresholds, *changes):
    """Anomaly types per case, in rule order."""
    rows = alerts.alerting(samples.readings(spark, *changes), thresholds)
    found = {r.case: [a.type for a in r.anomalies] for r in rows.collect()}
    return [found.get(n, []) for n in range(len(changes))]


def test_normal_reading_is_quiet(spark):
    assert kinds(spark, Thresholds(), {}) == [[]]


@pytest.mark.parametrize(
    ("name", "field", "kind", "low", "high"),
    [
        ("temperature", "temperature", "Temperature", 10.0, 30.0),
        ("humidity", "humidity", "Humidity", 20.0, 80.0),
        ("pressure", "pressure", "Pressure", 1000.0, 1020.0),
        ("light", "light", "Light", 100.0, 900.0),
        ("acidity", "acidity", "Acidity", 6.0, 8.0),
    ],
)
def test_each_range(spark, name, field, kind, low, high):
    limits = Thresholds(**{name: (low, high)})
    cases = [low - 0.1, low, (low + high) / 2, high, high + 0.1, None, float("nan"), INF, -INF]
    found = kinds(spark, limits, *({field: v} for v in cases))
    assert found == [[kind], [], [], [], [kind], [], [], [kind], [kind]]


def test_battery_limit_is_strict(spark):
    found = kinds(spark, Thresholds(battery_low=25), *({"battery_level": v} for v in (24, 25, None)))
    assert found == [["Low Battery"], [], []]


def test_missing_metrics_do_not_hide_others(spark):
    nothing = {n: None for n in ("temperature", "humidity", "pressure", "light", "acidity",
                                 "motion", "battery_level")}
    found = kinds(spark, Thresholds(), nothing, {**nothing, "humidity": 105.0})
    assert found == [[], ["Humidity"]]


def test_several_at_once_in_rule_order(spark):
    assert kinds(
        spark, Thresholds(), {"temperature": 95.0, "pressure": 850.0, "battery_level": 15}
    ) == [["Temperature", "Pressure", "Low Battery"]]
    limits = Thresholds(temperature=(10.0, 30.0), humidity=(20.0, 80.0), pressure=(1000.0, 1020.0))
    four = {"temperature": 5.0, "humidity": 90.0, "pressure": 990.0, "battery_level": 15}
    assert kinds(spark, limits, four) == [["Temperature", "Humidity", "Pressure", "Low Battery"]]


def test_narrow_limits_give_exactly_four(spark):
    reading = {"temperature": 25.1, "humidity": 39.9, "pressure": 1000.0, "light": 500.0,
               "acidity": 8.1, "battery_level": 49}
    assert kinds(spark, NARROW, reading) == [["Temperature", "Humidity", "Acidity", "Low Battery"]]


def test_known_count_in_many_readings(spark):
    breaking = [{"temperature": 150.0}, {"humidity": 150.0}, {"pressure": 500.0}]
    cases = []
    for case in range(200):
        chosen = random.Random(case).sample(breaking, case % 4)
        cases.append({k: v for one in chosen for k, v in one.items()})
    assert [len(found) for found in kinds(spark, Thresholds(), *cases)] == [
        case % 4 for case in range(200)
    ]


def test_texts(spark):
    limits = Thresholds(temperature=(10.0, 30.0))
    reading = {"temperature": 5.0, "humidity": 105.25, "pressure": 850.0, "light": 2e6,
               "acidity": 2.0, "battery_level": 15}
    found = alerts.anomalies(alerts.alerting(samples.readings(spark, reading), limits), ["case"])
    assert {r.anomaly_type: (r.value, r.threshold) for r in found.collect()} == {
        "Temperature": ("5.0°C", "10.0°C to 30.0°C"),
        "Humidity": ("105.3%", "0.0% to 100.0%"),
        "Pressure": ("850.0 hPa", "900.0 to 1100.0 hPa"),
        "Light": ("2000000.0 lux", "0.0 to 1000.0 lux"),
        "Acidity": ("2.0 pH", "4.0 to 10.0 pH"),
        "Low Battery": ("15%", "> 20%"),
    }


def test_halves_round_up(spark):
    rows = alerts.alerting(samples.readings(spark, {"temperature": 95.25}, {"temperature": 95.35}))
    assert [r.anomalies[0].value for r in rows.orderBy("case").collect()] == ["95.3°C", "95.4°C"]


def test_message(spark):
    found = alerts.alerting(samples.readings(spark, {}, {"temperature": 95.0, "battery_level": 3}))
    rows = alerts.messages(found, "o'neil@example.org", "[Farm]", ["case"]).collect()
    assert len(rows) == 1
    mail = rows[0]
    assert mail.recipient == "o'neil@example.org"
    assert mail.subject == "[Farm] Anomaly detected in warehouse-a-001 at warehouse-a"
    assert mail.body == (
        "Device: warehouse-a-001\nLocation: warehouse-a\nTimestamp: 2022-01-01 00:00:00\n\n"
        "Anomalies detected:\n"
        "- Temperature: 95.0°C (threshold: -10.0°C to 80.0°C)\n"
        "- Low Battery: 3% (threshold: > 20%)\n\n"
        "Please investigate this issue immediately.\n\n---\nIoT Monitoring System"
    )


def test_types_and_time(spark):
    found = alerts.alerting(samples.readings(spark, {"temperature": 95.0, "acidity": 1.0}))
    row = alerts.types(found, "current_timestamp()").first()
    assert row.anomaly_types == "Temperature, Acidity" and row.alert_timestamp is not None


def test_simple_range(spark):
    cases = [{}, {"temperature": 35.0}, {"temperature": 35.1}, {"humidity": 19.9},
             {"pressure": 1040.1}, {"pressure": 1000.0}, {"temperature": None}]
    rows = alerts.simple_range(samples.readings(spark, *cases))
    assert sorted(r.case for r in rows.collect()) == [2, 3, 4]


def test_stats(spark):
    rows = samples.readings(spark, {}, {"temperature": 95.0, "acidity": 1.0}, {"light": None})
    row = alerts.batch_stats(rows.selectExpr("*", "7 AS batch"), "batch").first()
    assert (row.batch, row.records, row.anomalies, row.alerts) == (7, 3, 2, 1)


# -- delivery --------------------------------------------------------------


def outbox(spark, n=3):
    found = alerts.alerting(samples.readings(spark, *[{"temperature": 95.0}] * n))
    return alerts.outbox(alerts.messages(found, "a@example.org", "[IoT Alert]", ["case"]))


def test_delivery_keeps_failures_apart(spark, tmp_path):
    box, log = outbox(spark), tmp_path / "log"

    def send(recipient, subject, body):
        with open(log, "a") as out:
            out.write(recipient + "\n")
        if log.read_text().count("\n") == 2:
            raise ConnectionError("Network connection failed")

    box.coalesce(1).write.parquet(str(tmp_path / "0"))
    alerts.deliver(spark.read.parquet(str(tmp_path / "0")), send).write.parquet(str(tmp_path / "1"))
    done = spark.read.parquet(str(tmp_path / "1"))
    assert done.columns == box.columns
    assert sorted(r.status for r in done.collect()) == ["failed", "sent", "sent"]
    assert {r.last_error for r in done.collect()} == {
        None, "ConnectionError: Network connection failed",
    }


def test_first_try_and_three_retries(spark, tmp_path):
    def refuse(recipient, subject, body):
        raise TimeoutError("busy")

    outbox(spark, 1).write.parquet(str(tmp_path / "0"))
    for n in range(6):
        version = spark.read.parquet(str(tmp_path / str(n)))
        alerts.deliver(version, refuse, max_retries=3).write.parquet(str(tmp_path / str(n + 1)))
    row = spark.read.parquet(str(tmp_path / "6")).first()
    assert (row.attempts, row.status) == (4, "failed")


# -- settings --------------------------------------------------------------


def test_settings_from_the_environment():
    env = {"KAFKA_TOPIC": "t", "SPARK_PROCESSING_TIME_SECONDS": "5", "EMAIL_SUBJECT_PREFIX": "[x]"}
    found = Settings.from_env(env, recipient="me@example.org")
    assert (found.kafka_topic, found.trigger_seconds, found.subject_prefix) == ("t", 5, "[x]")
    assert found.recipient == "me@example.org"
    assert found.kafka_servers == Settings().kafka_servers


def test_bad_settings_are_named():
    with pytest.raises(ConfigError, match="SPARK_PROCESSING_TIME_SECONDS"):
        Settings.from_env({"SPARK_PROCESSING_TIME_SECONDS": "soon"})
    with pytest.raises(ConfigError, match="SPARK_PROCESSING_TIME_SECONDS"):
        Settings.from_env({"SPARK_PROCESSING_TIME_SECONDS": "0"})
    with pytest.raises(ConfigError, match="humidity"):
        Thresholds(humidity=(9.0, 1.0))


def test_limits_from_json():
    found = Thresholds.from_json('{"temperature": [10, 30], "battery_low": 25}')
    assert (found.temperature, found.battery_low) == ((10, 30), 25)
    assert found.humidity == Thresholds().humidity
    for bad in ("[]", "{", '{"wind": [1, 2]}', '{"light": 5}', '{"battery_low": "low"}'):
        with pytest.raises(ConfigError):
            Thresholds.from_json(bad)


def test_default_limits_are_ordered():
    limits = Thresholds()
    for name in ("temperature", "humidity", "pressure", "light", "acidity"):
        low, high = getattr(limits, name)
        assert low < high
