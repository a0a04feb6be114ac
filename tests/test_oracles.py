"""Every registered query against its SQL, and the pinned counts."""

import harness
import pytest

import __spark_entry__ as entry_module
from fieldgauge.operators import gold
from fieldgauge.plans import catalog, oracles

SMALL, MIDDLE = str(harness.TESTDATA / "sf0.001"), str(harness.TESTDATA / "sf0.01")
QUERIES, SQL = catalog.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return harness.duck(SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, con, name):
    frame = QUERIES[name](spark, SMALL)
    if name in SQL:
        assert harness.differences(frame, con, SQL[name]) == ""
    else:
        assert frame.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(SQL) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def counts(spark, name, *keys):
    rows = QUERIES[name](spark, MIDDLE).groupBy(*keys).count().collect()
    return {row[keys[0]]: row["count"] for row in rows}


# Computed over all of sf0.01 in two engines when the feed was defined.
def test_pinned_anomalies(spark):
    assert counts(spark, "alert_anomalies", "anomaly_type") == {
        "Temperature": 244,
        "Humidity": 186,
        "Pressure": 164,
        "Light": 347,
        "Acidity": 2436,
        "Low Battery": 1420,
    }
    assert QUERIES["alert_readings"](spark, MIDDLE).count() == 4102


def test_pinned_silver(spark):
    silver = catalog._silver(spark, MIDDLE).cache()
    assert silver.count() == 9493

    def dist(column):
        return {r[0]: r[1] for r in silver.groupBy(column).count().collect()}

    assert dist("temperature_category") == {
        "cold": 2783, "comfortable": 1685, "freezing": 930, "hot": 2408, "warm": 1687,
    }
    assert dist("comfort_index") == {"good": 1242, "optimal": 410, "poor": 7841}
    assert dist("device_health_status") == {"critical": 400, "good": 5608, "warning": 3485}
    silver.unpersist()


def test_pinned_windows(spark):
    rows = QUERIES["window_agg_batch"](spark, MIDDLE)
    assert rows.agg({"record_count": "sum"}).first()[0] == 10000
    assert rows.count() == 9963


def test_estimated_devices_are_close(spark):
    key = ["event_date", "hour_of_day", "location", "deviceType"]
    exact = QUERIES["gold_hourly"](spark, MIDDLE).select(*key, "unique_devices")
    guessed = gold.hourly_approx(catalog._silver(spark, MIDDLE), catalog.AS_OF)
    near = guessed.selectExpr(*key, "unique_devices AS near")
    joined = exact.join(near, key)
    off = joined.selectExpr("count(*) AS n", "max(abs(near - unique_devices)) AS worst").first()
    assert off.n == exact.count() and off.worst <= 1  # a few devices per hour


def test_estimate_of_many_devices(spark):
    rows = spark.range(60000).selectExpr(
        "DATE '2024-01-01' AS event_date", "0 AS hour_of_day", "'l' AS location",
        "'t' AS deviceType", "string(id % 20000) AS deviceId", "1.0D AS temperature",
        "1.0D AS humidity", "1.0D AS pressure", "1.0D AS light", "1.0D AS acidity",
        "true AS motion", "1.0D AS data_quality_score",
    )
    found = gold.hourly_approx(rows, catalog.AS_OF, rsd=0.02).first()
    assert abs(found.unique_devices - 20000) <= 0.06 * 20000  # three standard deviations


def test_sketches_of_many_devices_add_up(spark):
    """Two days that share a third of their devices: the union, not the sum."""
    rows = spark.range(60000).selectExpr(
        "date_add(DATE '2024-01-01', int(id % 2)) AS event_date", "int(id % 24) AS hour_of_day",
        "'l' AS location", "'t' AS deviceType",
        "string(if(id % 2 = 0, id % 20000, 10000 + id % 20000)) AS deviceId", "1L AS readings",
    )
    stored = gold.sketches(rows)
    exact = rows.selectExpr("count(DISTINCT deviceId)").first()[0]
    found = gold.devices(stored, "location").first()
    assert abs(found.devices - exact) <= 3 * gold.SKETCH_ERROR * exact
    assert found.readings == 60000
    by_day = {r.event_date.day: r.devices for r in gold.devices(stored, "event_date").collect()}
    assert all(abs(n - 10000) <= 300 * 3 * gold.SKETCH_ERROR * 100 for n in by_day.values())
