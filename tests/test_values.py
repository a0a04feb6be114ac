"""Edges of bands, rules, time and calendar."""

import datetime as dt

import pytest
import samples

from fieldgauge import contract as C
from fieldgauge.functions import clock, labels, rules
from fieldgauge.functions.sql import number, text
from fieldgauge.operators import bronze, quality, silver

AS_OF = dt.datetime(2024, 1, 31)


def labelled(spark, bands, values, mode="reference"):
    rows = spark.createDataFrame([(v,) for v in values], f"{bands.metric} double")
    return [r[0] for r in rows.selectExpr(labels.band(bands, mode)).collect()]


@pytest.mark.parametrize(
    ("bands", "expected"),
    [
        (
            C.TEMPERATURE_BANDS,
            {-0.1: "freezing", 0: "cold", 15: "cold", 15.5: "hot", 16: "comfortable",
             25: "comfortable", 25.5: "hot", 26: "warm", 35: "warm", 35.1: "hot", None: "hot"},
        ),
        (
            C.HUMIDITY_BANDS,
            {29.9: "dry", 30: "comfortable", 60: "comfortable", 60.5: "very_humid", 61: "humid",
             80: "humid", 80.1: "very_humid"},
        ),
        (C.PRESSURE_BANDS, {999.9: "low", 1000: "normal", 1025: "normal", 1025.1: "high"}),
        (
            C.LIGHT_BANDS,
            {0.9: "dark", 1: "dim", 50: "dim", 50.5: "very_bright", 51: "indoor", 500: "indoor",
             501: "bright", 10000: "bright", 10000.1: "very_bright"},
        ),
        (
            C.ACIDITY_BANDS,
            {2.9: "very_acidic", 3: "acidic", 6: "acidic", 6.1: "neutral", 8: "neutral",
             8.1: "basic", 11: "basic", 11.1: "very_basic"},
        ),
    ],
)
def test_band_edges(spark, bands, expected):
    assert labelled(spark, bands, map(_double, expected)) == list(expected.values())


def _double(value):
    return None if value is None else float(value)


def test_contiguous_bands_close_the_gaps(spark):
    assert labelled(spark, C.TEMPERATURE_BANDS, [15.5, 25.5, 35.0, 35.1], "contiguous") == [
        "cold", "comfortable", "warm", "hot",
    ]
    assert labelled(spark, C.ACIDITY_BANDS, [6.0, 8.0, 11.1], "contiguous") == [
        "acidic", "neutral", "very_basic",
    ]
    with pytest.raises(ValueError):
        labels.band(C.LIGHT_BANDS, "smooth")


def test_event_time(spark):
    cases = [
        (1704067207179, dt.datetime(2024, 1, 1, 0, 0, 7)),
        (-1, dt.datetime(1970, 1, 1)),
        (-1001, dt.datetime(1969, 12, 31, 23, 59, 59)),
        (None, None),
        (2**63 - 1, None),
        (-(2**63), None),
    ]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, e long")
    found = rows.selectExpr("i", f"string({clock.event_time('e')}) AS t").orderBy("i").collect()
    assert [r.t for r in found] == [None if c[1] is None else str(c[1]) for c in cases]
    seconds = rows.where("i = 0").selectExpr(f"string({clock.event_time('e div 1000', 's')})")
    assert seconds.first()[0] == "2024-01-01 00:00:07"
    with pytest.raises(ValueError):
        clock.event_time("e", "us")


def test_rules_at_their_edges(spark):
    inside = [{"temperature": -50.0}, {"temperature": 100.0}, {"humidity": 0.0},
              {"pressure": 500.0}, {"pressure": 1500.0}, {"light": 100000.0}, {"acidity": 14.0}]
    outside = [{"temperature": -50.1}, {"humidity": 100.1}, {"pressure": 499.9},
               {"light": -0.1}, {"acidity": 14.1}, {"temperature": float("nan")},
               {"pressure": float("inf")}, {"temperature": None}, {"motion": None},
               {"deviceId": ""}, {"location": None}]
    rows = bronze.stamp(samples.readings(spark, *inside, *outside), AS_OF)
    flagged = quality.flag_rules(rows.drop("sensor_timestamp").selectExpr(
        "*", f"{clock.event_time('timestamp')} AS sensor_timestamp"
    ))
    found = flagged.orderBy("case").select("is_valid_record", "data_quality_score").collect()
    assert [r[0] for r in found] == [True] * len(inside) + [False] * len(outside)
    assert {r[1] for r in found[: len(inside)]} == {1.0}
    assert {r[1] for r in found[len(inside) :]} == {0.9}


def test_silver_constants_match_the_rules(spark):
    """What silver writes as constants is what the rules give for those rows."""
    rows = bronze.stamp(
        samples.readings(spark, {}, {"humidity": 500.0}).selectExpr("*", "'x' AS record_id"), AS_OF
    )
    standard = silver.standardize(rows)
    names = list(rules.rule_columns())
    computed = quality.flag_rules(standard).where("is_valid_record").select(*names).collect()
    assert silver.from_standard(standard, AS_OF).select(*names).collect() == computed
    assert len(computed) == 1


def test_first_failure_order(spark):
    rows = samples.readings(
        spark, {}, {"temperature": None, "humidity": None}, {"humidity": -1.0, "pressure": -1.0},
        {"pressure": None}, {"pressure": 90000.0}, {"temperature": 100.1},
    )
    found = quality.flag_first_failure(rows).orderBy("case").collect()
    assert [r.data_quality_flag for r in found] == [
        "VALID", "INVALID_TEMP", "INVALID_HUMIDITY", "INVALID_PRESSURE", "VALID", "INVALID_TEMP",
    ]


@pytest.mark.parametrize(
    ("total", "valid", "grade"),
    [(100, 95, "EXCELLENT"), (1000, 949, "GOOD"), (100, 90, "GOOD"), (100, 80, "ACCEPTABLE"),
     (1000, 799, "POOR"), (0, 0, None)],
)
def test_grades(spark, total, valid, grade):
    counted = spark.createDataFrame([(total, valid)], "total_records long, valid_records long")
    row = quality.grade_counts(counted).first()
    assert row.grade == grade and row.invalid_records == total - valid
    assert row.quality_score == (valid / total if total else 0.0)


def test_report_of_nothing(spark):
    rows = silver.standardize(
        bronze.stamp(samples.readings(spark, {}).selectExpr("*", "'x' AS record_id"), AS_OF)
    )
    row = quality.report(rows.where("false")).first()
    assert (row.total_records, row.valid_records, row.quality_score) == (0, 0, 0.0)


def test_condition_with_unknown_sides(spark):
    rows = spark.createDataFrame(
        [(True, True), (True, None), (None, None), (False, True), (False, False)],
        "b boolean, s boolean",
    )
    found = [r[0] for r in rows.selectExpr(labels.condition("b", "s")).collect()]
    assert found == ["critical", "warning", "good", "warning", "good"]


def test_device_type_prefixes(spark):
    rows = spark.createDataFrame([("warehouse-9",), ("field",), ("lab",), (None,)], "l string")
    assert [r[0] for r in rows.selectExpr(labels.device_type("l")).collect()] == [
        "temperature-sensor", "environmental-sensor", "iot-sensor", "iot-sensor",
    ]


def test_literals_survive_quoting(spark):
    odd = "it's \\ a\n\"line\" ${x} %s"
    assert spark.range(1).selectExpr(text(odd)).first()[0] == odd
    assert spark.range(1).selectExpr(number(float("-inf"))).first()[0] == float("-inf")
    assert spark.range(1).selectExpr(number(1e-7)).first()[0] == 1e-7
