"""The feeds beside the usual one reach the branches that it does not."""

import datetime as dt

import harness
import pytest

from fieldgauge import contract as C
from fieldgauge.plans import catalog

SMALL = str(harness.TESTDATA / "sf0.001")


def values(spark, name, column):
    return {r[0] for r in catalog.queries()[name](spark, SMALL).select(column).distinct().collect()}


def test_all_labels_occur(spark):
    assert values(spark, "gold_device_health", "device_health") == {
        "excellent", "good", "acceptable", "needs_attention",
    }
    assert values(spark, "silver_calendar_year", "season") == {"winter", "spring", "summer", "autumn"}
    assert values(spark, "quality_flag_broken", "data_quality_flag") == {
        "VALID", "INVALID_TEMP", "INVALID_HUMIDITY", "INVALID_PRESSURE",
    }


def test_all_rules_but_the_defaulted_one_are_broken(spark):
    rows = catalog.queries()["silver_rule_flags_broken"](spark, SMALL)
    broken = rows.selectExpr(*(f"count_if(NOT {name}_valid) AS {name}" for name in C.RULES)).first().asDict()
    assert {name for name, n in broken.items() if n == 0} == {"deviceType"}
    assert rows.where("is_valid_record AND data_quality_score < 1").isEmpty()
    assert rows.where("NOT is_valid_record AND data_quality_score = 1").isEmpty()


@pytest.mark.parametrize(
    ("month", "season"),
    [(1, "winter"), (2, "winter"), (3, "spring"), (5, "spring"), (6, "summer"), (8, "summer"), (9, "autumn"),
     (11, "autumn"), (12, "winter")],
)
def test_season_of_the_month(spark, month, season):
    from fieldgauge.functions import labels

    row = spark.createDataFrame([(dt.datetime(2024, month, 1),)], "t timestamp")
    assert row.selectExpr(f"{labels.season('t')} AS s").first().s == season
