"""Dashboard queries over the ``daily_report`` mart.

Each takes the mart, a location (or several) and, where it looks back in time,
the day to look back from. Values are quoted as literals, so no name can break a query.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge import contract as C
from fieldgauge.functions import labels
from fieldgauge.functions.sql import as_date, between, date, first_match, measures, named, one_of


def _tenths(value: str) -> str:
    return f"CAST({value} AS DECIMAL(10, 1))"


def _at(mart: DataFrame, location: str) -> DataFrame:
    return mart.where(one_of("location", [location]))


def _since(mart: DataFrame, as_of, days: int) -> DataFrame:
    """Report dates from ``days`` before ``as_of`` to ``as_of``: plain bounds that prune."""
    last = as_date(as_of)
    first = last - dt.timedelta(days=days)
    return mart.where(f"report_date BETWEEN {date(first)} AND {date(last)}")


def latest(mart: DataFrame, as_of) -> DataFrame:
    """The rows of the last report date up to ``as_of``.

    The date is a scalar subquery, so it prunes partitions when the mart is a
    table cut by ``report_date``.
    """
    known = mart.where(f"report_date <= {date(as_of)}")
    newest = known.agg(F.max("report_date")).scalar()
    return known.where(F.col("report_date") == newest)


def locations_in(mart: DataFrame, locations: list[str], as_of) -> DataFrame:
    return latest(mart, as_of).where(one_of("location", locations)).select("location")


def temperature(mart: DataFrame, location: str, as_of) -> DataFrame:
    shown = {
        "Average Temperature": "avg_temperature",
        "Min Temperature": "min_temperature",
        "Max Temperature": "max_temperature",
        "Temperature Range": "max_temperature - min_temperature",
    }
    return _at(latest(mart, as_of), location).selectExpr(*named(shown))


def irrigation(mart: DataFrame, location: str, as_of, days: int = 7) -> DataFrame:
    mean = "avg(avg_humidity)"
    score = first_match(
        [(between(mean, low, high), str(points)) for low, high, points in C.IRRIGATION_SCORES],
        str(C.LOWEST_IRRIGATION),
    )
    found = {"soil_moisture": _tenths(mean), "irrigation_efficiency": score}
    return _since(_at(mart, location), as_of, days).groupBy("location").agg(*measures(found))


def growing_degree_days(mart: DataFrame, location: str, as_of, days: int = 30) -> DataFrame:
    above = first_match(
        [
            (
                f"avg_temperature > {C.GROWING_BASE_C}",
                _tenths(f"avg_temperature - {C.GROWING_BASE_C}"),
            )
        ],
        _tenths("0"),
    )
    return (
        _since(_at(mart, location), as_of, days)
        .selectExpr(
            "report_date AS date",
            "location",
            f"{_tenths('avg_temperature')} AS daily_avg_temp",
            f"{above} AS growing_degree_days",
        )
        .orderBy(F.desc("date"), "location")
    )


def conditions(mart: DataFrame, location: str, as_of) -> DataFrame:
    shown = {
        "Humidity %": "avg_humidity",
        "Pressure": "avg_pressure",
        "Data Quality": "quality_score",
        "Comfort Level %": "comfort_percentage",
    }
    return _at(latest(mart, as_of), location).selectExpr(*named(shown))


def field_health(mart: DataFrame, location: str, as_of, days: int = 7) -> DataFrame:
    shown = {
        "field_temp": "avg_temperature",
        "soil_moisture": "avg_humidity",
        "atmospheric_pressure": "avg_pressure",
        "growing_conditions_score": "comfort_percentage",
    }
    found = {name: _tenths(f"avg({column})") for name, column in shown.items()}
    return _since(_at(mart, location), as_of, days).groupBy("location").agg(*measures(found))


def location_list(mart: DataFrame) -> DataFrame:
    return mart.select("location").distinct().orderBy("location")


def with_status(panel: str, table: DataFrame, value: str) -> DataFrame:
    """Add the colour a panel shows for ``value``."""
    return table.selectExpr("*", f"{labels.panel_color(panel, value)} AS status")
