"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.functions import rules
from fieldgauge.functions.sql import named


def flag_rules(rows: DataFrame) -> DataFrame:
    """Add the ten rule flags, their conjunction and the share passed."""
    return rows.selectExpr("*", *named(rules.rule_columns()))


def flag_first_failure(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("*", f"{rules.first_failure()} AS data_quality_flag")


def counts():
    """The two counts a report is made of, for ``agg`` or ``observe``."""
    return (
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.expr(rules.all_rules())).alias("valid_records"),
    )


def grade_counts(counted: DataFrame) -> DataFrame:
    """Report rows from (total_records, valid_records): shares and a grade.

    An empty input has score 0.0, and no percentages or grade.
    """
    share = "try_divide(double(valid_records), double(total_records))"
    lost = "try_divide(double(total_records - valid_records), double(total_records))"
    return counted.selectExpr(
        "*",
        "total_records - valid_records AS invalid_records",
        f"coalesce({share}, 0.0D) AS quality_score",
        f"round({share} * 100, 2) AS valid_percentage",
        f"round({lost} * 100, 2) AS invalid_percentage",
        f"CASE WHEN total_records > 0 THEN {rules.grade(f'{share} * 100')} END AS grade",
    )


def report(standardized: DataFrame) -> DataFrame:
    """One row over all rows, before the valid-row filter, in one pass."""
    return grade_counts(standardized.agg(*counts()))


def by_device(standardized: DataFrame) -> DataFrame:
    """Real score per device and day, taken before invalid rows are dropped."""
    score = F.expr(rules.rule_score())
    return standardized.groupBy("event_date", "deviceId", "deviceType", "location").agg(
        *counts(),
        F.avg(score).alias("avg_quality_score"),
        F.min(score).alias("min_quality_score"),
    )


def silver_summary(silver: DataFrame) -> DataFrame:
    """Rows and distinct devices; devices are reduced map-side first."""
    return (
        silver.groupBy("deviceId")
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
            F.count("deviceId").alias("unique_devices"),
        )
    )
