"""Targets for the serving marts: a database or Parquet files."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldgauge.sources import versions


class Target(Protocol):
    # True if a mart is replaced day by day, False if as a whole
    by_day: bool

    def replace(self, name: str, day: str, rows: DataFrame) -> int:
        """Replace the named mart, or its days; ``day`` is the column that holds them.

        Returns the rows written.
        """


def _counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows in the stage that writes them, where no row is seen twice."""
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("n")), seen


@dataclass(frozen=True)
class ParquetTarget:
    """Marts as versioned Parquet tables cut by report date.

    With ``days`` a mart is made to hold exactly the rows given for those days; without,
    the days that rows have are replaced.
    """

    path: str
    days: tuple | None = None
    by_day = True

    def covering(self, first, last) -> ParquetTarget:
        """The same target for a run over some days."""
        return replace(self, days=(first, last))

    def replace(self, name: str, day: str, rows: DataFrame | None) -> int:
        spark = SparkSession.active()
        if rows is not None:
            rows = rows.withColumn("report_date", F.to_date(day)).hint("rebalance", "report_date")
        first, last = self.days or rows.select(F.min("report_date"), F.max("report_date")).first()
        if first is None:
            return 0
        count = F.count(F.lit(1)).alias("n")
        seen = versions.replace_days(
            spark, rows, self.table(name), ("report_date",), first, last, count, day="report_date"
        )
        return seen.get("n", 0)

    def table(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame | None:
        return versions.read(spark, self.table(name), day="report_date")


@dataclass(frozen=True)
class JdbcTarget:
    """Overwrite tables through JDBC.

    ``connections`` bounds how many tasks write at once. The table is emptied,
    not dropped, so grants and indexes stay.
    """

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    connections: int = 8
    batch_size: int = 10_000
    by_day = False

    def options(self, name: str) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": name,
            "truncate": "true",
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_size),
            **self.properties,
        }

    def replace(self, name: str, day: str, rows: DataFrame) -> int:
        counted, seen = _counted(rows)
        counted.write.format("jdbc").options(**self.options(name)).mode("overwrite").save()
        return seen.get["n"]
