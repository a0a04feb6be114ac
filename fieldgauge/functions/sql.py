"""Small helpers to write expressions as SQL text from tables of values.

Text reaches the JVM in one call, where the same expression built column by
column takes a call per operator.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column
from pyspark.sql import functions as F


_ESCAPES = str.maketrans(
    {
        "\\": "\\\\",
        "'": "\\'",
        "\n": "\\n",
        "$": "\\u0024",  # else ${name} would be replaced by a setting of that name
    }
)


def text(value: str) -> str:
    return f"'{value.translate(_ESCAPES)}'"


def number(value: float) -> str:
    """A literal; floats as DOUBLE, because ``1.0`` alone is a decimal."""
    if isinstance(value, int):
        return str(value)
    if math.isfinite(value):
        return f"{value!r}D"
    return f"double('{value}')"


def date(day: dt.date | str) -> str:
    return f"DATE '{as_date(day).isoformat()}'"


def timestamp(time: dt.datetime) -> str:
    """A point in time in the session zone, which is UTC; naive values are UTC."""
    if time.tzinfo is not None:
        time = time.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return f"TIMESTAMP '{time.isoformat(sep=' ')}'"


def as_date(day: dt.date | str) -> dt.date:
    """A calendar day, without its time of day."""
    if isinstance(day, dt.datetime):
        return day.date()
    if isinstance(day, dt.date):
        return day
    return dt.date.fromisoformat(day)


def one_of(name: str, values) -> str:
    listed = ", ".join(text(v) if isinstance(v, str) else number(v) for v in values)
    return f"{name} IN ({listed})"


def between(name: str, low: float, high: float) -> str:
    return f"{name} BETWEEN {number(low)} AND {number(high)}"


def first_match(cases: list[tuple[str, str]], rest: str | None = None) -> str:
    """The value of the first case that holds, else ``rest`` or null."""
    branches = " ".join(f"WHEN {condition} THEN {value}" for condition, value in cases)
    return f"CASE {branches} {'' if rest is None else 'ELSE ' + rest} END"


def every(conditions) -> str:
    return " AND ".join(f"({c})" for c in conditions)


def some(conditions) -> str:
    return " OR ".join(f"({c})" for c in conditions)


def measures(columns: dict[str, str]) -> list[Column]:
    """``agg`` items for {name: aggregate}."""
    return [F.expr(item) for item in named(columns)]


def named(columns: dict[str, str]) -> list[str]:
    """``selectExpr`` items for {name: expression}."""
    return [f"{expression} AS `{name}`" for name, expression in columns.items()]
