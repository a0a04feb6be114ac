"""Threshold rules and alert wording, as SQL text.

A missing metric is skipped on its own. NaN is no anomaly, although Spark sorts
it above every number; an infinity is one.
"""

from __future__ import annotations

from typing import NamedTuple

from fieldgauge import contract as C
from fieldgauge.config import Thresholds
from fieldgauge.functions.sql import first_match, number, some, text


class Rule(NamedTuple):
    test: str  # true or false, never null
    anomaly: str  # struct<type,value,threshold,reading>


def outside(name: str, low: float, high: float) -> str:
    low, high = number(float(low)), number(float(high))
    return f"coalesce(({name} < {low} OR {name} > {high}) AND NOT isnan({name}), false)"


def _anomaly(kind: str, value: str, threshold: str, reading: str) -> str:
    return (
        f"named_struct('type', {text(kind)}, 'value', {value}, "
        f"'threshold', {threshold}, 'reading', double({reading}))"
    )


def range_rule(
    name: str, limits: tuple[float, float], kind: str, unit: str, low_unit: str
) -> Rule:
    """A metric that must stay within limits."""
    low, high = (f"string({number(float(edge))})" for edge in limits)
    shape = text("%.1f" + unit.replace("%", "%%"))
    threshold = f"concat({low}, {text(f'{low_unit} to ')}, {high}, {text(unit)})"
    value = f"format_string({shape}, {name})"
    return Rule(outside(name, *limits), _anomaly(kind, value, threshold, name))


def battery_rule(limit: int) -> Rule:
    return Rule(
        f"coalesce(battery_level < {limit}, false)",
        _anomaly(
            C.BATTERY_ALERT,
            "concat(string(battery_level), '%')",
            text(f"> {limit}%"),
            "battery_level",
        ),
    )


def rules(thresholds: Thresholds, battery: bool = True) -> list[Rule]:
    """All rules in their fixed order."""
    found = [
        range_rule(name, getattr(thresholds, name), kind, unit, low_unit)
        for kind, name, unit, low_unit in C.RANGE_ALERTS
    ]
    return [*found, battery_rule(thresholds.battery_low)] if battery else found


def any_breach(thresholds: Thresholds, battery: bool = True) -> str:
    """True if some rule fires. Plain comparisons, cheap enough to filter by."""
    return some(rule.test for rule in rules(thresholds, battery))


def breaches(thresholds: Thresholds) -> str:
    """How many rules fire."""
    return " + ".join(f"int({rule.test})" for rule in rules(thresholds))


def anomaly_list(thresholds: Thresholds, battery: bool = True) -> str:
    """array<struct<type,value,threshold,reading>>, empty if nothing fires."""
    items = (first_match([(rule.test, rule.anomaly)]) for rule in rules(thresholds, battery))
    return f"array_compact(array({', '.join(items)}))"


def anomaly_types(anomalies: str) -> str:
    return f"concat_ws(', ', {anomalies}.type)"


def simple_breach() -> str:
    """True if temperature, humidity or pressure leaves its fixed range."""
    return some(outside(name, low, high) for name, (low, high) in C.SIMPLE_RANGES.items())


_DEVICE, _LOCATION = "coalesce(deviceId, 'null')", "coalesce(location, 'null')"


def subject(prefix: str = C.SUBJECT_PREFIX) -> str:
    lead = text(f"{prefix} Anomaly detected in ")
    return f"concat({lead}, {_DEVICE}, ' at ', {_LOCATION})"


def body(anomalies: str, time: str) -> str:
    """Plain-text message with one bullet per anomaly."""
    head = text(C.MESSAGE_HEAD.format(device="%s", location="%s", time="%s"))
    sent = f"date_format({time}, 'yyyy-MM-dd HH:mm:ss')"
    opening = f"format_string({head}, {_DEVICE}, {_LOCATION}, {sent})"
    bullets = (
        f"transform({anomalies}, a -> "
        "concat('- ', a.type, ': ', a.value, ' (threshold: ', a.threshold, ')'))"
    )
    return f"concat({opening}, concat_ws('\\n', {bullets}), {text(C.MESSAGE_TAIL)})"
