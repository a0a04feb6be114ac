"""Business labels as CASE text built from the fixed tables."""

from __future__ import annotations

from fieldgauge import contract as C
from fieldgauge.functions.sql import between, every, first_match, number, one_of, text


def band(bands: C.Bands, mode: str = "reference") -> str:
    """Category of one metric.

    ``reference`` keeps the published integer edges, so 15.5 falls between two
    steps and lands in the last label. ``contiguous`` stretches each step up to
    the next one.
    """
    if mode not in ("reference", "contiguous"):
        raise ValueError(f"unknown band mode {mode!r}")
    name = bands.metric
    cases = [(f"{name} < {number(bands.floor[1])}", text(bands.floor[0]))]
    for here, after in zip(bands.steps, (*bands.steps[1:], None)):
        label, low, high = here
        inside = between(name, low, high)
        if mode == "contiguous" and after is not None and after[1] > high:
            inside = f"{name} >= {number(low)} AND {name} < {number(after[1])}"
        cases.append((inside, text(label)))
    return first_match(cases, text(bands.rest))


def comfort() -> str:
    """Comfort index, from the three category columns."""
    return first_match(
        [
            (every(one_of(name, allowed) for name, allowed in needs.items()), text(label))
            for label, needs in C.COMFORT_LEVELS
        ],
        text(C.LOWEST_COMFORT),
    )


def season(time: str) -> str:
    return first_match(
        [(one_of(f"month({time})", months), text(name)) for name, months in C.SEASONS],
        text(C.LAST_SEASON),
    )


def device_type(location: str) -> str:
    return first_match(
        [(f"startswith({location}, {text(start)})", text(kind)) for start, kind in C.DEVICE_TYPES],
        text(C.DEFAULT_DEVICE_TYPE),
    )


def condition(low_battery: str, poor_signal: str) -> str:
    """critical if both hold, warning if one does; an unknown side counts as fine."""
    return first_match(
        [
            (f"{low_battery} AND {poor_signal}", "'critical'"),
            (f"{low_battery} OR {poor_signal}", "'warning'"),
        ],
        "'good'",
    )


def device_health(score: str, hours: str, battery: str) -> str:
    return first_match(
        [
            (
                f"{score} >= {number(low_score)} AND {hours} >= {low_hours} "
                f"AND {battery} >= {low_battery}",
                text(label),
            )
            for label, low_score, low_hours, low_battery in C.HEALTH_LEVELS
        ],
        text(C.LOWEST_HEALTH),
    )


def panel_color(panel: str, value: str) -> str:
    lowest, steps = C.PANEL_STEPS[panel]
    return first_match(
        [(f"{value} >= {number(edge)}", text(color)) for edge, color in reversed(steps)],
        text(lowest),
    )
