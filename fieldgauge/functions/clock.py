"""Epoch and calendar expressions, as SQL text."""

from __future__ import annotations

UNITS = {"ms": 1000, "s": 1}

# 0001-01-01 .. 9999-12-31, the years a calendar column can hold
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799


def event_time(epoch: str, unit: str = "ms") -> str:
    """Timestamp at whole-second precision, rounding toward zero.

    The unit is always stated, never guessed from the size of the number.
    A number outside the calendar gives null instead of failing the job.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}, not {unit!r}")
    per = UNITS[unit]
    low, high = _FIRST_SECOND * per, _LAST_SECOND * per + per - 1
    seconds = epoch if per == 1 else f"({epoch}) div {per}"
    return f"CASE WHEN {epoch} BETWEEN {low} AND {high} THEN timestamp_seconds({seconds}) END"


def date_parts(time: str) -> dict[str, str]:
    return {"year": f"year({time})", "month": f"month({time})", "day": f"dayofmonth({time})"}


def calendar_parts(time: str) -> dict[str, str]:
    return {**date_parts(time), "hour": f"hour({time})"}
