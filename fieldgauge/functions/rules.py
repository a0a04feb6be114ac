"""Validity rules as boolean SQL text."""

from __future__ import annotations

from fieldgauge import contract as C
from fieldgauge.functions.sql import between, every, first_match, number, text


def rule(name: str) -> str:
    """One rule; always true or false, never null."""
    if name in C.NON_EMPTY:
        return f"{name} IS NOT NULL AND length({name}) > 0"
    if name in C.PRESENT:
        return f"{C.PRESENT[name]} IS NOT NULL"
    return f"{name} IS NOT NULL AND {between(name, *C.VALID_RANGES[name])}"


def all_rules() -> str:
    return every(map(rule, C.RULES))


def rule_score() -> str:
    """Share of rules passed, 0.0 to 1.0."""
    passed = " + ".join(f"int({rule(name)})" for name in C.RULES)
    return f"({passed}) / {number(float(len(C.RULES)))}"


def rule_columns() -> dict[str, str]:
    """The ten flags, their conjunction and the share passed."""
    return {
        **{f"{name}_valid": rule(name) for name in C.RULES},
        "is_valid_record": all_rules(),
        "data_quality_score": rule_score(),
    }


def passed_columns() -> dict[str, str]:
    """The same columns for rows that are known to pass every rule."""
    return {
        **{f"{name}_valid": "true" for name in C.RULES},
        "is_valid_record": "true",
        "data_quality_score": "1.0D",
    }


def first_failure() -> str:
    """Label of the first metric that is missing or out of range."""
    cases = []
    for label, name, low, high in C.FLAG_RULES:
        broken = f"{name} IS NULL OR {name} < {number(low)}"
        if high is not None:
            broken += f" OR {name} > {number(high)}"
        cases.append((broken, text(label)))
    return first_match(cases, text(C.FLAG_OK))


def grade(percent: str) -> str:
    return first_match(
        [(f"{percent} >= {edge}", text(label)) for edge, label in C.GRADES], text(C.LOWEST_GRADE)
    )
