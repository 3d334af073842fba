"""Validation rules as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.numbers import number
from ..rulebook import Rule


def out_of_range(value: Column, low: float | None, high: float | None) -> Column:
    """Only the sides given. NaN, which Spark sorts above all numbers, is in every range, and so
    is null."""
    tests = []
    if low is not None:
        tests.append(value < F.lit(float(low)))
    if high is not None:
        tests.append((value > F.lit(float(high))) & ~F.isnan(value))
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False)) if tests else F.lit(False)


def record_fails(rule: Rule, booleans: bool = False, numeric: bool = False) -> Column:
    """numeric: the field's type is a number, which is compared as it is, not read from its text."""
    raw = F.col(f"`{rule.target}`")
    return raw.isNull() if rule.kind == "not_null" else out_of_range(number(raw, booleans, numeric), rule.low, rule.high)


def value_fails(rule: Rule, value: Column) -> Column:
    """Null values never get here, so not_null always holds."""
    return F.lit(False) if rule.kind == "not_null" else out_of_range(value, rule.low, rule.high)


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def outcome(rules: list[Rule], value: Column) -> tuple[Column, Column]:
    """(suspect, outcome): the first rule that discards decides; flags count on what is kept."""
    suspect = any_of([value_fails(r, value) for r in rules if not r.discards])
    out = None
    for r in rules:
        if r.discards:
            label = F.lit("drop" if r.on_fail == "drop_row" else "reject")
            out = F.when(value_fails(r, value), label) if out is None else out.when(value_fails(r, value), label)
    return suspect, F.lit("keep") if out is None else out.otherwise(F.lit("keep"))
