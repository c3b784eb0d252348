"""Builders for composite scores, rule tiers, rates and encodings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def clamp(value: Column, low, high) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def score(terms: Sequence[Column], low=0, high=100) -> Column:
    """Sum of the terms held within bounds. Fold defaults and weights into the terms."""
    return clamp(reduce(lambda a, b: a + b, terms), low, high)


def points(value: Column, table: Mapping[str, int], default: int) -> Column:
    """Look a category up in a small fixed table of points."""
    out = None
    for key, worth in table.items():
        out = F.when(value == key, worth) if out is None else out.when(value == key, worth)
    return out.otherwise(default)


def tier(rules: Sequence[tuple[str, Column]], default: str) -> Column:
    """Name of the first rule that holds; NULL comparisons fall through to the next rule."""
    (name, condition), *rest = rules
    out = F.when(condition, name)
    for name, condition in rest:
        out = out.when(condition, name)
    return out.otherwise(default)


def rate(part: Column, whole: Column, scale: float = 100.0, digits: int | None = 2) -> Column:
    """part / whole * scale; NULL when the whole is 0 or NULL."""
    value = F.try_divide(part.cast("double"), whole.cast("double")) * scale
    return value if digits is None else F.round(value, digits)


def money_sum(value: Column) -> Column:
    """Sum of amounts, to a millionth each, that does not depend on the order of the rows."""
    return F.sum(value.cast("decimal(28,6)")).cast("double")


def mean_of_flags(value: Column) -> Column:
    """Mean of a flag or another whole number taken from exact integer sums."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def exact_mean(value: Column, digits: int = 9) -> Column:
    """Mean from an exact decimal sum, so that neither the order of the rows nor the number of tasks
    can move it across a threshold or a rounding step."""
    total = F.sum(value.cast(f"decimal(28,{digits})")).cast("double")
    return F.try_divide(total, F.count(value).cast("double"))
