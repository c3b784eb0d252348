"""Column expressions that standardise values and mark their quality. Flags are 0/1 integers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from tidemark.context import RunContext


def normalise(value: Column, upper: bool = False) -> Column:
    trimmed = F.trim(value)
    return F.upper(trimmed) if upper else trimmed


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def len_flag(value: Column, length: int) -> Column:
    return flag(F.length(F.trim(value)) == length)


def present_flag(value: Column, allow_empty: bool = False) -> Column:
    return flag(value.isNotNull() if allow_empty else value != "")


def between_flag(value: Column, low, high) -> Column:
    return flag(value.between(low, high))


def pattern_flag(value: Column, pattern: str) -> Column:
    return flag(value.rlike(pattern))


def ts_quality(
    ts: Column, run: RunContext, floor: date = date(2022, 1, 1), tolerance_hours: int = 0
) -> dict[str, Column]:
    """Not later than now (plus a tolerance) and not older than the floor date."""
    latest = run.now + F.expr(f"INTERVAL {tolerance_hours} HOURS")
    return {
        "dq_timestamp_not_future": flag(ts <= latest),
        "dq_timestamp_not_ancient": flag(ts >= F.lit(floor.isoformat()).cast("timestamp_ntz")),
    }


def skew_flag(device_ts: Column, ingest_ts: Column, max_hours: int = 8) -> Column:
    """1 when device clock and arrival differ by more than the allowed offset."""
    seconds = F.abs(F.timestamp_diff("SECOND", ingest_ts, device_ts))
    return flag(seconds > max_hours * 3600)


def classify_reading(
    value: Column, minimum: Column, maximum: Column, low: Column, high: Column
) -> dict[str, Column]:
    """Place a reading against its own physical limits and its own normal band."""
    physical = value.between(minimum, maximum)
    normal = value.between(low, high)
    return {
        "dq_value_in_range": flag(physical),
        "in_normal_range": flag(normal),
        "is_anomaly": flag(physical & ~normal),
        "is_hard_outlier": flag((value < minimum) | (value > maximum)),
    }


def within_pct(actual: Column, estimate: Column, share: float) -> Column:
    """Accept a value that lies within the given share of its estimate."""
    return flag(F.abs(actual - estimate) <= estimate * share)


def namespaced(source: Column | str, identifier: Column) -> Column:
    """Prefix an id with its source; a NULL id stays NULL."""
    prefix = F.lit(source) if isinstance(source, str) else source
    return F.concat(prefix, F.lit(":"), identifier.cast("string"))
