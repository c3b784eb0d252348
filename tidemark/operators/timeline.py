"""Signals from one event log attached to the days of another, without a range join.

Both sides are first reduced to one row per key and calendar day. After that a window over a
key holds at most two rows per day, however many events the key has, so a hot key costs no
more than a long-lived one and no window or join can blow up with the number of events.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

UNBOUNDED = Window.unboundedPreceding


def day_number(day: str | Column) -> Column:
    return F.unix_date((F.col(day) if isinstance(day, str) else day).cast("date"))


@dataclass(frozen=True)
class Signal:
    """One column computed from events around each day.

    kind ``count``       number of events in [day - before, day + after], 0 if none
    kind ``any``         1 if there is one in that range, else 0
    kind ``days_since``  days from the latest event in [day - before, day] (``before=None``:
                         ever) to the day, ``default`` if none
    """

    name: str
    kind: str
    before: int | None = 0
    after: int = 0
    where: Column | None = None
    default: int = 0


def attach_signals(
    base: DataFrame,
    events: DataFrame,
    key: str,
    day: str,
    event_day: str,
    signals: Sequence[Signal],
    one_row_per_day: bool = False,
) -> DataFrame:
    """``base`` plus one column per signal; every base row is kept once.

    With ``one_row_per_day`` the caller states that ``base`` has at most one row per key and
    day; its rows then go through the window themselves and are not joined a second time.
    """
    hits = events.dropna(subset=[key, event_day]).select(
        F.col(key),
        day_number(event_day).alias("_day"),
        *[
            (F.lit(1) if s.where is None else F.when(s.where, 1).otherwise(0)).alias(s.name)
            for s in signals
        ],
    )
    per_day = hits.groupBy(key, "_day").agg(
        *[F.sum(s.name).alias(s.name) for s in signals], F.lit(0).alias("_probe")
    )
    no_hits = {s.name: F.lit(0).cast("long") for s in signals}
    if one_row_per_day:
        probes = base.withColumn("_day", day_number(day))
    else:
        probes = (
            base.dropna(subset=[key, day])
            .select(F.col(key), day_number(day).alias("_day"))
            .distinct()
        )
    probes = probes.withColumns({**no_hits, "_probe": F.lit(1)})
    by_day = Window.partitionBy(key).orderBy("_day")

    def over_range(s: Signal) -> Column:
        first = UNBOUNDED if s.before is None else -s.before
        frame = by_day.rangeBetween(first, s.after)
        if s.kind == "days_since":
            latest = F.max(F.when(F.col(s.name) > 0, F.col("_day"))).over(frame)
            return F.coalesce(F.col("_day") - latest, F.lit(s.default)).alias(s.name)
        total = F.sum(s.name).over(frame)
        return (total if s.kind == "count" else F.when(total > 0, 1).otherwise(0)).alias(s.name)

    carried = base.columns if one_row_per_day else [key, "_day"]
    looked_up = (
        probes.unionByName(per_day, allowMissingColumns=True)
        .select(*carried, "_probe", *[over_range(s) for s in signals])
        .filter("_probe = 1")
        .drop("_probe")
    )

    def filled(s: Signal) -> Column:
        kind = "long" if s.kind == "count" else "int"
        fallback = s.default if s.kind == "days_since" else 0
        return F.coalesce(F.col(s.name), F.lit(fallback)).cast(kind).alias(s.name)

    if not one_row_per_day:
        dated = base.withColumn("_day", day_number(day))
        looked_up = dated.join(looked_up, [key, "_day"], "left")
    return looked_up.select(*base.columns, *[filled(s) for s in signals])


def attach_asof(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    day: str,
    valid_from: str,
    attributes: Sequence[str],
    valid_to: str | None = None,
) -> DataFrame:
    """Each fact with the attributes valid on its day (``valid_from <= day < valid_to``).

    ``history`` has at most one row per key and start day. A fact before the first version,
    or in a closed period without a successor, gets NULLs.
    """
    until = day_number(valid_to) if valid_to else F.lit(None).cast("int")
    version = F.struct(*attributes, until.alias("_until"))
    starts = history.dropna(subset=[key, valid_from]).select(
        key, day_number(valid_from).alias("_day"), version.alias("_version"), F.lit(0).alias("_probe")
    )
    probes = (
        facts.dropna(subset=[key, day])
        .select(key, day_number(day).alias("_day"))
        .distinct()
        .withColumn("_probe", F.lit(1))
    )
    so_far = Window.partitionBy(key).orderBy("_day").rangeBetween(UNBOUNDED, 0)
    current = F.last("_version", ignorenulls=True).over(so_far)
    looked_up = (
        probes.unionByName(starts, allowMissingColumns=True)
        .select(key, "_day", "_probe", current.alias("_version"))
        .filter("_probe = 1")
        .filter("_version._until IS NULL OR _day < _version._until")
        .select(key, "_day", *[F.col(f"_version.{a}").alias(a) for a in attributes])
    )
    return (
        facts.withColumn("_day", day_number(day))
        .join(looked_up, [key, "_day"], "left")
        .drop("_day")
    )
