"""Slowly changing history (type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F


def scd2(
    df: DataFrame, key: str, effective: str, order: str, tracked: Sequence[str]
) -> DataFrame:
    """Versions of the tracked columns per key, with ``valid_from``, ``valid_to``, ``version``
    and ``is_current``. Days are the grain: the last record of a day (by ``order``) stands for
    the day, and a record that repeats the version before it adds nothing.

    The daily reduction is a partial aggregate, so the windows see at most one row per key
    and day.
    """
    daily = (
        df.dropna(subset=[key, effective])
        .groupBy(key, F.col(effective).cast("date").alias("valid_from"))
        .agg(F.max_by(F.struct(*tracked), order).alias("_state"))
    )
    in_order = Window.partitionBy(key).orderBy("valid_from")
    before = F.lag("_state").over(in_order)
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"_state.{c}").eqNullSafe(F.col(f"_before.{c}")) for c in tracked],
    )
    changes = daily.withColumn("_before", before).filter(F.col("_before").isNull() | ~same)
    return changes.select(
        key,
        *[F.col(f"_state.{c}").alias(c) for c in tracked],
        "valid_from",
        F.lead("valid_from").over(in_order).alias("valid_to"),
        F.row_number().over(in_order).alias("version"),
        F.when(F.lead("valid_from").over(in_order).isNull(), 1).otherwise(0).alias("is_current"),
    )


def _versions(daily: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Intervals of equal state from one row per key and day, with the records that each rests on."""
    in_order = Window.partitionBy(key).orderBy("_day")
    before = F.lag(F.struct(F.struct(*tracked).alias("s"))).over(in_order)
    new = before.isNull() | ~before["s"].eqNullSafe(F.struct(*tracked))
    numbered = daily.withColumn("_new", new.cast("int")).withColumn("version", F.sum("_new").over(in_order).cast("int"))
    held = numbered.groupBy(key, "version").agg(
        *[F.first(c).alias(c) for c in tracked],
        F.min("_day").alias("valid_from"),
        F.array_sort(F.collect_list(F.struct("_day", "_order"))).alias("seen"),
    )
    by_version = Window.partitionBy(key).orderBy("version")
    following = F.lead("valid_from").over(by_version)
    return held.select(
        key, *tracked, "valid_from", following.alias("valid_to"), "version",
        F.when(following.isNull(), 1).otherwise(0).alias("is_current"), "seen",
    )


def _daily(rows: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """The last record of every key and day; of equal orders the greatest state."""
    last = F.max(F.struct("_order", *tracked)).alias("_last")
    return rows.groupBy(key, "_day").agg(last).select(key, "_day", "_last.*")


def start_history(
    df: DataFrame, key: str, effective: str, order: str, tracked: Sequence[str]
) -> DataFrame:
    """``scd2`` with ``seen``: the days and orders of the records that a version rests on.

    A record that repeats the version before it adds no version, but a late record may come between
    them; ``seen`` is what makes that merge exact. It is bounded by the days of the version.
    """
    rows = df.dropna(subset=[key, effective]).select(
        key, F.col(effective).cast("date").alias("_day"), F.col(order).alias("_order"), *tracked
    )
    return _versions(_daily(rows, key, tracked), key, tracked)


def splice_history(
    history: DataFrame, changes: DataFrame, key: str, effective: str, order: str, tracked: Sequence[str]
) -> DataFrame:
    """A history with a batch of records merged in, late and out of order as they may be.

    Only keys of the batch are taken apart and put together again: intervals are split where a record
    falls into one, closed where a new state begins, and joined where neighbours become equal. Any
    order of batches gives the history of all records.
    """
    keys = changes.select(key).dropna().distinct()
    rows = changes.dropna(subset=[key, effective]).select(
        key, F.col(effective).cast("date").alias("_day"), F.col(order).alias("_order"), *tracked
    )
    touched = history.join(keys, key, "left_semi").select(key, *tracked, F.inline("seen"))
    merged = _daily(touched.select(key, "_day", "_order", *tracked).unionByName(rows), key, tracked)
    untouched = history.join(keys, key, "left_anti")
    return untouched.unionByName(_versions(merged, key, tracked))
