"""Row-level key operators: required keys, latest record, casts, rule splits, ordered flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F


def require(df: DataFrame, *keys: str) -> DataFrame:
    """Drop rows in which any part of the key is missing."""
    return df.dropna(subset=list(keys))


@dataclass(frozen=True)
class Cast:
    """One output column: source column (same name by default), type, and text treatment."""

    to: str
    type: str
    source: str | None = None
    trim: bool = False
    upper: bool = False

    def column(self, on_error: str) -> Column:
        value = F.col(self.source or self.to)
        if self.trim or self.upper:
            value = F.trim(value)
        if self.upper:
            value = F.upper(value)
        cast = value.try_cast(self.type) if on_error == "null" else value.cast(self.type)
        return cast.alias(self.to)


def cast_project(
    df: DataFrame,
    casts: Sequence[Cast],
    on_error: str = "fail",
    flags: Mapping[str, Column] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed projection. A bad value stops the job, or becomes NULL with ``on_error="null"``.

    Columns not listed are dropped. ``flags`` are computed from the raw columns; ``keep``
    passes columns through where the input has them.
    """
    marks = [condition.alias(name) for name, condition in (flags or {}).items()]
    passed = [F.col(c) for c in keep if c in df.columns]
    return df.select(*[c.column(on_error) for c in casts], *marks, *passed)


def casts(ddl: str, **treatments: str) -> list[Cast]:
    """Casts from ``"name TYPE, new_name TYPE <- old_name"``; treatments are ``trim``/``upper``."""
    out = []
    for part in ddl.split(","):
        target, _, source = part.partition("<-")
        name, kind = target.split()
        how = treatments.get(name, "")
        out.append(Cast(name, kind, source.strip() or None, trim=how == "trim", upper=how == "upper"))
    return out


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Keep the newest row of each key; ties go to the largest tie-break values, NULL last.

    Filtering on ``row_number() = 1`` lets Spark keep one row per key in every map task
    before the shuffle, so a key with many copies sends only a few rows to its reducer.
    """
    newest = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in (*order, *tiebreak)]
    )
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def split_by_rules(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule, and the rest with the names of the rules they broke.

    A rule that evaluates to NULL counts as broken.
    """
    broken = [
        F.when(F.coalesce(condition, F.lit(False)), None).otherwise(F.lit(name))
        for name, condition in rules.items()
    ]
    marked = df.withColumn("reject_reasons", F.array_compact(F.array(*broken)))
    good = marked.filter(F.size("reject_reasons") == 0).drop("reject_reasons")
    return good, marked.filter(F.size("reject_reasons") > 0)


def split_by_reference(
    df: DataFrame, reference: DataFrame, key: str, reference_key: str
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key exists in the reference list, and the orphans (a NULL key is one)."""
    known = reference.select(F.col(reference_key).alias(key)).distinct()
    return df.join(known, key, "left_semi"), df.join(known, key, "left_anti")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def lag_in_order(
    df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, segment: Column
) -> DataFrame:
    """``lag(value)`` per key in ``order``, without putting a whole key into one task.

    ``segment`` cuts the order axis into consecutive pieces (it must not decrease along
    ``order``). Each piece is a window of its own; the last value of the piece before comes
    from a summary with one row per key and piece. Keys must not be NULL.
    """
    pieces = df.withColumn("_segment", segment)
    carried = (
        pieces.groupBy(*keys, "_segment")
        .agg(F.max_by(F.struct(value), order).alias("_last"))
        .select(
            *keys,
            "_segment",
            F.lag("_last").over(Window.partitionBy(*keys).orderBy("_segment")).alias("_carried"),
        )
    )
    inside = Window.partitionBy(*keys, "_segment").orderBy(order)
    return (
        pieces.withColumn("_row", F.row_number().over(inside))
        .withColumn("_previous", F.lag(value).over(inside))
        .join(carried, [*keys, "_segment"], "left")
        .withColumn(
            out, F.when(F.col("_row") == 1, F.col(f"_carried.{value}")).otherwise(F.col("_previous"))
        )
        .drop("_segment", "_row", "_previous", "_carried")
    )


def sequence_flags(
    df: DataFrame, key: str, ts: str, ingest_order: str, rows_per_segment: int = 1_000_000
) -> DataFrame:
    """Mark repeated timestamps of a key, and rows that arrive with an earlier timestamp than
    the row before them."""
    copies = df.groupBy(key, ts).agg(F.count("*").alias("_copies"))
    segment = F.floor(F.col(ingest_order) / rows_per_segment)
    ordered = lag_in_order(df, [key], ingest_order, ts, "_before", segment)
    return (
        ordered.join(copies, [key, ts], "left")
        .withColumn("is_duplicate_ts", F.when(F.col("_copies") > 1, 1).otherwise(0))
        .withColumn("is_out_of_order", F.when(F.col(ts) < F.col("_before"), 1).otherwise(0))
        .drop("_copies", "_before")
    )
