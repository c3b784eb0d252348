"""Grouped aggregates: pre-aggregated signals, rollups, pivots, suppression, linkage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def left_signals(
    base: DataFrame, key: str, signals: Sequence[tuple[DataFrame, Mapping[str, object]]]
) -> DataFrame:
    """Left-join tables that are already one row per key, filling misses with defaults.

    A default of ``None`` leaves the column NULL. Aggregating before the join keeps the base
    row count and moves one row per key instead of every event.
    """
    out = base
    for table, defaults in signals:
        out = out.join(table.select(key, *defaults), key, "left")
        for column, default in defaults.items():
            if default is not None:
                out = out.withColumn(column, F.coalesce(column, F.lit(default)))
    return out


def linkage(facts: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """One row: total facts, facts whose key is known, and their share in percent.

    Facts are counted per key first, so the join sees one row per key.
    """
    counts = facts.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    known = dim.select(F.col(dim_key).alias("_key")).distinct().withColumn("_known", F.lit(1))
    return (
        counts.join(known, "_key", "left")
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum(F.col("_n") * F.col("_known")), F.lit(0)).alias("linked_rows"),
        )
        .withColumn(
            "linkage_pct",
            F.round(F.try_divide(F.col("linked_rows").cast("double"), F.col("total_rows")) * 100, 4),
        )
    )


def rollup_two_level(
    df: DataFrame,
    inner_keys: Sequence[str | Column],
    inner: Sequence[Column],
    outer_keys: Sequence[str | Column],
    outer: Sequence[Column],
) -> DataFrame:
    """Aggregate, then aggregate the result: a mean in ``outer`` is a mean of group means."""
    return df.groupBy(*inner_keys).agg(*inner).groupBy(*outer_keys).agg(*outer)


def suppress_small(df: DataFrame, size: str, k: int = 10) -> DataFrame:
    """Only groups with at least ``k`` members may be shown."""
    return df.filter(F.col(size) >= k)


def blank_small(df: DataFrame, size: str, measures: Sequence[str], k: int = 10) -> DataFrame:
    """Keep every group but clear the measures of those with fewer than ``k`` members."""
    hidden = {m: F.when(F.col(size) >= k, F.col(m)) for m in measures}
    return df.withColumns(hidden)


def pivot_measures(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    measures: Mapping[str, tuple[str, str, str]],
    totals: Sequence[Column] = (),
) -> DataFrame:
    """Wide table with one conditional aggregate per output column.

    ``measures`` maps an output name to (category value, input column, aggregate name);
    ``totals`` are plain aggregates over all categories.
    """
    columns = [
        getattr(F, how)(F.when(F.col(by) == value, F.col(source))).alias(name)
        for name, (value, source, how) in measures.items()
    ]
    return df.groupBy(*keys).agg(*columns, *totals)


def exact_median(df: DataFrame, columns: Sequence[str], bins: int = 4096) -> DataFrame:
    """One row per column: ``feature``, ``median`` (NULL and NaN ignored; none without values).

    A quantile sketch places a narrow bracket around the middle; values are then counted in
    the bracket's bins and in one bin on either side of it. The counts decide which bin holds
    the middle rank, so the result is exact however rough the sketch, and only the distinct
    values of that bin are put in order. No task holds a whole column.
    """
    sketch = df.agg(
        *[
            F.percentile_approx(_finite(c), [0.498, 0.502], 2_000).alias(f"_q{i}")
            for i, c in enumerate(columns)
        ],
        *[F.count(_finite(c)).alias(f"_n{i}") for i, c in enumerate(columns)],
    )
    brackets = sketch.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("feature"),
                        F.col(f"_q{i}")[0].alias("_lo"),
                        F.col(f"_q{i}")[1].alias("_hi"),
                        F.col(f"_n{i}").alias("_total"),
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), _finite(c).alias("v")) for c in columns]
    )
    share = F.try_divide(F.col("v") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    inside = 1 + F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1))
    # One row per column: small enough to broadcast by construction.
    binned = (
        df.select(F.inline(pairs))
        .filter("v IS NOT NULL")
        .join(F.broadcast(brackets), "feature")
        .withColumn(
            "_bin",
            F.when(F.col("v") < F.col("_lo"), F.lit(0))
            .when(F.col("v") > F.col("_hi"), F.lit(bins + 1))
            .otherwise(inside),
        )
    )
    in_order = Window.partitionBy("feature").orderBy("_bin")
    reached = (
        binned.groupBy("feature", "_bin", "_total")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(in_order) - F.col("_n"))
    )
    lower = F.floor((F.col("_total") + 1) / 2)
    upper = F.floor((F.col("_total") + 2) / 2)
    # The one or two bins that hold the two middle ranks.
    middle = reached.filter(
        ((F.col("_before") < lower) & (lower <= F.col("_before") + F.col("_n")))
        | ((F.col("_before") < upper) & (upper <= F.col("_before") + F.col("_n")))
    ).select("feature", "_bin", "_before")
    within = Window.partitionBy("feature", "_bin").orderBy("v")
    ranked = (
        binned.join(F.broadcast(middle), ["feature", "_bin"])
        .groupBy("feature", "_bin", "_total", "_before", "v")
        .agg(F.count("*").alias("_n"))
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(within))
        .withColumn("_from", F.col("_upto") - F.col("_n"))
    )

    def value_at(rank: Column) -> Column:
        holds = (F.col("_from") < rank) & (rank <= F.col("_upto"))
        return F.max(F.when(holds, F.col("v")))

    return ranked.groupBy("feature").agg(
        ((value_at(lower) + value_at(upper)) / 2).alias("median")
    )


def _finite(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)
