"""Aggregates behind report pages. Group counts here are over categories, so the results and
the windows over them are small however large the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.monitor import equal_width_bin, with_total


def category_share(df: DataFrame, category: str) -> DataFrame:
    counts = df.groupBy(category).agg(F.count("*").alias("row_count"))
    total = df.agg(F.count("*").alias("total"))
    share = F.round(F.col("row_count") * 100.0 / F.col("total"), 4)
    return with_total(counts, total).withColumn("share_pct", share).drop("total")


def histogram(
    df: DataFrame, value: str, low: float, high: float, bins: int, split: str | None = None
) -> DataFrame:
    """Counts per equal-width bin, optionally per class. NULL values are left out.

    Values below the range are in bin -1, which has no start, those from its end on in bin ``bins``.
    """
    keys = [equal_width_bin(F.col(value), low, high, bins).alias("bin")]
    keys += [F.col(split)] if split else []
    width = (high - low) / bins
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(F.count("*").alias("row_count"))
        .withColumn("bin_start", F.when(F.col("bin") >= 0, F.lit(low) + F.col("bin") * F.lit(width)))
    )


def grouped_counts(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("row_count"))


def kpi_header(df: DataFrame, **measures: Column) -> DataFrame:
    """One row of headline figures."""
    return df.agg(*[m.alias(name) for name, m in measures.items()])


def top_k(
    df: DataFrame, by: str, k: int, key: str, where: Column | None = None, descending: bool = True
) -> DataFrame:
    """First ``k`` rows by a measure, ties by key: each task keeps k rows, nothing is sorted whole."""
    rows = df if where is None else df.filter(where)
    order = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return rows.orderBy(order, F.col(key).asc_nulls_last()).limit(k)


def below(df: DataFrame, measure: str, limit: float, columns: Sequence[str]) -> DataFrame:
    """Rows whose measure is under the limit. Order them when reading, not here."""
    return df.filter(F.col(measure) < limit).select(*columns)


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == value)
