"""Drift, alert and bias measures over data products."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.scoring import rate
from tidemark.session import shared_root


def equal_width_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """0-based bin of a value; -1 holds all values below the range, ``bins`` all from its end on."""
    position = F.floor((value - low) / ((high - low) / bins))
    return F.greatest(F.lit(-1), F.least(F.lit(bins), position)).cast("int")


def with_total(rows: DataFrame, total: DataFrame) -> DataFrame:
    """``rows`` with the columns of a one-row table, each a scalar subquery."""
    return rows.withColumns({c: total.select(c).scalar() for c in total.columns})


def drift_by_bin(
    df: DataFrame, period: Column, bin_of: Column, epsilon: float = 1e-6
) -> DataFrame:
    """(bin, base_share, current_share, share_delta, psi_term) between two periods of one table.

    ``period`` gives ``base``, ``current`` or NULL (row not used). One aggregation to bins,
    then a window over the bins.
    """
    counts = (
        df.select(period.alias("_period"), bin_of.alias("bin"))
        .filter("_period IS NOT NULL")
        .groupBy("bin")
        .agg(
            F.count_if(F.col("_period") == "base").alias("_base"),
            F.count_if(F.col("_period") == "current").alias("_current"),
        )
    )
    everything = Window.partitionBy(F.lit(0))
    shares = counts.select(
        "bin",
        F.coalesce(
            F.try_divide(F.col("_base").cast("double"), F.sum("_base").over(everything)), F.lit(0.0)
        ).alias("base_share"),
        F.coalesce(
            F.try_divide(F.col("_current").cast("double"), F.sum("_current").over(everything)),
            F.lit(0.0),
        ).alias("current_share"),
    )
    base = F.greatest("base_share", F.lit(epsilon))
    current = F.greatest("current_share", F.lit(epsilon))
    return shares.withColumn(
        "share_delta", F.col("current_share") - F.col("base_share")
    ).withColumn("psi_term", (current - base) * F.log(current / base))


def drift_summary(by_bin: DataFrame, max_shift: float = 0.10) -> DataFrame:
    """One row: population stability index, largest share change, and whether it is a drift."""
    return by_bin.agg(
        F.sum("psi_term").alias("psi"), F.max(F.abs("share_delta")).alias("max_share_delta")
    ).withColumn("is_drift", F.when(F.col("max_share_delta") > max_shift, 1).otherwise(0))


def rate_shift(
    df: DataFrame, day: str, label: str, window_days: int, max_delta_pct: float
) -> DataFrame:
    """Label rate of the trailing window against the window before it, one row per day.

    The data is first counted per day; the windows run over calendar days.
    """
    daily = df.groupBy(F.col(day).cast("date").alias("day")).agg(
        F.count("*").alias("_n"), F.sum(F.col(label).cast("int")).alias("_hits")
    )
    by_day = Window.orderBy(F.unix_date("day"))
    recent = by_day.rangeBetween(-(window_days - 1), 0)
    earlier = by_day.rangeBetween(-(2 * window_days - 1), -window_days)

    def pct(frame) -> Column:
        return rate(F.sum("_hits").over(frame), F.sum("_n").over(frame), digits=None)

    return (
        daily.select("day", pct(recent).alias("rate_pct"), pct(earlier).alias("previous_rate_pct"))
        .withColumn("delta_pct", F.col("rate_pct") - F.col("previous_rate_pct"))
        .withColumn("is_alert", F.when(F.abs("delta_pct") > max_delta_pct, 1).otherwise(0))
    )


def metric_drop(
    df: DataFrame, order: str, metric: str, max_drop: float, model: str | None = None
) -> DataFrame:
    """Evaluations in order, with the fall of a metric since the evaluation before.

    ``model`` names the column that tells models apart; without it all are of one model.
    """
    key = F.lit(0) if model is None else F.col(model)
    drop = F.lag(metric).over(Window.partitionBy(key).orderBy(order)) - F.col(metric)
    return df.withColumn("metric_drop", drop).withColumn(
        "is_alert", F.when(F.col("metric_drop") > max_drop, 1).otherwise(0)
    )


def metric_rows(df: DataFrame, *metrics: str) -> DataFrame:
    """A one-row table of figures as (metric, observed) rows."""
    rows = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("observed"))
        for m in metrics
    ]
    return df.select(F.inline(F.array(*rows)))


def alerts(metrics: DataFrame, rules: Mapping[str, tuple[str, float]]) -> DataFrame:
    """(metric, observed, rule, is_alert) for the (metric, observed) rows that have a rule.

    A rule is (``"above"`` or ``"below"``, limit); it fires beyond the limit.
    """
    name, value = F.col("metric"), F.col("observed")
    text, fired = F.lit(None).cast("string"), F.lit(False)
    for metric, (direction, limit) in rules.items():
        beyond = value > limit if direction == "above" else value < limit
        text = F.when(name == metric, f"{direction} {limit:g}").otherwise(text)
        fired = F.when(name == metric, beyond).otherwise(fired)
    return metrics.filter(name.isin(list(rules))).select(
        "metric", "observed", text.alias("rule"), F.when(fired, 1).otherwise(0).alias("is_alert")
    )


def exactly_one(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """Keys that do not have exactly one value of the attribute."""
    return (
        df.groupBy(key)
        .agg(F.countDistinct(attribute).alias("value_count"))
        .filter("value_count <> 1")
    )


def group_rate_audit(df: DataFrame, group: str, label: str) -> DataFrame:
    """Label rate of each group against the overall rate (a ratio of 1 is parity)."""
    counts = df.groupBy(group).agg(
        F.count("*").alias("group_size"), F.sum(F.col(label).cast("int")).alias("positives")
    )
    total = df.agg(
        F.count("*").alias("_size"), F.sum(F.col(label).cast("int")).alias("_positives")
    )
    overall = rate(F.col("_positives"), F.col("_size"), digits=None)
    return with_total(counts, total).select(
        group,
        "group_size",
        "positives",
        rate(F.col("positives"), F.col("group_size"), digits=None).alias("rate_pct"),
        overall.alias("overall_rate_pct"),
    ).withColumn("rate_ratio", F.try_divide(F.col("rate_pct"), F.col("overall_rate_pct")))


def ks_distance(df: DataFrame, value: str, second: Column, coefficient: float = 1.358) -> DataFrame:
    """Kolmogorov-Smirnov distance of two samples, exact and without bins: one row.

    ``second`` tells the rows of the second sample. Equal values become one row with two counts, rows
    are dealt by range of the value, sums of whole ranges give each its offset, and running sums stay
    within a range; no task sees all values. ``gap`` is the largest difference of the two cumulative
    counts, each times the size of the other sample, so it is a whole number.
    """
    spark = df.sparkSession
    shared_root(spark)
    one, two = F.count_if(~second), F.count_if(second)
    counted = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(one.alias("x"), two.alias("y"))
    # Written once, so that a range is the same rows for its sum and for its running sums.
    dealt = counted.repartitionByRange("v").checkpoint().withColumn("part", F.spark_partition_id())
    sums = dealt.groupBy("part").agg(F.sum("x").alias("px"), F.sum("y").alias("py"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in ("px", "py")]
    )
    running = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.join(offsets, "part").select(
        "v", (F.sum("x").over(running) + F.col("_px")).alias("cx"), (F.sum("y").over(running) + F.col("_py")).alias("cy")
    )
    total = sums.agg(F.coalesce(F.sum("px"), F.lit(0)).alias("n_first"), F.coalesce(F.sum("py"), F.lit(0)).alias("n_second"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    gap = F.abs(wide("cx") * wide("n_second") - wide("cy") * wide("n_first"))
    most = with_total(placed, total).agg(F.max(gap).alias("gap"))
    n, m = F.col("n_first").cast("double"), F.col("n_second").cast("double")
    return with_total(total, most).select(
        "n_first", "n_second", F.try_divide(F.col("gap").cast("double"), n * m).alias("distance"),
        (coefficient * F.sqrt(F.try_divide(n + m, n * m))).alias("critical"),
    ).withColumn("differs", F.coalesce(F.col("distance") > F.col("critical"), F.lit(False)))
