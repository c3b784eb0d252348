"""Time-series operators. Readings are reduced to hours or days before any window runs, so a
window over one sensor is bounded by the calendar and not by its number of readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.timeline import day_number


def hour_number(ts: str | Column) -> Column:
    """Whole hours since the epoch; differences count hour boundaries crossed."""
    column = F.col(ts) if isinstance(ts, str) else ts
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("HOUR", epoch, F.date_trunc("hour", column).cast("timestamp_ntz"))


def hour_start(number: str | Column) -> Column:
    column = F.col(number) if isinstance(number, str) else number
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("HOUR", column.cast("int"), epoch).cast("timestamp_ntz")


def gaps(df: DataFrame, key: str, ts: str, min_missing: int = 2) -> DataFrame:
    """Stretches of at least ``min_missing`` hours in which a sensor sent nothing."""
    hours = df.dropna(subset=[key, ts]).select(key, hour_number(ts).alias("_hour")).distinct()
    in_order = Window.partitionBy(key).orderBy("_hour")
    return (
        hours.withColumn("_before", F.lag("_hour").over(in_order))
        .withColumn("gap_hours", F.col("_hour") - F.col("_before") - 1)
        .filter(F.col("gap_hours") >= min_missing)
        .select(
            key,
            hour_start("_before").alias("last_seen_hour"),
            hour_start("_hour").alias("reading_hour"),
            "gap_hours",
        )
    )


def gap_aware_mean(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    valid: str,
    hours: int = 24,
    per_hour: int = 1,
    min_completeness: float = 50.0,
) -> DataFrame:
    """Trailing mean of valid readings per sensor and hour, NULL where too little arrived.

    Completeness is the share of expected readings (``per_hour`` each hour) that were valid,
    at most 100.
    """
    ok = F.when(F.col(valid) == 1, F.col(value))
    hourly = (
        df.dropna(subset=[key, ts])
        .groupBy(key, hour_number(ts).alias("_hour"))
        .agg(F.sum(ok).alias("_sum"), F.count(ok).alias("_n"))
    )
    trailing = Window.partitionBy(key).orderBy("_hour").rangeBetween(-(hours - 1), 0)
    rolled = hourly.select(
        key,
        hour_start("_hour").alias("reading_hour"),
        F.sum("_sum").over(trailing).alias("_sum"),
        F.sum("_n").over(trailing).alias("valid_readings"),
    )
    expected = hours * per_hour
    completeness = F.least(F.lit(100.0), F.col("valid_readings") * 100.0 / expected)
    mean = F.try_divide(F.col("_sum"), F.col("valid_readings").cast("double"))
    return rolled.withColumn("completeness_pct", completeness).select(
        key,
        "reading_hour",
        "valid_readings",
        "completeness_pct",
        F.when(F.col("completeness_pct") >= min_completeness, mean).alias("rolling_mean"),
    )


def densify_hours(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Every hour between a sensor's first and last reading, with its number of readings.

    Hours without readings are rows with 0; nothing is filled in. Days are joined, not hours:
    a day carries its at most 24 hourly counts, and hours are unfolded last, so the grid
    itself is never shuffled.
    """
    hourly = (
        df.dropna(subset=[key, ts])
        .groupBy(key, hour_number(ts).alias("_hour"))
        .agg(F.count("*").alias("_n"))
    )
    daily = hourly.groupBy(key, F.expr("(_hour - pmod(_hour, 24)) div 24").alias("_date")).agg(
        F.map_from_entries(F.collect_list(F.struct("_hour", "_n"))).alias("_counts"),
        F.min("_hour").alias("_lo"),
        F.max("_hour").alias("_hi"),
    )
    span = daily.groupBy(key).agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    days = span.select(
        key, "_lo", "_hi", F.explode(F.expr("sequence((_lo - pmod(_lo, 24)) div 24, (_hi - pmod(_hi, 24)) div 24)")).alias("_date")
    )
    # A few sensors can unfold into many days: spread those before unfolding the hours.
    days = days.repartition(key, "_date")
    filled = days.join(daily.select(key, "_date", "_counts"), [key, "_date"], "left")
    grid = filled.select(
        key,
        "_counts",
        F.explode(
            F.expr("sequence(greatest(_lo, _date * 24), least(_hi, _date * 24 + 23))")
        ).alias("_hour"),
    )
    found = F.try_element_at("_counts", F.col("_hour"))
    return grid.select(
        key,
        hour_start("_hour").alias("reading_hour"),
        F.coalesce(found, F.lit(0)).cast("long").alias("reading_count"),
        F.when(found.isNull(), 1).otherwise(0).alias("is_missing"),
    )


def sensor_drift(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    baseline_days: int = 7,
    recent_days: int = 7,
    threshold_pct: float = 10.0,
) -> DataFrame:
    """Level of a sensor in its last days against its own first days, and its daily slope.

    The slope is the least-squares line through the daily means. Days are centred in whole numbers
    (n * day - sum of days), so nothing is lost to the distance of the days from the epoch.
    """
    daily = (
        df.dropna(subset=[key, ts, value])
        .groupBy(key, day_number(ts).alias("_day"))
        .agg(F.sum(value).alias("_sum"), F.count("*").alias("_n"))
    )
    whole = Window.partitionBy(key)
    marked = daily.select(
        "*",
        F.min("_day").over(whole).alias("_first"),
        F.max("_day").over(whole).alias("_last"),
        (F.count("*").over(whole) * F.col("_day") - F.sum("_day").over(whole)).alias("_centred"),
    )
    early = F.col("_day") < F.col("_first") + baseline_days
    late = F.col("_day") > F.col("_last") - recent_days

    def mean_where(condition: Column) -> Column:
        total = F.sum(F.when(condition, F.col("_sum")))
        return total / F.sum(F.when(condition, F.col("_n")))

    out = marked.groupBy(key).agg(
        F.count("*").alias("days_seen"),
        mean_where(early).alias("baseline_mean"),
        mean_where(late).alias("recent_mean"),
        F.try_divide(
            F.sum(F.col("_centred") * (F.col("_sum") / F.col("_n"))),
            F.sum(F.col("_centred") * F.col("_day")).cast("double"),
        ).alias("slope_per_day"),
    )
    shift = F.try_divide(F.col("recent_mean") - F.col("baseline_mean"), F.abs("baseline_mean"))
    return out.withColumn("shift_pct", shift * 100).withColumn(
        "is_drifting", F.when(F.abs("shift_pct") > threshold_pct, 1).otherwise(0)
    )


def period_change(
    df: DataFrame, keys: Sequence[str], period: str, measure: str, threshold_pct: float
) -> DataFrame:
    """Change of a measure against the row of the period before, in percent.

    ``df`` is already one row per key and period.
    """
    before = F.lag(measure).over(Window.partitionBy(*keys).orderBy(period))
    change = F.try_divide(F.col(measure) - F.col("previous"), F.abs("previous")) * 100
    return (
        df.withColumn("previous", before)
        .withColumn("change_pct", change)
        .withColumn("is_alert", F.when(F.col("change_pct") > threshold_pct, 1).otherwise(0))
    )


def drop_within(
    df: DataFrame, key: str, day: str, measure: str, days: int, max_drop: float
) -> DataFrame:
    """Rows with the highest value of the last ``days`` days and whether the measure fell from
    it by more than ``max_drop``. ``df`` is one row per key and day."""
    recent = Window.partitionBy(key).orderBy(day_number(day)).rangeBetween(-days, 0)
    return (
        df.withColumn("recent_high", F.max(measure).over(recent))
        .withColumn("drop", F.col("recent_high") - F.col(measure))
        .withColumn("is_alert", F.when(F.col("drop") > max_drop, 1).otherwise(0))
    )


def volume_check(
    df: DataFrame,
    day: str,
    trailing_days: int = 7,
    min_of_average: float = 0.8,
    min_of_previous: float = 0.9,
) -> DataFrame:
    """Rows per day against the average of the days before and against the last day.

    After the daily count the window runs over one row per calendar day.
    """
    daily = df.groupBy(F.col(day).cast("date").alias("day")).agg(F.count("*").alias("row_count"))
    in_order = Window.orderBy("day")
    trailing = F.avg("row_count").over(in_order.rowsBetween(-trailing_days, -1))
    return (
        daily.withColumn("trailing_avg", trailing)
        .withColumn("previous_count", F.lag("row_count").over(in_order))
        .withColumn(
            "is_low_volume",
            F.when(F.col("row_count") < F.col("trailing_avg") * min_of_average, 1).otherwise(0),
        )
        .withColumn(
            "is_sudden_drop",
            F.when(F.col("row_count") < F.col("previous_count") * min_of_previous, 1).otherwise(0),
        )
    )


def sustained_shift(
    df: DataFrame, key: str, day: str, value: str, baseline_days: int, slack: int, limit: int
) -> DataFrame:
    """Change points of a key's daily whole-number value by cumulative sums.

    The reference is the mean of the key's first ``baseline_days`` days, rounded down. Upwards, the sum
    of (value - reference - slack) less its running minimum grows while the value stays high; the first
    day it exceeds ``limit`` is the alarm, and the shift began on the day after that minimum. Downwards
    the same with the sign turned. One row per key and direction with an alarm: ``direction, shift_day,
    alarm_day, reference, excess``. Sums are of whole numbers, so exact; windows run over days.
    """
    in_order = Window.partitionBy(key).orderBy(day)
    ranked = df.withColumn("_rank", F.row_number().over(in_order))
    early = F.when(F.col("_rank") <= baseline_days, F.col(value))
    of_key = Window.partitionBy(key)
    based = ranked.withColumn("_sum", F.sum(early).over(of_key)).withColumn("_n", F.count(early).over(of_key))
    reference = F.floor(F.col("_sum").cast("decimal(38,0)") / F.col("_n")).cast("long")
    stepped = based.withColumn("reference", reference).select(
        key, day, "_rank", "reference",
        F.inline(
            F.array(
                F.struct(F.lit("up").alias("direction"), (F.col(value) - F.col("reference") - slack).alias("_step")),
                F.struct(F.lit("down").alias("direction"), (F.col("reference") - F.col(value) - slack).alias("_step")),
            )
        ),
    )
    path = Window.partitionBy(key, "direction").orderBy(day)
    so_far = path.rowsBetween(Window.unboundedPreceding, 0)
    summed = stepped.withColumn("_total", F.sum("_step").over(so_far))
    # The last day of the least sum so far, with day 0 and sum 0 before the first day.
    low = F.min(F.struct("_total", (-F.col("_rank")).alias("_at"))).over(so_far)
    lowest = summed.withColumn("_low", F.least(low, F.struct(F.lit(0).cast("long").alias("_total"), F.lit(0).alias("_at"))))
    excess = lowest.withColumn("excess", F.col("_total") - F.col("_low._total")).filter(F.col("excess") > limit)
    first = excess.groupBy(key, "direction").agg(
        F.min_by(F.struct(F.col(day).alias("alarm_day"), "reference", "excess", (-F.col("_low._at") + 1).alias("_start")), day).alias("_a")
    ).select(key, "direction", "_a.*")
    days = ranked.select(key, F.col("_rank").alias("_start"), F.col(day).alias("shift_day"))
    return first.join(days, [key, "_start"]).select(key, "direction", "shift_day", "alarm_day", "reference", "excess")
