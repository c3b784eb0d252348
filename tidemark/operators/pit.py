"""Point-in-time rolling features of an entity's own earlier events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.timeline import day_number

NEVER = 999


def pit_rolling(
    df: DataFrame,
    key: str,
    day: str,
    event_id: str,
    amount: str,
    category: str,
    label: str,
    days: int = 30,
    short_days: int = 7,
    strict: bool = False,
    never: int = NEVER,
    scale: int = 6,
) -> DataFrame:
    """``df`` plus features of the other events of the same key in the last ``days`` days.

    The window is day-grained and closed at both ends: an event sees the other events of its
    own day, never itself. ``strict`` ends the window on the day before. Adds ``tx_count``,
    ``avg_amount``, ``max_amount``, ``total_amount``, ``short_tx_count``, ``days_since_last``
    (``never`` if there is none), ``distinct_categories`` and ``prior_labels``.

    No events are paired. Events are reduced to days with map-side aggregation, windows run
    over days (bounded by the calendar, not by the size of a key), and an event's own share
    is taken out afterwards: its count, its amount, the largest amount if it holds it, and
    its category if nothing else in the window has it. Amounts are summed as whole numbers of
    their last digit, so taking one out is exact; an amount with more than ``scale`` digits
    stops the job, it is never rounded.
    """
    units = 10**scale
    whole = F.round(F.col(amount) * units).cast("long")
    finer = F.raise_error(F.lit(f"{amount} has more than {scale} digits after the point"))
    exact = F.when(F.col(amount).isNull() | (whole / units == F.col(amount)), whole).otherwise(finer)
    events = df.withColumn("_day", day_number(day)).withColumn("_amount", exact)
    mark = F.coalesce(F.col(label).cast("int"), F.lit(0))
    usable = events.dropna(subset=[key, "_day"])
    ends = -1 if strict else 0

    by_category = usable.groupBy(key, "_day", F.col(category).alias("_category")).agg(
        F.count("*").alias("_n"),
        F.count("_amount").alias("_n_amount"),
        F.sum("_amount").alias("_sum"),
        F.sum(mark).alias("_labels"),
        F.max("_amount").alias("_first"),
    )
    same_category = Window.partitionBy(key, "_category").orderBy("_day")
    by_category = by_category.select(
        "*",
        F.sum("_n").over(same_category.rangeBetween(-days, ends)).alias("_same_category"),
        F.lead("_day").over(same_category).alias("_next"),
    )

    # A category counts from its day (strict: the day after) until the window has left that
    # day or the category occurs again; the running sum of these steps is the distinct count.
    shift = 1 if strict else 0
    named = F.col("_category").isNotNull()
    leaves = F.least(F.col("_day") + days + 1, F.col("_next") + shift)
    names = ("_n", "_n_amount", "_sum", "_labels", "_first")
    nothing = [F.lit(None).cast("long") for _ in names]
    counted = [F.col(n) for n in names]

    def entry(at: Column, totals: list[Column], step: Column) -> Column:
        return F.struct(
            at.alias("_day"),
            *[t.alias(n) for t, n in zip(totals, names)],
            F.when(named, step).alias("_step"),
        )

    entries = [entry(leaves, nothing, F.lit(-1))]
    if strict:
        entries.append(entry(F.col("_day"), counted, F.lit(0)))
        entries.append(entry(F.col("_day") + shift, nothing, F.lit(1)))
    else:
        entries.append(entry(F.col("_day"), counted, F.lit(1)))

    parts = by_category.select(
        key, F.inline(F.array(*entries)), F.lit(None).cast("long").alias("_second")
    )
    if not strict:
        # With the two largest amounts of a day, the largest without any one event is known.
        largest = Window.partitionBy(key, "_day").orderBy(F.col("_amount").desc(), event_id)
        runner_up = (
            usable.dropna(subset=["_amount"])
            .select(key, "_day", "_amount", event_id)
            .withColumn("_rank", F.row_number().over(largest))
            .filter("_rank = 2")
            .select(key, "_day", F.col("_amount").alias("_second"))
        )
        parts = parts.unionByName(runner_up, allowMissingColumns=True)
    per_day = parts.groupBy(key, "_day").agg(
        *[F.sum(c).alias(c) for c in ("_n", "_n_amount", "_sum", "_labels", "_step")],
        *[F.max(c).alias(c) for c in ("_first", "_second")],
    )

    by_day = Window.partitionBy(key).orderBy("_day")
    recent = by_day.rangeBetween(-days, ends)
    earlier = by_day.rangeBetween(-days, -1)
    to_date = by_day.rangeBetween(Window.unboundedPreceding, 0)
    # Days that only close a category are needed for the running count and dropped after it.
    counted_days = per_day.withColumn("_distinct", F.sum("_step").over(to_date)).filter("_n > 0")
    rolled = counted_days.select(
        key,
        "_day",
        F.col("_n").alias("_today"),
        "_first",
        "_second",
        "_distinct",
        F.sum("_n").over(recent).alias("_n"),
        F.sum("_n_amount").over(recent).alias("_n_amount"),
        F.sum("_sum").over(recent).alias("_sum"),
        F.sum("_labels").over(recent).alias("_labels"),
        F.sum("_n").over(by_day.rangeBetween(-short_days, ends)).alias("_short"),
        F.max("_first").over(earlier).alias("_earlier_largest"),
        F.max("_day").over(earlier).alias("_previous_day"),
    )

    lookup = rolled
    same_row = (F.col(f"e.{key}") == F.col(f"r.{key}")) & (F.col("e._day") == F.col("r._day"))
    if not strict:
        lookup = rolled.join(
            by_category.select(key, "_day", "_category", "_same_category"), [key, "_day"]
        )
        same_row &= F.col(f"e.{category}").eqNullSafe(F.col("r._category"))
    joined = events.alias("e").join(lookup.alias("r"), same_row, "left")

    own = 0 if strict else 1
    zero = F.lit(0)
    own_amount = zero if strict else F.coalesce(F.col("e._amount"), zero)
    own_amounts = zero if strict else F.col("e._amount").isNotNull().cast("int")
    total = F.coalesce(F.col("_sum") - own_amount, zero)
    amounts = F.col("_n_amount") - own_amounts
    own_label = zero if strict else F.coalesce(F.col(f"e.{label}").cast("int"), zero)
    largest_other = F.col("_earlier_largest")
    only_one = F.lit(False)
    same_day = F.lit(False)
    if not strict:
        # An event is of today, so today's second amount stands in where it is the first.
        is_first = F.coalesce(F.col("e._amount") == F.col("_first"), F.lit(False))
        rest_of_today = F.when(is_first, F.col("_second")).otherwise(F.col("_first"))
        largest_other = F.greatest(largest_other, rest_of_today)
        only_one = F.col("_category").isNotNull() & (F.col("_same_category") == 1)
        same_day = F.col("_today") > 1

    def count(value: Column) -> Column:
        return F.coalesce(value, zero).cast("long")

    return joined.select(
        *[F.col(f"e.{c}").alias(c) for c in df.columns],
        count(F.col("_n") - own).alias("tx_count"),
        F.coalesce(F.try_divide(total / float(units), amounts.cast("double")), F.lit(0.0)).alias(
            "avg_amount"
        ),
        F.coalesce(largest_other / float(units), F.lit(0.0)).alias("max_amount"),
        (total / float(units)).alias("total_amount"),
        count(F.col("_short") - own).alias("short_tx_count"),
        F.when(same_day, 0)
        .otherwise(F.coalesce(F.col("e._day") - F.col("_previous_day"), F.lit(never)))
        .alias("days_since_last"),
        count(F.col("_distinct") - only_one.cast("int")).alias("distinct_categories"),
        count(F.col("_labels") - own_label).alias("prior_labels"),
    )
