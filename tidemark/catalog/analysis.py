"""Queries: stored states and sketches, similarity joins, linkage, spliced history, shifts, provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.base import EVENTS_RUN, Tables, query
from tidemark.catalog.lifecycle import FIRST_RUN, SECOND_RUN
from tidemark.catalog import standins as s
from tidemark.operators import governance, history, linkage, monitor, passjoin, resolve, series, states
from tidemark.operators.checks import Check
from tidemark.operators.states import Measure
from tidemark.plans.refresh import Calendar, Lake, Reach
from tidemark.session import work_dir
from tidemark.streaming import jobs

CHECK_DAYS = Calendar(
    day={"bronze_events": "ts", "checks_events": "day"}, reads={"checks_events": {"bronze_events": Reach()}}
)
EVENT_MEASURES = (
    Measure("n", "count"), Measure("n_valued", "count", "value IS NOT NULL"),
    Measure("n_low", "count", "value < 1"), Measure("total", "sum", "CAST(value AS DECIMAL(28, 6))"),
    Measure("least", "min", "value"), Measure("most", "max", "value"), Measure("n_clicks", "count", "event_type = 'click'"),
)
EVENT_CHECKS = (
    Check("row_count", "events", "n", 1000.0),
    Check("value_present_pct", "events", "try_divide(n_valued, n) * 100", 99.0),
    Check("low_values", "events", "n_low", 0.0, False),
    Check("total_value", "events", "total", 0.0),
    Check("least_value", "events", "least", 0.0),
    Check("most_value", "events", "most", 100.0, False),
    Check("click_share_pct", "events", "try_divide(n_clicks, n) * 100", 50.0),
)


@query(
    "dq_states_merged",
    "DQ-01 DQ-02",
    """WITH v AS (SELECT COUNT(*)::DOUBLE AS n, COUNT(value)::DOUBLE AS n_valued, COUNT(*) FILTER (WHERE value < 1)::DOUBLE AS n_low,
      CAST(SUM(CAST(value AS DECIMAL(28, 6))) AS DOUBLE) AS total, MIN(value) AS least, MAX(value) AS most,
      COUNT(*) FILTER (WHERE event_type = 'click')::DOUBLE AS n_clicks FROM events),
    c AS (SELECT 'row_count' AS check_name, n AS value, 1000.0::DOUBLE AS threshold, n >= 1000 AS passed FROM v
      UNION ALL SELECT 'value_present_pct', n_valued / n * 100, 99, n_valued / n * 100 >= 99 FROM v
      UNION ALL SELECT 'low_values', n_low, 0, n_low <= 0 FROM v UNION ALL SELECT 'total_value', total, 0, total >= 0 FROM v
      UNION ALL SELECT 'least_value', least, 0, least >= 0 FROM v UNION ALL SELECT 'most_value', most, 100, most <= 100 FROM v
      UNION ALL SELECT 'click_share_pct', n_clicks / n * 100, 50, n_clicks / n * 100 >= 50 FROM v)
    SELECT check_name, round(value, 4) AS value, threshold, passed, CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status FROM c""",
)
def dq_states_merged(t: Tables) -> DataFrame:
    """Two batches; the second computes the states of its days only, and the suite reads states alone."""
    lake = Lake(t.spark, work_dir(t.spark, "states"), CHECK_DAYS)
    rows = t.events.select("event_id", "event_type", "ts", "value")
    late = F.to_date("ts") >= F.lit("2024-01-20").cast("date")
    build = lambda d: states.build_states(d["bronze_events"], EVENT_MEASURES, F.to_date("ts").alias("day"))
    for run, batch in ((FIRST_RUN, rows.filter(~late)), (SECOND_RUN, rows.filter(late))):
        lake.publish_batch("bronze_events", batch.withColumn("_batch_id", F.lit(run.batch_id)), run, False)
        lake.refresh_days("checks_events", {"bronze_events": lake.read("bronze_events")}, build, run)
    return states.suite_from_states({"events": (lake.read("checks_events"), EVENT_MEASURES)}, EVENT_CHECKS)


SKETCHES = (Measure("n", "count"), Measure("users", "distinct", "user_id"), Measure("spread", "quantiles", "value"))


@query(
    "sketch_ranges",
    "AGG-04 AGG-18",
    """SELECT event_type, date_trunc('week', ts)::DATE AS week, COUNT(*) AS n_events, COUNT(DISTINCT user_id) AS exact_users,
      TRUE AS users_within, TRUE AS median_within FROM events GROUP BY 1, 2""",
)
def sketch_ranges(t: Tables) -> DataFrame:
    """Weeks answered from stored sketches of days, beside the exact figures and within their error.

    Bounds are four standard errors for the distinct count and the stated rank error for the median.
    """
    daily = states.build_states(t.events, SKETCHES, "event_type", F.to_date("ts").alias("day"))
    stored = t.keep(daily, "sketches")
    week = F.to_date(F.date_trunc("week", "day")).alias("week")
    merged = states.merge_states(stored, SKETCHES, "event_type", week).select(
        "event_type", "week", "n", states.distinct_of("users").alias("users"),
        states.quantile_of("spread", 0.5).alias("median"),
    )
    rows = t.events.select("event_type", F.to_date(F.date_trunc("week", "ts")).alias("week"), "user_id", "value")
    ranked = rows.join(merged, ["event_type", "week"]).groupBy("event_type", "week", "n", "users", "median").agg(
        F.countDistinct("user_id").alias("exact_users"),
        F.count_if(F.col("value") < F.col("median")).alias("below"), F.count_if(F.col("value") <= F.col("median")).alias("upto"),
    )
    slack = F.col("n") * states.KLL_ERROR * 2 + 1
    return ranked.select(
        "event_type", "week", F.col("n").alias("n_events"), "exact_users",
        (F.abs(F.col("users") - F.col("exact_users")) <= F.col("exact_users") * 4 * states.HLL_ERROR + 1).alias("users_within"),
        ((F.col("below") <= F.col("n") / 2 + slack) & (F.col("upto") >= F.col("n") / 2 - slack)).alias("median_within"),
    )


@query(
    "edit_join",
    "JOI-13",
    """WITH x AS (SELECT DISTINCT p_name || ' ' || p_brand AS t FROM part)
    SELECT a.t AS left_text, b.t AS right_text, levenshtein(a.t, b.t)::INTEGER AS distance
    FROM x a JOIN x b ON a.t < b.t AND abs(len(a.t) - len(b.t)) <= 4 WHERE levenshtein(a.t, b.t) <= 4""",
)
def edit_join(t: Tables) -> DataFrame:
    """All pairs of distinct part descriptions within four edits."""
    texts = t.part.select(F.concat_ws(" ", "p_name", "p_brand").alias("t"))
    return passjoin.similar_pairs(texts, "t", 4).select(
        F.col("left").alias("left_text"), F.col("right").alias("right_text"), "distance"
    )


# Fixed weights that stand for fitted ones where the records they join are checked.
PART_WEIGHTS = {"p_name": (-4.0, 1.0, 5.0), "p_brand": (-3.0, 4.0), "p_type": (-2.0, 2.0), "p_size": (-1.0, 5.0)}
PART_LIMIT = 12.0


def part_fields() -> list[linkage.Field]:
    return [
        linkage.Field("p_name", F.col("p_name"), F.substring_index("p_name", " ", -1)), linkage.Field("p_brand", F.col("p_brand")),
        linkage.Field("p_type", F.col("p_type")), linkage.Field("p_size", F.col("p_size")),
    ]


@query(
    "weighted_links",
    "JOI-13",
    """WITH RECURSIVE p AS (SELECT p_partkey AS k, p_name, p_brand, p_type, p_size, regexp_extract(p_name, '[^ ]*$') AS tail FROM part),
    links AS (SELECT a.k AS u, b.k AS v FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.k <> b.k
      WHERE CASE WHEN a.p_name = b.p_name THEN 5 WHEN a.tail = b.tail THEN 1 ELSE -4 END + 4 + 5
        + CASE WHEN a.p_type = b.p_type THEN 2 ELSE -2 END >= 12),
    reach(u, v) AS (SELECT k, k FROM p UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
    SELECT u AS p_partkey, MIN(v) AS golden_id FROM reach GROUP BY 1""",
)
def weighted_links(t: Tables) -> DataFrame:
    """Parts whose agreement reaches the limit, as groups named by their smallest key."""
    fields = part_fields()
    weight = lambda p: sum(PART_WEIGHTS[f.name][x] for f, x in zip(fields, p, strict=True))
    links = linkage.match_links(t.part, "p_partkey", fields, weight, PART_LIMIT)
    nodes = t.part.select(F.col("p_partkey").alias("node"))
    return resolve.components(nodes, links).select(F.col("node").alias("p_partkey"), F.col("component").alias("golden_id"))


@query(
    "agreement_patterns",
    "JOI-13",
    """WITH p AS (SELECT p_partkey AS k, p_name, p_brand, p_type, p_size, regexp_extract(p_name, '[^ ]*$') AS tail FROM part)
    SELECT CASE WHEN a.p_name = b.p_name THEN 2 WHEN a.tail = b.tail THEN 1 ELSE 0 END AS p_name,
      (a.p_brand = b.p_brand)::INTEGER AS p_brand, (a.p_type = b.p_type)::INTEGER AS p_type, (a.p_size = b.p_size)::INTEGER AS p_size,
      COUNT(*) AS n_pairs FROM p a JOIN p b ON a.k < b.k GROUP BY ALL""",
)
def agreement_patterns(t: Tables) -> DataFrame:
    """How many pairs of parts agree how far; counted from groups, no pair is formed."""
    counts = linkage.pattern_counts(t.part, part_fields())
    rows = [(*p, n) for p, n in counts.items() if n]
    return t.spark.createDataFrame(rows, "p_name int, p_brand int, p_type int, p_size int, n_pairs bigint")


@query(
    "scd2_spliced",
    "WIN-10",
    """WITH daily AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, arg_max(o_orderpriority, o_orderkey) AS p FROM orders GROUP BY 1, 2),
    marked AS (SELECT *, p IS DISTINCT FROM lag(p) OVER w OR lag(d) OVER w IS NULL AS is_new FROM daily WINDOW w AS (PARTITION BY o_custkey ORDER BY d)),
    starts AS (SELECT * FROM marked WHERE is_new)
    SELECT o_custkey, p AS o_orderpriority, d AS valid_from, lead(d) OVER w AS valid_to,
      CAST(row_number() OVER w AS INTEGER) AS version, CASE WHEN lead(d) OVER w IS NULL THEN 1 ELSE 0 END AS is_current
    FROM starts WINDOW w AS (PARTITION BY o_custkey ORDER BY d)""",
)
def scd2_spliced(t: Tables) -> DataFrame:
    """A history from three batches that arrive out of order, the second and third spliced in."""
    what = ("o_custkey", "o_orderdate", "o_orderkey", ["o_orderpriority"])
    batches = [t.orders.filter(F.col("o_orderkey") % 3 == k) for k in (2, 0, 1)]
    spliced = t.keep(history.start_history(batches[0], *what), "history")
    for batch in batches[1:]:
        spliced = t.keep(history.splice_history(spliced, batch, *what), "history")
    return spliced.drop("seen")


@query(
    "sustained_shifts",
    "WIN-12",
    """WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS d, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS v FROM events GROUP BY 1, 2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY d) AS r FROM daily),
    based AS (SELECT *, CAST(SUM(v) FILTER (r <= 7) OVER (PARTITION BY user_id) AS BIGINT) // COUNT(*) FILTER (r <= 7) OVER (PARTITION BY user_id) AS reference FROM ranked),
    stepped AS (SELECT user_id, d, r, reference, 'up' AS direction, v - reference - 2000 AS step FROM based
      UNION ALL SELECT user_id, d, r, reference, 'down', reference - v - 2000 FROM based),
    summed AS (SELECT *, SUM(step) OVER (PARTITION BY user_id, direction ORDER BY d) AS total FROM stepped),
    points AS (SELECT user_id, direction, r, total FROM summed UNION ALL SELECT DISTINCT user_id, direction, 0, 0 FROM summed),
    lows AS (SELECT a.user_id, a.direction, a.r, MIN(b.total) AS low, arg_max(b.r, (-b.total, b.r)) AS low_r
      FROM summed a JOIN points b ON a.user_id = b.user_id AND a.direction = b.direction AND b.r <= a.r GROUP BY 1, 2, 3),
    alarms AS (SELECT s.*, total - low AS excess, low_r FROM summed s JOIN lows USING (user_id, direction, r) WHERE total - low > 10000),
    first AS (SELECT * FROM alarms QUALIFY row_number() OVER (PARTITION BY user_id, direction ORDER BY d) = 1)
    SELECT f.user_id, f.direction, k.d AS shift_day, f.d AS alarm_day, f.reference, CAST(f.excess AS BIGINT) AS excess
    FROM first f JOIN ranked k ON k.user_id = f.user_id AND k.r = f.low_r + 1""",
)
def sustained_shifts(t: Tables) -> DataFrame:
    """Users whose daily value moved up or down for good, with the first day of the move."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sum(cents).alias("v"))
    return series.sustained_shift(daily, "user_id", "day", "v", 7, 2000, 10_000)


@query(
    "ks_two_periods",
    "DQ-09",
    """WITH x AS (SELECT value, CAST(ts AS DATE) >= DATE '2024-01-16' AS late FROM events WHERE value IS NOT NULL),
    n AS (SELECT COUNT(*) FILTER (NOT late) AS a, COUNT(*) FILTER (late) AS b FROM x),
    c AS (SELECT DISTINCT value, COUNT(*) FILTER (NOT late) OVER (ORDER BY value) AS ca, COUNT(*) FILTER (late) OVER (ORDER BY value) AS cb FROM x),
    g AS (SELECT MAX(abs(ca * b - cb * a)) AS gap FROM c, n),
    r AS (SELECT a AS n_first, b AS n_second, gap::DOUBLE / (a::DOUBLE * b::DOUBLE) AS distance,
      1.358 * sqrt((a::DOUBLE + b::DOUBLE) / (a::DOUBLE * b::DOUBLE)) AS critical FROM n, g)
    SELECT *, distance > critical AS differs FROM r""",
)
def ks_two_periods(t: Tables) -> DataFrame:
    return monitor.ks_distance(t.events, "value", F.to_date("ts") >= F.lit("2024-01-16").cast("date"))


@query(
    "provenance_bitmaps",
    "GOV-04",
    """WITH b AS (SELECT user_id, strftime(ts, '%Y%m%d') || '_060000' AS batch, value FROM events)
    SELECT user_id, COUNT(*) AS n_events, string_agg(DISTINCT batch, ',' ORDER BY batch) AS batches,
      COUNT(DISTINCT batch) AS n_batches FROM b GROUP BY 1""",
)
def provenance_bitmaps(t: Tables) -> DataFrame:
    """Every batch behind a user's row, carried as bits through two steps of aggregation."""
    rows = t.events.select("user_id", "event_type", F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("_060000")).alias("_batch_id"))
    dictionary = t.keep(governance.batch_dictionary(rows), "batches")
    numbered = governance.numbered_batches(rows, dictionary)
    by_type = numbered.groupBy("user_id", "event_type", "_bucket").agg(F.count("*").alias("n"), governance.batches_of())
    by_user = by_type.groupBy("user_id", "_bucket").agg(F.sum("n").alias("n"), governance.merged_batches())
    named = governance.batch_names(by_user, dictionary)
    whole = named.groupBy("user_id").agg(
        F.sum("n").alias("n_events"), F.array_sort(F.flatten(F.collect_list("batch_ids"))).alias("b")
    )
    return whole.select(
        "user_id", "n_events", F.array_join("b", ",").alias("batches"), F.size("b").cast("bigint").alias("n_batches")
    )


@query(
    "stream_hours_final",
    "STR-02",
    """SELECT user_id, date_trunc('hour', ts) AS reading_hour, COUNT(*) AS reading_count,
      COUNT(*) FILTER (WHERE value >= 1 AND value <= 225) AS valid_count,
      COUNT(*) FILTER (WHERE (value >= 1 AND value < 5) OR (value > 115 AND value <= 225)) AS anomaly_count,
      COUNT(*) FILTER (WHERE value < 1 OR value > 225) AS outlier_count FROM events GROUP BY 1, 2""",
)
def stream_hours_final(t: Tables) -> DataFrame:
    """All hours of an available-now run, those that the watermark has not closed too."""
    root = work_dir(t.spark, "stream-final")
    stream = jobs.table_stream(t.spark, t.path("events"), t.events.schema)
    hourly = jobs.validate_stream(stream, EVENTS_RUN, "event_id", "user_id", "ts", "value", s.LIMITS)
    jobs.upsert_hours(hourly, f"{root}/hours", f"{root}/checkpoint").awaitTermination()
    return jobs.current_hours(t.spark, f"{root}/hours", hourly.schema, "user_id")
