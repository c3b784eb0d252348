"""Queries: time series, history, entity resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog import products as p, standins as s
from tidemark.catalog.base import Tables, query
from tidemark.operators import history, resolve, series, timeline


def _readings(t: Tables) -> DataFrame:
    return s.asset_silver(t)["silver_sensors_clean"]


@query(
    "gap_detection",
    "WIN-06",
    "WITH " + s.READINGS_SQL + """
    SELECT sensor_id, before AS last_seen_hour, reading_hour, missing AS gap_hours FROM (
      SELECT *, date_diff('hour', before, reading_hour) - 1 AS missing FROM (
        SELECT sensor_id, reading_hour, lag(reading_hour) OVER (PARTITION BY sensor_id ORDER BY reading_hour) AS before
        FROM (SELECT DISTINCT sensor_id, reading_hour FROM readings))) WHERE missing >= 2""",
)
def gap_detection(t: Tables) -> DataFrame:
    return series.gaps(_readings(t), "sensor_id", "reading_timestamp")


@query(
    "gap_aware_mean",
    "WIN-07 DQ-08",
    "WITH " + s.READINGS_SQL + """
    , hours AS (SELECT asset_id, reading_hour, SUM(value) FILTER (WHERE valid = 1) AS total,
        COUNT(*) FILTER (WHERE valid = 1) AS n FROM readings GROUP BY 1, 2),
    rolled AS (SELECT a.asset_id, a.reading_hour, SUM(b.total) AS total, CAST(SUM(b.n) AS BIGINT) AS n
      FROM hours a JOIN hours b ON b.asset_id = a.asset_id AND b.reading_hour <= a.reading_hour
        AND b.reading_hour > a.reading_hour - INTERVAL 24 HOUR GROUP BY 1, 2)
    SELECT asset_id, reading_hour, n AS valid_readings, round(least(100, n * 100.0 / 24), 8) AS completeness_pct,
      CASE WHEN n >= 12 THEN round(total / n, 8) END AS rolling_mean FROM rolled""",
)
def gap_aware_mean(t: Tables) -> DataFrame:
    out = series.gap_aware_mean(
        _readings(t), "asset_id", "reading_timestamp", "reading_value", "dq_reading_valid"
    )
    return p.rounded(out, 8, "completeness_pct", "rolling_mean")


@query(
    "hourly_grid",
    "WIN-11",
    "WITH " + s.READINGS_SQL + """
    , hours AS (SELECT asset_id, reading_hour, COUNT(*) AS n FROM readings GROUP BY 1, 2),
    grid AS (SELECT asset_id, unnest(generate_series(MIN(reading_hour), MAX(reading_hour), INTERVAL 1 HOUR)) AS reading_hour
      FROM hours GROUP BY 1)
    SELECT asset_id, reading_hour, COALESCE(n, 0) AS reading_count, CAST(n IS NULL AS INTEGER) AS is_missing
    FROM grid LEFT JOIN hours USING (asset_id, reading_hour)""",
)
def hourly_grid(t: Tables) -> DataFrame:
    return series.densify_hours(_readings(t), "asset_id", "reading_timestamp")


@query(
    "sensor_drift",
    "WIN-12",
    "WITH " + s.READINGS_SQL + """
    , days AS (SELECT sensor_id, CAST(ts AS DATE) AS d, SUM(value) AS total, COUNT(*) AS n FROM readings GROUP BY 1, 2),
    edges AS (SELECT sensor_id, MIN(d) AS first_day, MAX(d) AS last_day FROM days GROUP BY 1),
    levels AS (SELECT sensor_id, COUNT(*) AS days_seen,
        SUM(total) FILTER (WHERE d < first_day + 7) / SUM(n) FILTER (WHERE d < first_day + 7) AS early,
        SUM(total) FILTER (WHERE d > last_day - 7) / SUM(n) FILTER (WHERE d > last_day - 7) AS late,
        regr_slope(total / n, date_diff('day', DATE '1970-01-01', d)) AS slope
      FROM days JOIN edges USING (sensor_id) GROUP BY 1)
    SELECT sensor_id, days_seen, round(early, 8) AS baseline_mean, round(late, 8) AS recent_mean,
      round(slope, 10) AS slope_per_day, round(100 * (late - early) / abs(early), 4) AS shift_pct,
      CAST(abs(100 * (late - early) / abs(early)) > 10 AS INTEGER) AS is_drifting FROM levels""",
)
def sensor_drift(t: Tables) -> DataFrame:
    out = series.sensor_drift(_readings(t), "sensor_id", "reading_timestamp", "reading_value")
    out = p.rounded(p.rounded(out, 8, "baseline_mean", "recent_mean"), 10, "slope_per_day")
    return p.rounded(out, 4, "shift_pct")


@query(
    "week_over_week",
    "WIN-08",
    "WITH " + s.READINGS_SQL + """
    , weeks AS (SELECT sensor_type, CAST(date_trunc('week', ts) AS DATE) AS week,
        100.0 * SUM(anomaly) / COUNT(*) AS anomaly_rate FROM readings GROUP BY 1, 2),
    steps AS (SELECT *, lag(anomaly_rate) OVER (PARTITION BY sensor_type ORDER BY week) AS before FROM weeks)
    SELECT sensor_type, week, round(anomaly_rate, 8) AS anomaly_rate, round(before, 8) AS previous,
      round(100 * (anomaly_rate - before) / abs(nullif(before, 0)), 4) AS change_pct,
      CAST(COALESCE(100 * (anomaly_rate - before) / abs(nullif(before, 0)) > 10, FALSE) AS INTEGER) AS is_alert FROM steps""",
)
def week_over_week(t: Tables) -> DataFrame:
    weekly = _readings(t).groupBy(
        "sensor_type", F.trunc("reading_timestamp", "week").alias("week")
    ).agg((F.sum("is_anomaly") * 100.0 / F.count("*")).alias("anomaly_rate"))
    out = series.period_change(weekly, ["sensor_type"], "week", "anomaly_rate", 10.0)
    return p.rounded(p.rounded(out, 8, "anomaly_rate", "previous"), 4, "change_pct")


@query(
    "health_drop",
    "WIN-08",
    "WITH " + s.READINGS_SQL + """
    , days AS (SELECT asset_id, CAST(ts AS DATE) AS day, round(100.0 * SUM(valid) / COUNT(*), 4) AS health
        FROM readings GROUP BY 1, 2)
    SELECT a.asset_id, a.day, a.health, MAX(b.health) AS recent_high, round(MAX(b.health) - a.health, 4) AS "drop",
      CAST(MAX(b.health) - a.health > 20 AS INTEGER) AS is_alert
    FROM days a JOIN days b ON b.asset_id = a.asset_id AND b.day <= a.day AND b.day >= a.day - 7
    GROUP BY a.asset_id, a.day, a.health""",
)
def health_drop(t: Tables) -> DataFrame:
    daily = _readings(t).groupBy(
        "asset_id", F.to_date("reading_timestamp").alias("day")
    ).agg(F.round(F.sum("dq_reading_valid") * 100.0 / F.count("*"), 4).alias("health"))
    return p.rounded(series.drop_within(daily, "asset_id", "day", "health", 7, 20.0), 4, "drop")


@query(
    "volume_vs_trailing",
    "WIN-09",
    """WITH days AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS row_count FROM events GROUP BY 1),
    steps AS (SELECT *, AVG(row_count) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS mean,
      lag(row_count) OVER (ORDER BY day) AS before FROM days)
    SELECT day, row_count, round(mean, 8) AS trailing_avg, before AS previous_count,
      CAST(COALESCE(row_count < 0.8 * mean, FALSE) AS INTEGER) AS is_low_volume,
      CAST(COALESCE(row_count < 0.9 * before, FALSE) AS INTEGER) AS is_sudden_drop FROM steps""",
)
def volume_vs_trailing(t: Tables) -> DataFrame:
    return p.rounded(series.volume_check(t.events, "ts"), 8, "trailing_avg")


SCD2_SQL = """
daily AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS valid_from, o_orderstatus, o_orderpriority FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS pick FROM orders)
  WHERE pick = 1),
changed AS (SELECT * FROM (SELECT *, lag(o_orderstatus) OVER w AS s0, lag(o_orderpriority) OVER w AS p0 FROM daily
    WINDOW w AS (PARTITION BY o_custkey ORDER BY valid_from))
  WHERE s0 IS NULL OR s0 <> o_orderstatus OR p0 <> o_orderpriority),
versions AS (SELECT o_custkey, o_orderstatus, o_orderpriority, valid_from,
    lead(valid_from) OVER w AS valid_to, CAST(row_number() OVER w AS INTEGER) AS version,
    CAST(lead(valid_from) OVER w IS NULL AS INTEGER) AS is_current FROM changed
    WINDOW w AS (PARTITION BY o_custkey ORDER BY valid_from))"""


def _versions(t: Tables) -> DataFrame:
    return history.scd2(
        t.orders, "o_custkey", "o_orderdate", "o_orderkey", ["o_orderstatus", "o_orderpriority"]
    )


query("scd2_history", "WIN-10", "WITH " + SCD2_SQL + " SELECT * FROM versions")(_versions)


@query(
    "scd2_asof",
    "JOI-12",
    "WITH " + SCD2_SQL + """
    SELECT o.o_orderkey, v.o_orderstatus AS status_then, v.version AS version_then
    FROM orders o LEFT JOIN versions v ON v.o_custkey = o.o_custkey
      AND v.valid_from <= CAST(o.o_orderdate AS DATE) - 30
      AND (v.valid_to IS NULL OR CAST(o.o_orderdate AS DATE) - 30 < v.valid_to)""",
)
def scd2_asof(t: Tables) -> DataFrame:
    """The version of each customer that was valid 30 days before each order."""
    facts = t.orders.select(
        "o_orderkey", "o_custkey", F.date_sub(F.to_date("o_orderdate"), 30).alias("asked_on")
    )
    versions = _versions(t).select(
        "o_custkey",
        "valid_from",
        "valid_to",
        F.col("o_orderstatus").alias("status_then"),
        F.col("version").alias("version_then"),
    )
    return timeline.attach_asof(
        facts, versions, "o_custkey", "asked_on", "valid_from", ["status_then", "version_then"],
        "valid_to",
    ).select("o_orderkey", "status_then", "version_then")


@query(
    "er_candidates",
    "JOI-13",
    """WITH names AS (SELECT DISTINCT p_type AS block, p_name AS text FROM part)
    SELECT a.block, a.text, MIN(b.text) AS match_text,
      CAST(levenshtein(a.text, MIN(b.text)) AS INTEGER) AS distance
    FROM names a JOIN names b ON a.block = b.block AND a.text <> b.text AND levenshtein(a.text, b.text) <= 2
    GROUP BY 1, 2""",
)
def er_candidates(t: Tables) -> DataFrame:
    return resolve.closest_smaller_text(t.part, "p_name", 2, F.col("p_type"))


@query(
    "er_golden",
    "JOI-13",
    """WITH RECURSIVE names AS (SELECT p_name AS text, COUNT(*) AS n, MIN(p_partkey) AS id,
        MAX(p_retailprice) AS price FROM part GROUP BY 1),
    links AS (SELECT a.text AS a, b.text AS b FROM names a JOIN names b ON levenshtein(a.text, b.text) <= 2),
    reach AS (SELECT text AS node, text AS root FROM names
      UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node),
    groups AS (SELECT node, MIN(root) AS component FROM reach GROUP BY 1),
    members AS (SELECT names.*, component, row_number() OVER (PARTITION BY component ORDER BY n DESC, text) AS place
      FROM names JOIN groups ON node = text)
    SELECT MIN(id) AS golden_id, MAX(text) FILTER (WHERE place = 1) AS golden_name, COUNT(*) AS spelling_count,
      CAST(SUM(n) AS BIGINT) AS record_count, MAX(price) AS highest_price FROM members GROUP BY component""",
)
def er_golden(t: Tables) -> DataFrame:
    return resolve.golden_records(
        t.part, "p_partkey", "p_name", 2, survivors={"highest_price": F.max("p_retailprice")}
    )
