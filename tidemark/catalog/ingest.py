"""Queries: reading, stamping, writing, standardising."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog import standins as s
from tidemark.catalog.base import EVENTS_RUN, ORDERS_RUN, Tables, query
from tidemark.context import RunContext
from tidemark.functions import flags
from tidemark.functions.scoring import money_sum
from tidemark.operators import keyed, quarantine
from tidemark.operators.governance import forbidden_columns
from tidemark.plans import asset, provider
from tidemark.session import work_dir
from tidemark.sources import bronze
from tidemark.sources.extracts import SourceSpec

LINEAGE_SQL = (
    "'20240131_060000' AS _batch_id, TIMESTAMP '2024-01-31 06:00:00' AS _load_ts"
)


@query(
    "bronze_lineage",
    "SRC-02",
    f"""SELECT event_id, user_id, event_type, value, {LINEAGE_SQL},
        'device_events.csv' AS _source_file, 'DEVICE' AS _source_system FROM events""",
)
def bronze_lineage(t: Tables) -> DataFrame:
    raw = t.events.select("event_id", "user_id", "event_type", "value")
    return bronze.with_lineage(raw, EVENTS_RUN, "device_events.csv")


@query(
    "bronze_csv_ingest",
    "SRC-01 SRC-02 SRC-03 SRC-04",
    """SELECT s_suppkey, s_name, s_nationkey, s_acctbal, '20010802_060000' AS _batch_id,
       TIMESTAMP '2001-08-02 06:00:00' AS _load_ts, 'supplier_master.csv' AS _source_file,
       'SUPPLIER' AS _source_system FROM supplier""",
)
def bronze_csv_ingest(t: Tables) -> DataFrame:
    """The supplier table written as a delimited extract, ingested, and read back as Parquet."""
    root = work_dir(t.spark, "csv-ingest")
    t.supplier.write.option("header", True).csv(f"{root}/raw/supplier_master.csv")
    spec = SourceSpec(
        "bronze_suppliers",
        "supplier_master.csv",
        "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    )
    absent = SourceSpec("bronze_absent", "absent.csv", "x INT")
    tables = bronze.ingest(t.spark, [spec, absent], f"{root}/raw", ORDERS_RUN)
    path = bronze.write_table(tables["bronze_suppliers"], root, "bronze", "bronze_suppliers")
    return t.spark.read.parquet(path)


@query(
    "damaged_lines",
    "SRC-01 SIL-18",
    """WITH l AS (SELECT s_suppkey, s_suppkey % 7 = 0 AS broken, s_suppkey % 11 = 0 AS cut FROM supplier)
    SELECT CASE WHEN broken OR cut THEN 'open' ELSE 'loaded' END AS state, COUNT(*) AS n_lines,
      CAST(SUM(s_suppkey) AS BIGINT) AS key_sum FROM l GROUP BY 1""",
)
def damaged_lines(t: Tables) -> DataFrame:
    """An extract in which some cells do not parse and some lines are cut short: those lines wait in
    the quarantine, the others are loaded."""
    root = work_dir(t.spark, "damaged")
    key = F.col("s_suppkey").cast("string")
    balance = F.when(F.col("s_suppkey") % 7 == 0, "n/a").otherwise(F.col("s_acctbal").cast("string"))
    line = F.when(F.col("s_suppkey") % 11 == 0, F.concat_ws(",", key, "s_name")).otherwise(
        F.concat_ws(",", key, "s_name", F.col("s_nationkey").cast("string"), balance)
    )
    spec = SourceSpec(
        "bronze_suppliers", "supplier_master.csv", "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"
    )
    head = "s_suppkey,s_name,s_nationkey,s_acctbal"
    t.supplier.select(line.alias(head)).write.option("header", True).option("quote", "\u0000").option(
        "sep", "\u0001"
    ).csv(f"{root}/{spec.file}")
    loaded = bronze.ingest(t.spark, [spec], root, ORDERS_RUN)[spec.table].select(
        F.lit("loaded").alias("state"), "s_suppkey"
    )
    damaged = bronze.ingest_damaged(t.spark, [spec], root, ORDERS_RUN)[spec.table]
    ledger = quarantine.unreadable(damaged, bronze.DAMAGED, ORDERS_RUN)
    first_cell = F.split_part(F.get_json_object("payload", f"$.{bronze.DAMAGED}"), F.lit(","), F.lit(1))
    waiting = ledger.select(F.col("status").alias("state"), first_cell.cast("bigint").alias("s_suppkey"))
    return loaded.unionByName(waiting).groupBy("state").agg(
        F.count("*").alias("n_lines"), F.sum("s_suppkey").alias("key_sum")
    )


@query(
    "bronze_daily_partitions",
    "SRC-08",
    """SELECT event_id, event_type, value, CAST(ts AS DATE) AS event_date,
       CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-15' THEN 'second' ELSE 'first' END AS load_name
       FROM events""",
)
def bronze_daily_partitions(t: Tables) -> DataFrame:
    """Two loads into a date-partitioned table; the second replaces only the days it holds."""
    root = work_dir(t.spark, "daily")
    dated = t.events.select("event_id", "event_type", "value", F.to_date("ts").alias("event_date"))
    first = dated.withColumn("load_name", F.lit("first"))
    second = dated.filter("event_date >= date'2024-01-15'").withColumn("load_name", F.lit("second"))
    for load in (first, second):
        path = bronze.write_table(
            load, root, "bronze", "events", ["event_date"], incremental=True
        )
    return t.spark.read.parquet(path)


@query(
    "report_json_roundtrip",
    "SRC-05",
    """SELECT o_orderstatus AS status, COUNT(*) AS order_count,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM orders GROUP BY 1""",
)
def report_json_roundtrip(t: Tables) -> DataFrame:
    report = t.orders.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("order_count"), money_sum(F.col("o_totalprice")).alias("total")
    )
    path = work_dir(t.spark, "report")
    bronze.write_json(report, path)
    return t.spark.read.schema(report.schema).json(path)


@query(
    "table_stats",
    "SRC-07",
    """WITH """ + s.READINGS_SQL + """
    SELECT 'silver_sensors_clean' AS table_name, COUNT(*) AS row_count,
      CAST(SUM(outlier) AS BIGINT) AS outliers, CAST(SUM(anomaly) AS BIGINT) AS anomalies
    FROM readings""",
)
def table_stats(t: Tables) -> DataFrame:
    return bronze.table_stats(
        s.asset_silver(t)["silver_sensors_clean"],
        "silver_sensors_clean",
        {"outliers": F.col("is_hard_outlier") == 1, "anomalies": F.col("is_anomaly") == 1},
    )


@query(
    "readings_classified",
    "FUN-04 SIL-10 SIL-12 SIL-13 SIL-14 SIL-15 V-06",
    """WITH """ + s.READINGS_SQL + """
    SELECT reading_id, sensor_id, asset_id, sensor_type, ts AS reading_timestamp, reading_hour,
      value AS reading_value, not_future AS dq_timestamp_not_future,
      not_ancient AS dq_timestamp_not_ancient, in_range AS dq_value_in_range,
      in_normal AS in_normal_range, anomaly AS is_anomaly, outlier AS is_hard_outlier,
      valid AS dq_reading_valid FROM readings""",
)
def readings_classified(t: Tables) -> DataFrame:
    return s.asset_silver(t)["silver_sensors_clean"].select(
        "reading_id", "sensor_id", "asset_id", "sensor_type", "reading_timestamp",
        "reading_hour", "reading_value", "dq_timestamp_not_future", "dq_timestamp_not_ancient",
        "dq_value_in_range", "in_normal_range", "is_anomaly", "is_hard_outlier",
        "dq_reading_valid",
    )


@query(
    "customer_standardized",
    "SIL-01 SIL-02 SIL-03 SIL-08 SIL-09 FUN-01 V-06",
    """WITH """ + s.HCP_SQL + """
    SELECT hcp_id, npi, upper(first_name) AS first_name, last_name, full_name, specialty_code,
      specialty_name, specialty_tier, state, territory_id, degree, years_in_practice, is_kol,
      is_investigator, DATE '2015-01-01' AS created_date, DATE '2020-06-01' AS updated_date,
      dq_npi_valid, dq_name_complete, dq_specialty_present, _batch_id FROM hcp""",
)
def customer_standardized(t: Tables) -> DataFrame:
    return provider.hcp_standardized(s.hcp_master(t)).drop("_load_ts")


@query(
    "lineitem_dedup",
    "SIL-04 WIN-01",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
        l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS pick FROM lineitem) WHERE pick = 1""",
)
def lineitem_dedup(t: Tables) -> DataFrame:
    slim = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"
    )
    return keyed.dedup_latest(
        slim,
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate"],
        ["l_partkey", "l_suppkey", "l_extendedprice"],
    )


@query(
    "orders_validated",
    "SIL-05 SIL-06 SIL-07 SIL-11 FUN-03",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
      CAST(round(CAST(o_totalprice AS DECIMAL(18, 2)), 2) AS DOUBLE) AS amount,
      CAST(1 AS INTEGER) AS dq_amount_positive, CAST(1 AS INTEGER) AS dq_date_valid
    FROM orders WHERE o_totalprice > 0 AND o_orderdate <= DATE '2001-01-01'""",
)
def orders_validated(t: Tables) -> DataFrame:
    run = RunContext.of("2001-01-01")
    typed = t.orders.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("order_date"),
        F.round("o_totalprice", 2).alias("amount"),
    )
    good = typed.filter((F.col("amount") > 0) & (F.col("order_date") <= run.today))
    return good.withColumns(
        {
            "dq_amount_positive": flags.flag(F.col("amount") > 0),
            "dq_date_valid": flags.flag(F.col("order_date") <= run.today),
        }
    )


@query(
    "rx_bounded_share",
    "V-01 SIL-06",
    """SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS rx_id,
      CAST(o_custkey AS VARCHAR) AS hcp_id, CAST(year(l_shipdate) AS INTEGER) AS period_year,
      CAST(month(l_shipdate) AS INTEGER) AS period_month, CAST(l_quantity AS INTEGER) AS total_rx_count,
      l_discount AS market_share_pct
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_quantity >= 0 AND l_discount >= 0 AND l_discount <= 1""",
)
def rx_bounded_share(t: Tables) -> DataFrame:
    return provider.rx_aggregates(s.rx(t), bounded_share=True).select(
        "rx_id", "hcp_id", "period_year", "period_month", "total_rx_count", "market_share_pct"
    )


@query(
    "interactions_clean",
    "SIL-05 V-02",
    """SELECT CAST(o_orderkey AS VARCHAR) AS interaction_id, CAST(o_custkey AS VARCHAR) AS hcp_id,
      CAST(o_orderdate AS DATE) AS interaction_date, CAST(o_orderkey % 60 AS INTEGER) AS duration_minutes,
      CAST(1 AS INTEGER) AS dq_date_valid FROM orders WHERE o_orderdate <= DATE '2001-08-02'""",
)
def interactions_clean(t: Tables) -> DataFrame:
    return provider.interactions_clean(s.hcp_interactions(t), ORDERS_RUN).select(
        "interaction_id", "hcp_id", "interaction_date", "duration_minutes", "dq_date_valid"
    )


@query(
    "privacy_projection",
    "SIL-17 GOV-03",
    """WITH """ + s.SUPPORT_SQL + """
    SELECT hcp_id, product, case_type, payer_type, case_month, case_count,
      round(avg_resolution_days, 6) AS avg_resolution_days, escalated_count FROM support""",
)
def privacy_projection(t: Tables) -> DataFrame:
    out = provider.support_by_month(s.patient_support(t))
    leaked = forbidden_columns(out, ["case_id", "patient_id", "patient_age_band", "ssn"])
    if leaked:
        raise ValueError(f"forbidden columns in the product: {leaked}")
    return out.withColumn("avg_resolution_days", F.round("avg_resolution_days", 6))


@query(
    "work_order_days",
    "SIL-16 SIL-24",
    """WITH """ + s.ASSETS_SQL + """
    SELECT CAST(event_id AS VARCHAR) AS work_order_id, created_date, completed_date,
      CAST(date_diff('day', created_date, completed_date) AS INTEGER) AS resolution_days,
      CAST(completed_date IS NULL AS INTEGER) AS is_open,
      CAST(completed_date IS NULL AND date_diff('day', created_date, DATE '2024-01-31') > 14 AS INTEGER)
        AS is_overdue FROM work""",
)
def work_order_days(t: Tables) -> DataFrame:
    orders = asset.work_orders_clean(s.work_orders(t))
    return asset.order_status(orders, EVENTS_RUN, due_days=14).select(
        "work_order_id", "created_date", "completed_date", "resolution_days", "is_open",
        "is_overdue",
    )


@query(
    "cost_band_check",
    "SIL-24",
    """WITH """ + s.ASSETS_SQL + """
    SELECT CAST(event_id AS VARCHAR) AS work_order_id, estimated_hours, actual_hours,
      CAST(actual_hours >= 0.5 * estimated_hours AND actual_hours <= 1.5 * estimated_hours AS INTEGER)
        AS dq_hours_in_band FROM work""",
)
def cost_band_check(t: Tables) -> DataFrame:
    orders = asset.work_orders_clean(s.work_orders(t))
    in_band = flags.within_pct(F.col("actual_hours"), F.col("estimated_hours"), 0.5)
    return orders.select(
        "work_order_id", "estimated_hours", "actual_hours", in_band.alias("dq_hours_in_band")
    )


@query(
    "shipment_days",
    "SIL-16 FUN-02",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS ship_days
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
)
def shipment_days(t: Tables) -> DataFrame:
    return t.lineitem.join(
        t.orders.select("o_orderkey", "o_orderdate"),
        F.col("l_orderkey") == F.col("o_orderkey"),
        "left",
    ).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.datediff("l_shipdate", "o_orderdate").alias("ship_days"),
    )


REJECT_SQL = """
    SELECT event_id, user_id, concat_ws(',',
        CASE WHEN event_type NOT IN ('view', 'click', 'purchase') THEN 'known_type' END,
        CASE WHEN value < 1 OR value > 225 THEN 'physical_range' END,
        CASE WHEN NOT regexp_matches(props, '^\\{"k": [0-9]{1,2}\\}$') THEN 'props_format' END
      ) AS reject_reasons
    FROM events"""


def _event_rules() -> dict:
    return {
        "known_type": F.col("event_type").isin("view", "click", "purchase"),
        "physical_range": F.col("value").between(1, 225),
        "props_format": F.col("props").rlike('^\\{"k": [0-9]{1,2}\\}$'),
    }


@query(
    "quarantine_rejects",
    "SIL-18 SIL-19 SIL-20",
    f"SELECT * FROM ({REJECT_SQL}) WHERE reject_reasons <> ''",
)
def quarantine_rejects(t: Tables) -> DataFrame:
    _, rejects = keyed.split_by_rules(t.events, _event_rules())
    return rejects.select(
        "event_id", "user_id", F.array_join("reject_reasons", ",").alias("reject_reasons")
    )


@query(
    "quarantine_accepted",
    "SIL-18 SIL-19 SIL-20",
    f"SELECT event_id, user_id FROM ({REJECT_SQL}) WHERE reject_reasons = ''",
)
def quarantine_accepted(t: Tables) -> DataFrame:
    good, _ = keyed.split_by_rules(t.events, _event_rules())
    return good.select("event_id", "user_id")


@query(
    "orphan_quarantine",
    "SIL-20 JOI-08",
    """SELECT doc_id, source FROM documents
       WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)""",
)
def orphan_quarantine(t: Tables) -> DataFrame:
    _, orphans = keyed.split_by_reference(
        t.documents.select("doc_id", "source"), t.labels, "doc_id", "doc_id"
    )
    return orphans


@query(
    "clock_skew_flags",
    "SIL-21 SIL-12",
    """SELECT event_id, CAST(event_id % 17 > 8 AS INTEGER) AS is_skewed,
      CAST(ts + to_hours(CAST(event_id % 17 AS INTEGER)) <= TIMESTAMP '2024-01-30 13:00:00' AS INTEGER) AS dq_timestamp_not_future
    FROM events""",
)
def clock_skew_flags(t: Tables) -> DataFrame:
    """Device clocks set ahead of the arrival time by 0 to 16 hours; 8 hours are allowed, and
    one hour into the future."""
    run = RunContext.of("2024-01-30")
    ahead = F.timestamp_add("HOUR", (F.col("event_id") % 17).cast("int"), F.col("ts"))
    device = t.events.select("event_id", "ts", ahead.cast("timestamp_ntz").alias("device_ts"))
    checks = flags.ts_quality(F.col("device_ts"), run, tolerance_hours=13)
    return device.select(
        "event_id",
        flags.skew_flag(F.col("device_ts"), F.col("ts")).alias("is_skewed"),
        checks["dq_timestamp_not_future"].alias("dq_timestamp_not_future"),
    )


@query(
    "reading_sequence_flags",
    "SIL-22",
    """SELECT event_id, user_id, CAST(COUNT(*) OVER (PARTITION BY user_id, minute_ts) > 1 AS INTEGER) AS is_duplicate_ts,
      CAST(COALESCE(minute_ts < lag(minute_ts) OVER (PARTITION BY user_id ORDER BY event_id), FALSE) AS INTEGER) AS is_out_of_order
    FROM (SELECT event_id, user_id, date_trunc('minute', ts)
            - to_hours(CASE WHEN event_id % 13 = 0 THEN 30 ELSE 0 END) AS minute_ts FROM events)""",
)
def reading_sequence_flags(t: Tables) -> DataFrame:
    """Readings stamped to the minute, every thirteenth with a clock 30 hours behind."""
    late = F.when(F.col("event_id") % 13 == 0, -30).otherwise(0)
    stamped = t.events.select(
        "event_id",
        "user_id",
        F.timestamp_add("HOUR", late, F.date_trunc("minute", "ts").cast("timestamp_ntz"))
        .cast("timestamp_ntz")
        .alias("minute_ts"),
    )
    return keyed.sequence_flags(
        stamped, "user_id", "minute_ts", "event_id", rows_per_segment=1_000
    ).select("event_id", "user_id", "is_duplicate_ts", "is_out_of_order")


@query(
    "namespaced_ids",
    "SIL-23",
    """SELECT 'CRM:' || c_custkey AS source_id, c_name AS name FROM customer
       UNION ALL SELECT 'ERP:' || s_suppkey, s_name FROM supplier""",
)
def namespaced_ids(t: Tables) -> DataFrame:
    crm = t.customer.select(
        flags.namespaced("CRM", F.col("c_custkey")).alias("source_id"), F.col("c_name").alias("name")
    )
    erp = t.supplier.select(
        flags.namespaced("ERP", F.col("s_suppkey")).alias("source_id"), F.col("s_name").alias("name")
    )
    return crm.unionByName(erp)


@query(
    "schema_drift",
    "SRC-09",
    """WITH sizes AS (SELECT COUNT(*) AS n FROM orders)
       SELECT 'o_clerk' AS column_name, CAST(NULL AS VARCHAR) AS old_type, CAST(NULL AS BIGINT) AS old_rows,
         'string' AS new_type, n AS new_rows, 'added' AS change FROM sizes
       UNION ALL SELECT 'o_orderstatus', 'string', n, NULL, NULL, 'removed' FROM sizes
       UNION ALL SELECT 'o_totalprice', 'double', n, 'string', n, 'retyped' FROM sizes""",
)
def schema_drift(t: Tables) -> DataFrame:
    """Snapshot of the orders schema against a later batch with three changes."""
    later = (
        t.orders.drop("o_orderstatus")
        .withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
        .withColumn("o_clerk", F.lit("x"))
    )
    return bronze.schema_changes(
        bronze.schema_snapshot(t.orders, "orders", ORDERS_RUN),
        bronze.schema_snapshot(later, "orders", ORDERS_RUN),
    )
