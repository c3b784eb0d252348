"""Queries: published versions, incremental refresh, quarantine with replay, stored states."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.catalog.base import Tables, query
from tidemark.context import RunContext
from tidemark.functions.scoring import money_sum
from tidemark.operators import quarantine
from tidemark.plans.refresh import Calendar, Lake, Reach
from tidemark.session import work_dir
from tidemark.sources.snapshots import SnapshotTable

FIRST_RUN = RunContext.of("2024-01-30", "2024-01-30 06:00:00")
SECOND_RUN = RunContext.of("2024-01-31", "2024-01-31 06:00:00")


@query(
    "snapshot_versions",
    "SRC-03 SRC-08",
    """WITH o AS (SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(28, 6)) AS price FROM orders),
    v AS (SELECT 1 AS version, o_orderstatus, o_orderkey, price FROM o
      UNION ALL SELECT 2, o_orderstatus, o_orderkey, price FROM o WHERE o_orderstatus = 'F'
      UNION ALL SELECT 2, o_orderstatus, o_orderkey, price * 2 FROM o WHERE o_orderstatus <> 'F' AND o_orderkey % 2 = 0)
    SELECT version, o_orderstatus AS status, COUNT(*) AS n_orders, CAST(SUM(price) AS DOUBLE) AS total FROM v GROUP BY 1, 2""",
)
def snapshot_versions(t: Tables) -> DataFrame:
    """Two versions of one table, read by number; the second replaces the partitions it holds."""
    table = SnapshotTable(t.spark, work_dir(t.spark, "snapshots"))
    first = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    second = first.filter("status <> 'F' AND o_orderkey % 2 = 0").withColumn("price", F.col("price") * 2)
    table.publish(first, FIRST_RUN, ["status"])
    table.publish(second, SECOND_RUN, ["status"], replace=F.lit(False))
    both = [table.read(n).withColumn("version", F.lit(n)) for n in (1, 2)]
    return both[0].unionByName(both[1]).groupBy("version", "status").agg(
        F.count("*").alias("n_orders"), money_sum(F.col("price")).alias("total")
    )


EVENT_DAYS = Calendar(
    day={"bronze_events": "ts", "silver_events": "ts", "gold_user_days": "event_day"},
    reads={
        "silver_events": {"bronze_events": Reach()},
        "gold_user_days": {"silver_events": Reach(back=6)},
    },
)


def user_days(events: DataFrame, run: RunContext) -> DataFrame:
    """Events per user and day with those of the last seven days, stamped with the batch that built it."""
    daily = events.groupBy("user_id", F.to_date("ts").alias("event_day")).agg(F.count("*").alias("n_events"))
    week = Window.partitionBy("user_id").orderBy(F.unix_date("event_day")).rangeBetween(-6, 0)
    return daily.withColumn("n_events_7d", F.sum("n_events").over(week)).withColumn(
        "built_by", F.lit(run.batch_id)
    )


@query(
    "refresh_two_batches",
    "SRC-08 STR-01",
    """WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS event_day, COUNT(*) AS n_events FROM events WHERE value >= 0 GROUP BY 1, 2),
    late AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events
      WHERE event_id % 3 = 0 AND (CAST(ts AS DATE) >= DATE '2024-01-20' OR CAST(ts AS DATE) = DATE '2024-01-05'))
    SELECT user_id, event_day, n_events,
      CAST(SUM(n_events) OVER (PARTITION BY user_id ORDER BY event_day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS n_events_7d,
      CASE WHEN EXISTS (SELECT 1 FROM late WHERE event_day BETWEEN d AND d + 6) THEN '20240131_060000' ELSE '20240130_060000' END AS built_by
    FROM daily""",
)
def refresh_two_batches(t: Tables) -> DataFrame:
    """Late rows of a second batch: their days, and the six after each, are built again; others are not."""
    lake = Lake(t.spark, work_dir(t.spark, "refresh"), EVENT_DAYS)
    day = F.to_date("ts")
    late = (F.col("event_id") % 3 == 0) & ((day >= F.lit("2024-01-20").cast("date")) | (day == F.lit("2024-01-05").cast("date")))
    rows = t.events.select("event_id", "user_id", "ts", "value")
    for run, batch in ((FIRST_RUN, rows.filter(~late)), (SECOND_RUN, rows.filter(late))):
        lake.publish_batch("bronze_events", batch.withColumn("_batch_id", F.lit(run.batch_id)), run, False)
        bronze = {"bronze_events": lake.read("bronze_events")}
        lake.refresh_days("silver_events", bronze, lambda d: d["bronze_events"].filter("value >= 0"), run)
        silver = {"silver_events": lake.read("silver_events")}
        lake.refresh_days("gold_user_days", silver, lambda d, r=run: user_days(d["silver_events"], r), run)
    return lake.read("gold_user_days")


@query(
    "quarantine_ledger",
    "SIL-18 SIL-19 SIL-20 JOI-08",
    """WITH o AS (SELECT *, CASE WHEN o_orderkey % 2 = 1 THEN 1 ELSE 2 END AS batch FROM orders),
    broken AS (SELECT batch, o_totalprice <= 300000 AS priced, o_custkey % 3 <> 0 AS known_at_first FROM o),
    told AS (SELECT CASE batch WHEN 1 THEN '20240130_060000' ELSE '20240131_060000' END AS batch_id,
      CASE WHEN NOT priced THEN 'price_in_bounds' WHEN batch = 1 AND NOT known_at_first THEN 'unknown_customer' ELSE '' END AS reasons,
      CASE WHEN NOT priced THEN 'open' WHEN batch = 1 AND NOT known_at_first THEN 'replayed' ELSE 'accepted' END AS status,
      CASE WHEN priced AND batch = 1 AND NOT known_at_first THEN '20240131_060000' END AS resolved_batch FROM broken)
    SELECT batch_id, status, resolved_batch, reasons, COUNT(*) AS n_rows FROM told GROUP BY ALL""",
)
def quarantine_ledger(t: Tables) -> DataFrame:
    """Orders in two batches; a third of the customers arrives with the second, and their orders are
    taken back. Orders beyond the price limit stay. With the accepted rows the parts add up."""
    rules = {"price_in_bounds": F.col("o_totalprice") <= 300_000}
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    customers = t.customer.select("c_custkey")
    ledger, accepted = None, []
    for run, odd, known in (
        (FIRST_RUN, 1, customers.filter("c_custkey % 3 <> 0")), (SECOND_RUN, 0, customers),
    ):
        parents = [quarantine.Parent("unknown_customer", "o_custkey", known, "c_custkey")]
        batch = quarantine.screened(orders.filter(F.col("o_orderkey") % 2 == odd), rules, parents)
        entries = quarantine.rejects(batch, orders.columns, run)
        if ledger is not None:
            entries = quarantine.settled(ledger, orders.schema, rules, parents, run).unionByName(entries)
        ledger = t.keep(entries, "ledger")
        good = batch.filter(F.size("reject_reasons") == 0)
        accepted.append(good.select(F.lit(run.batch_id).alias("batch_id"), F.lit("accepted").alias("status")))
    parts = ledger.select(
        "batch_id", "status", "resolved_batch", F.array_join(F.array_sort("reasons"), ",").alias("reasons"), "copies"
    )
    for rows in accepted:
        parts = parts.unionByName(
            rows.select("*", F.lit(None).cast("string").alias("resolved_batch"), F.lit("").alias("reasons"),
                        F.lit(1).cast("bigint").alias("copies"))
        )
    return parts.groupBy("batch_id", "status", "resolved_batch", "reasons").agg(F.sum("copies").alias("n_rows"))
