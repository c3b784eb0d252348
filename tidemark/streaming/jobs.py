"""Structured Streaming jobs: incremental bronze ingest and live reading validation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.context import RunContext
from tidemark.functions.flags import classify_reading, ts_quality
from tidemark.sources.bronze import with_lineage


def read_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    fmt: str = "parquet",
    name_filter: str | None = None,
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """Files arriving in a folder, with a declared schema."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def table_stream(spark: SparkSession, path: str, schema: StructType | str, **options: str) -> DataFrame:
    """A table as a stream of its files, be it one file or a folder of parts."""
    # As a pattern the path matches itself either way; a plain path has to be a folder.
    head, last = path.rstrip("/")[:-1], path.rstrip("/")[-1]
    return read_stream(spark, f"{head}[{last}]", schema, **options)


def ingest_stream(
    stream: DataFrame,
    run: RunContext,
    source_file: str,
    target: str,
    checkpoint: str,
    partition_column: str | None = None,
) -> StreamingQuery:
    """Append what is new since the last start to a lineage-stamped bronze table, then stop.

    The checkpoint remembers the files already read, so a restart neither skips nor repeats.
    """
    writer = (
        with_lineage(stream, run, source_file)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_column:
        writer = writer.partitionBy(partition_column)
    return writer.start(target)


LIMITS = ("low", "high", "normal_low", "normal_high")


def refused_readings(
    stream: DataFrame,
    run: RunContext,
    ts: str,
    floor: date = date(2022, 1, 1),
    future_tolerance_hours: int = 1,
) -> DataFrame:
    """The readings that ``validate_stream`` refuses, with the reason; a sink of their own."""
    checks = ts_quality(F.col(ts), run, floor, future_tolerance_hours)
    reason = F.when(F.col("dq_timestamp_not_future") != 1, "future").otherwise("ancient")
    refused = stream.withColumns(checks).filter(
        "dq_timestamp_not_future <> 1 OR dq_timestamp_not_ancient <> 1"
    )
    return refused.withColumn("reason", reason).select(*stream.columns, "reason")


def validate_stream(
    stream: DataFrame,
    run: RunContext,
    identifier: str,
    sensor: str,
    ts: str,
    value: str,
    limits: tuple[float, float, float, float] | DataFrame,
    watermark: str = "2 hours",
    floor: date = date(2022, 1, 1),
    future_tolerance_hours: int = 1,
) -> DataFrame:
    """Hourly completeness and quality counts per sensor from a stream of readings.

    Readings beyond the future tolerance are refused before the watermark sees them, since one
    wrong clock would otherwise move it past every honest reading. Repeats of a reading id
    inside the watermark are dropped; an hour is final when the watermark has passed it.

    ``limits`` (low, high, normal low, normal high) hold for all sensors, or come as a table with
    a row per sensor: ``sensor, low, high, normal_low, normal_high``. A sensor without limits has
    none of its readings in range.
    """
    checks = ts_quality(F.col(ts), run, floor, future_tolerance_hours)
    if isinstance(limits, DataFrame):
        own = limits.select(F.col(sensor), *[F.col(n).cast("double").alias(f"_{n}") for n in LIMITS])
        stream = stream.join(own, sensor, "left")
        low, high, normal_low, normal_high = (F.col(f"_{n}") for n in LIMITS)
    else:
        low, high, normal_low, normal_high = (F.lit(float(v)) for v in limits)
    flags = classify_reading(F.col(value), low, high, normal_low, normal_high)
    accepted = (
        stream.withColumns({**checks, **flags})
        .filter("dq_timestamp_not_future = 1 AND dq_timestamp_not_ancient = 1")
        .withColumn("event_ts", F.col(ts).cast("timestamp"))
        .withWatermark("event_ts", watermark)
        .dropDuplicatesWithinWatermark([identifier])
    )
    return (
        accepted.groupBy(F.window("event_ts", "1 hour"), F.col(sensor))
        .agg(
            F.count("*").alias("reading_count"),
            F.sum("dq_value_in_range").alias("valid_count"),
            F.sum("is_anomaly").alias("anomaly_count"),
            F.sum("is_hard_outlier").alias("outlier_count"),
        )
        .select(
            F.col(sensor),
            F.col("window.start").cast("timestamp_ntz").alias("reading_hour"),
            "reading_count",
            "valid_count",
            "anomaly_count",
            "outlier_count",
        )
    )


def upsert_hours(hourly: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Keep every hour of ``validate_stream`` as of its last reading, open hours too.

    Each micro-batch writes the hours it changed to a folder of its own number. A batch that is run
    again after a failure replaces that folder, so it counts once; ``current_hours`` reads the last
    state of every hour. With this sink an available-now run withholds nothing at its end.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch_number", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(
            f"{target}/_batch={number}"
        )

    return (
        hourly.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def current_hours(spark: SparkSession, target: str, schema: StructType, sensor: str) -> DataFrame:
    """The last state of every hour that ``upsert_hours`` has written."""
    written = spark.read.schema(StructType([*schema.fields]).add("batch_number", "long")).option(
        "basePath", target
    ).parquet(f"{target}/_batch=*")
    columns = [c for c in schema.names if c not in (sensor, "reading_hour")]
    last = F.max_by(F.struct(*columns), "batch_number").alias("_last")
    return written.groupBy(sensor, "reading_hour").agg(last).select(sensor, "reading_hour", "_last.*")
