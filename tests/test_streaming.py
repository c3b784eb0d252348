from helpers import rows, ts
from tidemark.context import RunContext
from tidemark.streaming import jobs

RUN = RunContext.of("2024-01-02")
SCHEMA = "id long, sensor string, t timestamp_ntz, v double"


def put(spark, folder, number, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{folder}/{number}")


def test_ingest_reads_each_file_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def load():
        stream = jobs.read_stream(spark, f"{source}/*", SCHEMA)
        jobs.ingest_stream(stream, RUN, "sensor.csv", target, checkpoint).awaitTermination()
        return spark.read.parquet(target)

    put(spark, source, 1, [(1, "s", ts("2024-01-01 00:00:00"), 1.0)])
    assert load().count() == 1
    put(spark, source, 2, [(2, "s", ts("2024-01-01 01:00:00"), 1.0)])
    got = load()
    assert rows(got, "id", "_source_system") == [(1, "SENSOR.CSV"), (2, "SENSOR.CSV")]
    assert load().count() == 2


def test_validation_drops_repeats_and_wrong_clocks(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, source, 1, [
        (1, "s", ts("2024-01-01 00:10:00"), 50.0), (1, "s", ts("2024-01-01 00:10:00"), 50.0),
        (2, "s", ts("2024-01-01 00:20:00"), 2.0), (3, "s", ts("2024-01-01 00:30:00"), 900.0),
        (4, "s", ts("2030-01-01 00:00:00"), 50.0), (5, "s", ts("1999-01-01 00:00:00"), 50.0),
        (6, "s", ts("2024-01-01 05:00:00"), 50.0),
    ])
    stream = jobs.read_stream(spark, f"{source}/*", SCHEMA)
    hourly = jobs.validate_stream(stream, RUN, "id", "sensor", "t", "v", (1, 225, 5, 115))
    (
        hourly.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start(target).awaitTermination()
    )
    got = spark.read.schema(hourly.schema).parquet(target)
    assert rows(got) == [("s", ts("2024-01-01 00:00:00"), 3, 2, 1, 1)]


def test_a_table_streams_as_file_and_as_folder(spark, sf_dir, tmp_path):
    whole = spark.read.parquet(f"{sf_dir}/events.parquet")
    whole.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for name, folder in (("file", sf_dir), ("folder", str(tmp_path))):
        stream = jobs.table_stream(spark, f"{folder}/events.parquet", whole.schema)
        out = str(tmp_path / name)
        jobs.ingest_stream(stream, RUN, "events.parquet", out, f"{out}-cp").awaitTermination()
        assert spark.read.parquet(out).count() == whole.count()


def test_limits_per_sensor_and_refused_readings(spark, tmp_path):
    source = str(tmp_path / "in")
    put(spark, source, 1, [
        (1, "a", ts("2024-01-01 00:10:00"), 50.0), (2, "b", ts("2024-01-01 00:20:00"), 50.0),
        (3, "c", ts("2024-01-01 00:20:00"), 50.0), (4, "a", ts("2030-01-01 00:00:00"), 50.0),
        (5, "a", ts("1999-01-01 00:00:00"), 50.0), (6, "a", ts("2024-01-01 09:00:00"), 50.0),
    ])
    limits = spark.createDataFrame([("a", 0, 100, 10, 90), ("b", 0, 40, 10, 30)], "sensor string, low int, high int, normal_low int, normal_high int")

    def run(df, name):
        out = str(tmp_path / name)
        (
            df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{out}-cp")
            .trigger(availableNow=True).start(out).awaitTermination()
        )
        return spark.read.schema(df.schema).parquet(out)

    hourly = jobs.validate_stream(jobs.read_stream(spark, f"{source}/*", SCHEMA), RUN, "id", "sensor", "t", "v", limits)
    got = run(hourly, "hours")
    assert rows(got, "sensor", "reading_count", "valid_count", "outlier_count") == [("a", 1, 1, 0), ("b", 1, 0, 1), ("c", 1, 0, 0)]
    refused = jobs.refused_readings(jobs.read_stream(spark, f"{source}/*", SCHEMA), RUN, "t")
    assert rows(run(refused, "refused"), "id", "reason") == [(4, "future"), (5, "ancient")]
