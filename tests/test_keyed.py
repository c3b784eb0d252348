from pyspark.sql import functions as F

from helpers import rows, ts
from tidemark.context import RunContext
from tidemark.functions import flags
from tidemark.operators import keyed

RUN = RunContext.of("2024-01-31")


def test_dedup_keeps_newest_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "q"), ("c", 5, None), ("c", 5, "n")],
        "k string, t int, v string",
    )
    got = rows(keyed.dedup_latest(df, ["k"], ["t"], ["v"]))
    assert got == [("a", 2, "z"), ("b", None, "q"), ("c", 5, "n")]


def test_dedup_prunes_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS t")
    plan = keyed.dedup_latest(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_require_and_cast(spark):
    df = spark.createDataFrame(
        [("1", " ab ", "7"), (None, "x", "1"), ("2", None, "bad")], "id string, name string, n string"
    )
    casts = keyed.casts("id STRING, label STRING <- name, n INT", label="upper")
    got = rows(keyed.cast_project(keyed.require(df, "id"), casts, on_error="null"))
    assert got == [("1", "AB", 7), ("2", None, None)]


def test_cast_failure_stops_the_job(spark):
    import pytest

    df = spark.createDataFrame([("x",)], "n string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        keyed.cast_project(df, keyed.casts("n INT")).collect()


def test_split_by_rules_sends_null_to_rejects(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, v double")
    good, bad = keyed.split_by_rules(df, {"positive": F.col("v") > 0, "small": F.col("v") < 3})
    assert rows(good) == []
    assert rows(bad, "id", F.concat_ws(",", "reject_reasons")) == [
        (1, "small"), (2, "positive"), (3, "positive,small"),
    ]


def test_split_by_reference_quarantines_null_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    known = spark.createDataFrame([(1,), (1,), (9,)], "code int")
    good, orphans = keyed.split_by_reference(df, known, "k", "code")
    assert rows(good) == [(1,)] and rows(orphans) == [(2,), (None,)]


def test_lag_crosses_segments(spark):
    values = [(1, i, (i * 37) % 11) for i in range(0, 50, 3)] + [(2, 4, 8), (2, 41, None), (2, 49, 3)]
    df = spark.createDataFrame(values, "k int, o int, v int")
    got = keyed.lag_in_order(df, ["k"], "o", "v", "before", F.floor(F.col("o") / 10))
    want = {}
    for k in (1, 2):
        previous = None
        for key, o, v in sorted(x for x in values if x[0] == k):
            want[(k, o)] = previous
            previous = v
    assert {(r.k, r.o): r.before for r in got.collect()} == want


def test_sequence_flags(spark):
    df = spark.createDataFrame(
        [(1, 1, ts("2024-01-01 10:00:00")), (2, 1, ts("2024-01-01 09:00:00")),
         (3, 1, ts("2024-01-01 09:00:00")), (4, 2, ts("2024-01-01 00:00:00"))],
        "n long, k int, t timestamp_ntz",
    )
    got = keyed.sequence_flags(df, "k", "t", "n", rows_per_segment=2)
    assert rows(got, "n", "is_duplicate_ts", "is_out_of_order") == [
        (1, 0, 0), (2, 1, 1), (3, 1, 0), (4, 0, 0),
    ]


def test_reading_classification_at_the_bounds(spark):
    df = spark.createDataFrame(
        [(1.0,), (225.0,), (5.0,), (115.0,), (0.9,), (225.1,), (4.9,), (None,)], "v double"
    )
    c = flags.classify_reading(F.col("v"), *[F.lit(x) for x in (1.0, 225.0, 5.0, 115.0)])
    got = {r.v: tuple(r)[1:] for r in df.select("v", *[x.alias(n) for n, x in c.items()]).collect()}
    assert got == {
        1.0: (1, 0, 1, 0), 225.0: (1, 0, 1, 0), 5.0: (1, 1, 0, 0), 115.0: (1, 1, 0, 0),
        0.9: (0, 0, 0, 1), 225.1: (0, 0, 0, 1), 4.9: (1, 0, 1, 0), None: (0, 0, 0, 0),
    }


def test_timestamp_quality_bounds(spark):
    df = spark.createDataFrame(
        [(ts("2024-01-31 00:00:00"),), (ts("2024-01-31 00:00:01"),), (ts("2021-12-31 23:59:59"),), (None,)],
        "t timestamp_ntz",
    )
    q = flags.ts_quality(F.col("t"), RUN)
    got = [tuple(r) for r in df.select(*q.values()).collect()]
    assert got == [(1, 1), (0, 1), (1, 0), (0, 0)]


def test_small_flags(spark):
    df = spark.createDataFrame([(" 0123456789 ", ""), ("123", "x"), (None, None)], "a string, b string")
    got = df.select(
        flags.len_flag(F.col("a"), 10).alias("len"),
        flags.present_flag(F.col("b")).alias("full"),
        flags.present_flag(F.col("b"), allow_empty=True).alias("there"),
        flags.pattern_flag(F.trim("a"), "^[0-9]{10}$").alias("pattern"),
        flags.namespaced("CRM", F.col("a")).alias("ns"),
    )
    assert [tuple(r)[:4] for r in got.collect()] == [(1, 0, 1, 1), (0, 1, 1, 0), (0, 0, 0, 0)]
    assert got.collect()[2].ns is None


def test_skew_and_band(spark):
    df = spark.createDataFrame(
        [(ts("2024-01-01 08:00:00"), 150.0, 100.0), (ts("2024-01-01 08:00:01"), 150.1, 100.0)],
        "t timestamp_ntz, a double, e double",
    )
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    got = df.select(
        flags.skew_flag(F.col("t"), base).alias("s"),
        flags.within_pct(F.col("a"), F.col("e"), 0.5).alias("w"),
    )
    assert rows(got) == [(0, 1), (1, 0)]
