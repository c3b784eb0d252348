from fractions import Fraction

from pyspark.sql import functions as F

from helpers import day, one, rows, ts
from tidemark.operators import aggregates, history, ranking, series


def hours(spark, *stamps, key="s"):
    return spark.createDataFrame([(key, ts(s)) for s in stamps], "k string, t timestamp_ntz")


def test_gaps(spark):
    df = hours(
        spark, "2024-01-01 00:10:00", "2024-01-01 01:50:00", "2024-01-01 03:00:00",
        "2024-01-01 06:00:00", "2024-01-01 03:30:00", "2024-01-01 00:59:00",
    )
    assert rows(series.gaps(df, "k", "t")) == [
        ("s", ts("2024-01-01 03:00:00"), ts("2024-01-01 06:00:00"), 2)
    ]


def test_densify_marks_missing_hours(spark):
    df = hours(spark, "2024-01-01 22:10:00", "2024-01-02 01:05:00", "2024-01-02 01:45:00")
    got = rows(series.densify_hours(df, "k", "t"), "reading_hour", "reading_count", "is_missing")
    assert got == [
        (ts("2024-01-01 22:00:00"), 1, 0), (ts("2024-01-01 23:00:00"), 0, 1),
        (ts("2024-01-02 00:00:00"), 0, 1), (ts("2024-01-02 01:00:00"), 2, 0),
    ]


def test_gap_aware_mean_is_null_below_half(spark):
    df = spark.createDataFrame(
        [("s", ts("2024-01-01 00:00:00"), 72.0, 1), ("s", ts("2024-01-01 01:00:00"), 500.0, 0),
         ("s", ts("2024-01-01 03:00:00"), 95.0, 1)],
        "k string, t timestamp_ntz, v double, ok int",
    )
    got = series.gap_aware_mean(df, "k", "t", "v", "ok", hours=4)
    last = one(got, reading_hour=ts("2024-01-01 03:00:00"))
    assert last["completeness_pct"] == 50.0 and last["rolling_mean"] == 83.5
    assert one(got, reading_hour=ts("2024-01-01 01:00:00"))["rolling_mean"] is None


def test_drift(spark):
    data = [("up", ts(f"2024-01-{d:02d} 00:00:00"), 10.0 + d) for d in range(1, 21)]
    data += [("flat", ts(f"2024-01-{d:02d} 00:00:00"), 5.0) for d in range(1, 21)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v double")
    got = series.sensor_drift(df, "k", "t", "v")
    up, flat = one(got, k="up"), one(got, k="flat")
    assert up["is_drifting"] == 1 and abs(up["slope_per_day"] - 1) < 1e-9
    assert (up["baseline_mean"], up["recent_mean"]) == (14.0, 27.0)
    assert flat["is_drifting"] == 0 and flat["shift_pct"] == 0


def test_drift_slope_loses_nothing_to_the_distance_from_the_epoch(spark):
    levels = {k: [((k * 37 + d * d * 11) % 997) / 8 for d in range(1, 29)] for k in range(40)}
    data = [(str(k), ts(f"2024-01-{d:02d} 00:00:00"), v) for k, vs in levels.items() for d, v in enumerate(vs, 1)]
    df = spark.createDataFrame([*data, ("one", ts("2024-01-01 00:00:00"), 1.0)], "k string, t timestamp_ntz, v double")
    got = {r.k: r.slope_per_day for r in series.sensor_drift(df, "k", "t", "v").collect()}
    assert got.pop("one") is None
    for k, vs in levels.items():
        centred = [Fraction(2 * d - 29, 2) for d in range(1, 29)]
        slope = sum(c * Fraction(v) for c, v in zip(centred, vs)) / sum(c * c for c in centred)
        assert got[str(k)] == float(slope)


def test_volume_and_period_change(spark):
    data = [(ts(f"2024-01-0{d} 05:00:00"),) for d in (1, 2, 3) for _ in range(10)]
    data += [(ts("2024-01-04 05:00:00"),)] * 7
    got = series.volume_check(spark.createDataFrame(data, "t timestamp_ntz"), "t")
    last = one(got, day=day("2024-01-04"))
    assert (last["is_low_volume"], last["is_sudden_drop"], last["trailing_avg"]) == (1, 1, 10.0)
    first = one(got, day=day("2024-01-01"))
    assert (first["is_low_volume"], first["previous_count"]) == (0, None)
    weekly = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 10.0), ("a", 3, 11.5)], "k string, w int, v double")
    changed = series.period_change(weekly, ["k"], "w", "v", 10.0)
    assert rows(changed, "w", "change_pct", "is_alert") == [(1, None, 0), (2, None, 0), (3, 15.0, 1)]


def test_scd2_versions(spark):
    df = spark.createDataFrame(
        [("k", day("2024-01-01"), 1, "A"), ("k", day("2024-01-02"), 2, "A"), ("k", day("2024-01-05"), 5, "A"),
         ("k", day("2024-01-03"), 9, "B"),  # arrives late
         ("k", day("2024-01-07"), 6, "C"), ("k", day("2024-01-07"), 7, None), ("z", None, 1, "A")],
        "k string, d date, o int, v string",
    )
    got = rows(history.scd2(df, "k", "d", "o", ["v"]), "v", "valid_from", "valid_to", "version", "is_current")
    assert got == sorted([
        ("A", day("2024-01-01"), day("2024-01-03"), 1, 0),
        ("B", day("2024-01-03"), day("2024-01-05"), 2, 0),
        ("A", day("2024-01-05"), day("2024-01-07"), 3, 0),
        (None, day("2024-01-07"), None, 4, 1),
    ], key=str)


def test_exact_median(spark):
    import statistics, random

    rng = random.Random(5)
    a = [rng.choice([0.0, 1.0, 1e9, rng.random()]) for _ in range(301)]
    b = [None if i % 3 == 0 else float(i % 7) for i in range(301)]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    got = {r.feature: r.median for r in aggregates.exact_median(df, ["a", "b"], bins=8).collect()}
    assert got == {
        "a": statistics.median(a), "b": statistics.median([x for x in b if x is not None])
    }


def test_median_of_even_count_and_constant(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0)], "a double, c double")
    got = {r.feature: r.median for r in aggregates.exact_median(df, ["a", "c"]).collect()}
    assert got == {"a": 1.5, "c": 4.0}


def test_hash_rank_is_a_rank(spark):
    import hashlib

    df = spark.range(500).selectExpr("id", "id % 7 = 0 AS label")
    got = ranking.hash_rank(df, "id", ["label"], prefix=1).collect()
    for label in (True, False):
        ids = sorted((r.id for r in got if r.label == label), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
        assert [r.id for r in sorted((r for r in got if r.label == label), key=lambda r: r.hash_rank)] == ids
        assert {r.stratum_size for r in got if r.label == label} == {len(ids)}
    plain = ranking.hash_rank(df, "id").collect()
    assert sorted(r.hash_rank for r in plain) == list(range(1, 501))


def test_rollup_suppression_and_linkage(spark):
    df = spark.createDataFrame(
        [("g", i) for i in range(10)] + [("h", i) for i in range(9)], "g string, i int"
    )
    sized = df.groupBy("g").agg(F.count("*").alias("n"), F.sum("i").alias("s"))
    assert rows(aggregates.suppress_small(sized, "n", 10)) == [("g", 10, 45)]
    assert rows(aggregates.blank_small(sized, "n", ["s"], 10)) == [("g", 10, 45), ("h", 9, None)]
    facts = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dims = spark.createDataFrame([(1,), (1,)], "d int")
    assert rows(aggregates.linkage(facts, dims, "k", "d")) == [(4, 2, 50.0)]
    empty = aggregates.linkage(facts.limit(0), dims, "k", "d")
    assert rows(empty) == [(0, 0, None)]


def test_grid_before_and_across_the_epoch(spark):
    data = [("a", ts("1969-12-31 19:00:00")), ("a", ts("1970-01-01 02:00:00")), ("b", ts("1969-12-30 18:00:00")), ("b", ts("1969-12-30 20:00:00"))]
    grid = series.densify_hours(spark.createDataFrame(data, "k string, t timestamp_ntz"), "k", "t")
    found = rows(grid, "k", "reading_hour", "reading_count")
    assert [r for r in found if r[0] == "b"] == [("b", ts(f"1969-12-30 {h}:00:00"), n) for h, n in ((18, 1), (19, 0), (20, 1))]
    hours = [r for r in found if r[0] == "a"]
    assert len(hours) == 8 and hours[0][1:] == (ts("1969-12-31 19:00:00"), 1) and hours[-1][1:] == (ts("1970-01-01 02:00:00"), 1)
