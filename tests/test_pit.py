"""Point-in-time features against a literal reading of the definition."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import day, one
from tidemark.operators.pit import pit_rolling
from tidemark.operators.timeline import Signal, attach_asof, attach_signals

SCHEMA = "id long, cust string, d date, amount double, state string, fraud boolean"
FEATURES = (
    "tx_count", "avg_amount", "max_amount", "total_amount", "short_tx_count", "days_since_last",
    "distinct_categories", "prior_labels",
)


def roll(df, strict=False):
    return pit_rolling(df, "cust", "d", "id", "amount", "state", "fraud", strict=strict)


def brute(events, strict):
    out = {}
    for e in events:
        i, cust, d, *_ = e
        gap = 1 if strict else 0
        prior = [
            h for h in events
            if cust is not None and h[1] == cust and h[0] != i and gap <= (d - h[2]).days <= 30
        ]
        amounts = [h[3] for h in prior if h[3] is not None]
        out[i] = (
            len(prior),
            round(sum(amounts) / len(amounts), 6) if amounts else 0.0,
            max(amounts, default=0.0),
            round(sum(amounts), 6),
            sum(1 for h in prior if (d - h[2]).days <= 7),
            min(((d - h[2]).days for h in prior), default=999),
            len({h[4] for h in prior if h[4] is not None}),
            sum(1 for h in prior if h[5]),
        )
    return out


def observed(df):
    return {
        r.id: tuple(round(r[f], 6) if isinstance(r[f], float) else r[f] for f in FEATURES)
        for r in df.collect()
    }


def random_events(seed, n=220):
    rng = random.Random(seed)
    first = dt.date(2024, 1, 1)
    out = []
    for i in range(n):
        cust = None if rng.random() < 0.03 else rng.choice(["hot"] * 5 + ["b", "c", "d"])
        amount = None if rng.random() < 0.05 else rng.choice([10.0, 10.0, 25.5, round(rng.random() * 90, 2)])
        state = rng.choice(["NY", "CA", "TX", "WA", None])
        out.append((i, cust, first + dt.timedelta(days=rng.randrange(80)), amount, state, rng.random() < 0.2))
    return out


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_definition(spark, seed, strict):
    events = random_events(seed)
    assert observed(roll(spark.createDataFrame(events, SCHEMA), strict)) == brute(events, strict)


def test_window_edges_and_same_day(spark):
    events = [
        (1, "a", day("2024-01-01"), 5.0, "NY", True),
        (2, "a", day("2024-01-31"), 7.0, "NY", False),
        (3, "a", day("2024-02-01"), 9.0, "CA", False),
        (4, "b", day("2024-01-01"), 1.0, "NY", False),
        (5, "c", day("2024-01-01"), 1.0, "NY", True),
        (6, "c", day("2024-01-01"), 1.0, "NY", False),
    ]
    got = roll(spark.createDataFrame(events, SCHEMA))
    assert one(got, id=2)["tx_count"] == 1 and one(got, id=2)["days_since_last"] == 30
    assert one(got, id=3)["tx_count"] == 1 and one(got, id=3)["prior_labels"] == 0
    assert one(got, id=4)["days_since_last"] == 999 and one(got, id=4)["avg_amount"] == 0.0
    assert one(got, id=6)["days_since_last"] == 0 and one(got, id=6)["prior_labels"] == 1
    assert one(got, id=5)["prior_labels"] == 0
    strict = roll(spark.createDataFrame(events, SCHEMA), strict=True)
    assert one(strict, id=6)["tx_count"] == 0


def test_later_events_never_change_earlier_features(spark):
    events = random_events(9)
    cut = dt.date(2024, 2, 10)
    whole = observed(roll(spark.createDataFrame(events, SCHEMA)))
    past = observed(roll(spark.createDataFrame([e for e in events if e[2] <= cut], SCHEMA)))
    assert past == {i: v for i, v in whole.items() if i in past}


def test_no_event_pairs_in_the_plan(spark):
    df = spark.createDataFrame(random_events(4), SCHEMA)
    plan = roll(df)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in plan


@pytest.mark.parametrize("per_day", [False, True])
def test_signals_around_days(spark, per_day):
    base = spark.createDataFrame(
        [("a", day("2024-04-01")), ("a", day("2024-04-09")), ("b", day("2024-04-01")), (None, day("2024-04-01"))],
        "asset string, d date",
    )
    events = spark.createDataFrame(
        [("a", day("2024-04-08"), "f"), ("a", day("2024-01-02"), "f"), ("a", day("2024-01-01"), "f"),
         ("a", day("2024-04-01"), "m"), ("a", None, "m"), (None, day("2024-04-01"), "f")],
        "asset string, e date, kind string",
    )
    failure, service = F.col("kind") == "f", F.col("kind") == "m"
    got = attach_signals(
        base, events, "asset", "d", "e",
        [
            Signal("soon", "any", after=7, where=failure),
            Signal("past", "count", before=90, where=failure),
            Signal("since", "days_since", before=None, where=service, default=999),
        ],
        one_row_per_day=per_day,
    )
    want = {
        ("a", day("2024-04-01")): (1, 1, 0),
        ("a", day("2024-04-09")): (0, 1, 8),
        ("b", day("2024-04-01")): (0, 0, 999),
        (None, day("2024-04-01")): (0, 0, 999),
    }
    assert {(r.asset, r.d): (r.soon, r.past, r.since) for r in got.collect()} == want


def test_signals_keep_repeated_base_rows(spark):
    base = spark.createDataFrame([("a", day("2024-01-01"), i) for i in range(3)], "k string, d date, i int")
    events = spark.createDataFrame([("a", day("2024-01-01"))] * 2, "k string, e date")
    got = attach_signals(base, events, "k", "d", "e", [Signal("n", "count", before=7)])
    assert sorted((r.i, r.n) for r in got.collect()) == [(0, 2), (1, 2), (2, 2)]


def test_asof_lookup(spark):
    history = spark.createDataFrame(
        [("a", day("2024-01-01"), day("2024-01-10"), "x"), ("a", day("2024-01-20"), None, None)],
        "k string, f date, u date, v string",
    )
    facts = spark.createDataFrame(
        [("a", day("2023-12-31")), ("a", day("2024-01-01")), ("a", day("2024-01-09")),
         ("a", day("2024-01-10")), ("a", day("2024-02-01")), ("b", day("2024-01-05")), (None, day("2024-01-05"))],
        "k string, d date",
    )
    got = attach_asof(facts, history, "k", "d", "f", ["v"], "u")
    assert got.count() == 7
    assert sorted(str(r.d) for r in got.collect() if r.v == "x") == ["2024-01-01", "2024-01-09"]


def test_small_amounts_are_not_rounded(spark):
    data = [(1, 1, "2024-01-01", 0.004), (2, 1, "2024-01-02", 0.004), (3, 1, "2024-01-03", 1.0)]
    df = spark.createDataFrame(data, "id int, k int, d string, a double").selectExpr("*", "'x' AS c", "false AS l")
    got = pit_rolling(df.withColumn("d", F.col("d").cast("date")), "k", "d", "id", "a", "c", "l")
    assert one(got, id=3)["avg_amount"] == 0.004 and one(got, id=3)["total_amount"] == 0.008
    finer = df.withColumn("a", F.lit(0.12345678)).withColumn("d", F.col("d").cast("date"))
    with pytest.raises(Exception, match="more than 6 digits"):
        pit_rolling(finer, "k", "d", "id", "a", "c", "l").collect()
