"""States, segment join, linkage, spliced history, change points, distances, provenance, quarantine."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.operators import checks, governance, history, linkage, monitor, passjoin, quarantine, series, states
from tidemark.operators.states import Measure

ONE = RunContext.of("2024-01-01", "2024-01-01 06:00:00")
TWO = RunContext.of("2024-01-02", "2024-01-02 06:00:00")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("distance", [0, 1, 2, 4])
def test_segment_join_finds_every_pair(spark, distance):
    make = random.Random(distance)
    texts = {"", "a", "é", "ab", "日本", "abcdabcdabcd"} | {"".join(make.choices("abc", k=make.randint(0, 14))) for _ in range(150)}
    df = spark.createDataFrame([(t, 1) for t in [*texts, "a", "a"]] + [(None, 1)], "t string, distance int")
    got = {(r.left, r.right): r.distance for r in passjoin.similar_pairs(df, "t", distance).collect()}
    want = {}
    for a, b in itertools.combinations(texts, 2):
        if edits(a, b) <= distance:
            want[tuple(sorted((a, b), key=lambda s: s.encode()))] = edits(a, b)
    assert got == want


def test_suite_over_states_equals_suite_over_rows(spark):
    rows = [(d, v, "x" if v and v > 3 else "y") for d in range(5) for v in (1.5, 2.25, None, 4.0 + d)]
    df = spark.createDataFrame(rows, "day int, v double, kind string")
    measures = (
        Measure("n", "count"), Measure("n_v", "count", "v IS NOT NULL"), Measure("s", "sum", "CAST(v AS DECIMAL(18, 6))"),
        Measure("low", "min", "v"), Measure("high", "max", "v"), Measure("kinds", "distinct", "kind"),
    )
    by_day = states.build_states(df, measures, "day")
    ask = [
        checks.Check("rows", "t", "n", 10), checks.Check("filled", "t", "try_divide(n_v, n) * 100", 80.0),
        checks.Check("total", "t", "s", 0), checks.Check("low", "t", "low", 2.0), checks.Check("high", "t", "high", 9.0, False),
        checks.Check("kinds", "t", "hll_sketch_estimate(kinds)", 2),
    ]
    plain = [
        checks.Check("rows", "t", "count(*)", 10), checks.Check("filled", "t", "try_divide(count(v), count(*)) * 100", 80.0),
        checks.Check("total", "t", "sum(v)", 0), checks.Check("low", "t", "min(v)", 2.0), checks.Check("high", "t", "max(v)", 9.0, False),
        checks.Check("kinds", "t", "count(DISTINCT kind)", 2),
    ]
    got = states.suite_from_states({"t": (by_day, measures)}, ask).collect()
    assert sorted(got) == sorted(checks.run_suite(spark, plain, {"t": df}).collect())


def fields():
    return [
        linkage.Field("name", F.col("name"), F.substring("name", 1, 1)), linkage.Field("city", F.col("city")),
        linkage.Field("zip", F.col("zip")),
    ]


PEOPLE = [(i, n, c, z) for i, (n, c, z) in enumerate([
    ("ann", "x", "1"), ("ann", "x", "1"), ("amy", "x", "1"), ("bob", "y", None), ("bob", "y", "2"), (None, "x", "1"), ("ann", "z", "2"), ("bea", "y", "2"),
])]


def pattern(a, b):
    name = 0 if a[1] is None or b[1] is None else 2 if a[1] == b[1] else int(a[1][0] == b[1][0])
    return (name, *[int(a[i] is not None and a[i] == b[i]) for i in (2, 3)])


def test_patterns_are_those_of_all_pairs(spark):
    df = spark.createDataFrame(PEOPLE, "id int, name string, city string, zip string")
    want = Counter(pattern(a, b) for a, b in itertools.combinations(PEOPLE, 2))
    assert {p: n for p, n in linkage.pattern_counts(df, fields()).items() if n} == dict(want)


def test_weights_are_those_of_plain_em():
    make = np.random.default_rng(3)
    counts = {}
    for p in itertools.product(range(2), repeat=3):
        counts[p] = int(1000 * np.prod([0.9 if x else 0.1 for x in p]) + 20000 * np.prod([0.1 if x else 0.9 for x in p]))
    fitted = linkage.fit_weights(counts, rounds=200)
    # The same by a row per pair.
    rows = np.array([p for p, n in counts.items() for _ in range(n)])
    make.shuffle(rows)
    share, m, u = 0.1, np.array([[0.1, 0.9]] * 3), np.array([[0.9, 0.1]] * 3)
    for _ in range(200):
        a = share * np.prod([m[i][rows[:, i]] for i in range(3)], axis=0)
        b = (1 - share) * np.prod([u[i][rows[:, i]] for i in range(3)], axis=0)
        g = a / (a + b)
        share = g.mean()
        for i in range(3):
            m[i] = np.bincount(rows[:, i], g, 2) / g.sum()
            u[i] = np.bincount(rows[:, i], 1 - g, 2) / (1 - g).sum()
    assert fitted.share == pytest.approx(share, rel=1e-5)
    assert np.allclose(fitted.match, m, rtol=1e-5) and np.allclose(fitted.other, u, rtol=1e-5)
    assert fitted.of((1, 1, 1)) > 0 > fitted.of((0, 0, 0))


def test_links_connect_all_pairs_above_the_limit(spark):
    df = spark.createDataFrame(PEOPLE, "id int, name string, city string, zip string")
    weight = lambda p: (-2, 1, 4)[p[0]] + (-1, 2)[p[1]] + (-1, 2)[p[2]]
    want = {i: i for i, *_ in PEOPLE}
    pairs = [(a[0], b[0]) for a, b in itertools.combinations(PEOPLE, 2) if weight(pattern(a, b)) >= 5]
    for _ in PEOPLE:
        for a, b in pairs:
            want[a] = want[b] = min(want[a], want[b])
    found = {i: i for i, *_ in PEOPLE}
    links = [tuple(r) for r in linkage.match_links(df, "id", fields(), weight, 5).collect()]
    for _ in PEOPLE:
        for a, b in links:
            found[a] = found[b] = min(found[a], found[b])
    assert found == want
    with pytest.raises(ValueError):
        linkage.least_patterns(fields(), lambda p: -sum(p), 0)


RECORDS = [(k, f"2024-01-{d:02d}", o, s) for o, (k, d, s) in enumerate([
    ("a", 1, "x"), ("a", 5, "x"), ("a", 3, "y"), ("a", 3, "x"), ("a", 9, None), ("b", 2, "y"), ("b", 2, "z"), ("a", 7, "y"), (None, 1, "x"), ("b", 4, "z"),
])]


@given(st.permutations(range(len(RECORDS))), st.integers(1, 9))
@settings(max_examples=4, deadline=None)
def test_any_order_of_batches_gives_the_history(spark, order, cut):
    what = ("k", "d", "o", ["s"])
    frame = lambda rows: spark.createDataFrame(rows, "k string, d string, o int, s string")
    plan = [RECORDS[i] for i in order]
    out = history.start_history(frame(plan[:cut]), *what)
    out = history.splice_history(out, frame(plan[cut:]), *what)
    whole = history.scd2(frame(RECORDS), *what)
    assert sorted(out.drop("seen").select(whole.columns).collect(), key=str) == sorted(whole.collect(), key=str)


def test_planted_shift_is_found_at_its_day(spark):
    rows = [(k, d, 100 + (40 if k == "up" and d >= 12 else 0) - (40 if k == "down" and d >= 20 else 0) + d % 3) for k in ("up", "down", "flat") for d in range(1, 31)]
    df = spark.createDataFrame(rows, "k string, day int, v bigint")
    got = series.sustained_shift(df, "k", "day", "v", 7, 5, 60).collect()
    assert sorted((r.k, r.direction, r.shift_day) for r in got) == [("down", "down", 20), ("up", "up", 12)]


@given(st.lists(st.tuples(st.integers(0, 9), st.booleans()), min_size=1, max_size=40))
@settings(max_examples=5, deadline=None)
def test_distance_of_two_samples(spark, rows):
    df = spark.createDataFrame([(float(v), b) for v, b in rows], "v double, late boolean")
    got = monitor.ks_distance(df, "v", F.col("late")).first()
    one, two = [v for v, b in rows if not b], [v for v, b in rows if b]
    assert (got.n_first, got.n_second) == (len(one), len(two))
    if one and two:
        want = max(abs(sum(x <= v for x in one) / len(one) - sum(x <= v for x in two) / len(two)) for v in range(10))
        assert got.distance == pytest.approx(want, abs=1e-12)
    else:
        assert got.distance is None and not got.differs


def test_bitmaps_name_every_batch(spark):
    rows = [(i % 4, f"b{i % (3 + i % 4):03d}") for i in range(60)] + [(9, None)]
    df = spark.createDataFrame(rows, "k int, _batch_id string")
    names = governance.batch_dictionary(df)
    by_key = governance.numbered_batches(df, names).groupBy("k", "_bucket").agg(governance.batches_of())
    got = {r.k: r.batch_ids for r in governance.batch_names(by_key, names).collect()}
    want = {k: sorted({b for x, b in rows if x == k and b}) for k, _ in rows}
    assert got == want


def test_ledger_takes_rows_back_once(spark):
    schema = "id int, parent string, v double, status string"
    first = spark.createDataFrame([(1, "a", 1.0, "s"), (2, "b", 2.0, None), (2, "b", 2.0, None), (3, None, 3.0, "s"), (4, "a", -1.0, "s")], schema)
    rules = {"positive": F.col("v") > 0}
    parents = lambda *names: [quarantine.Parent("orphan", "parent", spark.createDataFrame([(n,) for n in names], "p string"), "p")]
    screened = quarantine.screened(first, rules, parents("a"))
    ledger = quarantine.rejects(screened, first.columns, ONE)
    assert sorted((tuple(r.reasons), r.copies, r.status) for r in ledger.collect()) == [(("orphan",), 1, "open"), (("orphan",), 2, "open"), (("positive",), 1, "open")]
    after = quarantine.settled(ledger, first.schema, rules, parents("a", "b"), TWO)
    back = quarantine.restored(quarantine.replayed(after, TWO.batch_id), first.schema)
    assert sorted(map(tuple, back.collect())) == [(2, "b", 2.0, None)] * 2
    again = quarantine.settled(after, first.schema, rules, parents("a", "b"), RunContext.of("2024-01-03"))
    assert {(r.status, r.resolved_batch) for r in again.filter("copies = 2").collect()} == {("replayed", TWO.batch_id)}
    good = screened.filter("size(reject_reasons) = 0")
    row = quarantine.account(after, first, good.select("id").unionByName(back.select("id"))).first()
    assert row.complete and (row.open_rejects, row.replayed) == (2, 2)
