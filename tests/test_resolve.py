import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemark.operators import resolve


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def words(seed, n=60):
    rng = random.Random(seed)
    out = {"", "a", "ab", "ba"}
    while len(out) < n:
        out.add("".join(rng.choice("abc") for _ in range(rng.randrange(1, 8))))
    return sorted(out)


@pytest.mark.parametrize("limit", [1, 2])
def test_closest_smaller_text_is_exact(spark, limit):
    texts = words(limit)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.text: (r.match_text, r.distance) for r in resolve.closest_smaller_text(df, "t", limit).collect()}
    want = {}
    for a in texts:
        near = [b for b in texts if b != a and distance(a, b) <= limit]
        if near:
            want[a] = (min(near), distance(a, min(near)))
    assert got == want


def reachable(texts, limit):
    parent = {t: t for t in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and distance(a, b) <= limit:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {t: find(t) for t in texts}


@pytest.mark.parametrize("limit,seed", [(1, 11), (1, 12), (2, 13)])
def test_star_links_connect_like_all_pairs(spark, limit, seed):
    rng = random.Random(seed)
    texts = sorted({"".join(rng.choice("abcdef") for _ in range(rng.randrange(3, 7))) for _ in range(70)})
    df = spark.createDataFrame([("", t) for t in texts], "block string, text string")
    links = resolve.star_links(df, limit)
    for r in links.collect():
        assert distance(r.text, r.hub) <= limit
    nodes = df.select(F.col("text").alias("node"))
    got = resolve.components(nodes, links.select(F.col("text").alias("a"), F.col("hub").alias("b")))
    assert {r.node: r.component for r in got.collect()} == reachable(texts, limit)


def test_components_of_a_long_chain(spark):
    n = 40
    nodes = spark.range(n).withColumnRenamed("id", "node")
    links = spark.range(n - 1).selectExpr("id AS a", "id + 1 AS b")
    got = resolve.components(nodes, links)
    assert {r.component for r in got.collect()} == {0}


def test_golden_records(spark):
    df = spark.createDataFrame(
        [(3, "jon smith", "x"), (1, "john smith", "x"), (2, "john smith", "x"), (4, "joh smith", "x"),
         (5, "mary", "x"), (6, "john smith", "y"), (7, None, "x")],
        "id int, name string, city string",
    )
    got = resolve.golden_records(df, "id", "name", 1, F.col("city"))
    assert rows(got, "golden_id", "golden_name", "spelling_count", "record_count") == [
        (1, "john smith", 3, 4), (5, "mary", 1, 1), (6, "john smith", 1, 1),
    ]
