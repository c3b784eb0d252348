"""What must not depend on the cluster, and what must not grow with the square of a text."""

import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses, lm, matches, pii


def test_scores_do_not_depend_on_how_documents_are_dealt(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one = lm.score(docs.coalesce(1)).select("doc_id", "score", "base_score").collect()
    many = lm.score(docs.repartition(7), chunk_tokens=3000).select("doc_id", "score", "base_score").collect()
    assert len(one) == len(many)
    for a, b in zip(sorted(one), sorted(many), strict=True):
        assert a.doc_id == b.doc_id
        assert b.score == pytest.approx(a.score, rel=1e-4)
        assert b.base_score == pytest.approx(a.base_score, rel=1e-9)


def test_the_model_learns_from_context(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    unseen = lm.score(docs).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert unseen.s > unseen.b


def test_rounds_are_dealt_by_id_alone():
    ids = [None, 0, 5, -3, 2**40]
    slices = lm.slices_of(ids, 4).tolist()
    assert slices == [lm.slices_of([d], 4)[0] for d in ids] and set(slices) <= {0, 1, 2, 3}


def test_running_sums_over_all_levels(spark):
    for n in (1, 63, 64, 65, 4096, 4097, 5000):
        values = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: (x % 7).cast("bigint"))
        got = spark.range(1).select(matches._running(values).alias("s")).first().s
        want, total = [], 0
        for x in range(1, n + 1):
            total += x % 7
            want.append(total)
        assert got == want


@pytest.mark.parametrize("scan", ["pii", "licenses"])
def test_time_follows_the_number_of_matches(spark, scan):
    numbers = ", ".join(str(1000 + i % 9000) for i in range(40_000)) + ", "
    names = "mit license apache license 2.0 and gnu general public license v3, " * 4000
    text = numbers if scan == "pii" else names

    def run(t):
        df = spark.createDataFrame([(1, t)], "doc_id bigint, text string")
        start = time.perf_counter()
        row = (pii.digests(pii.find(df)) if scan == "pii" else licenses.scan(df).drop("detections")).first()
        return time.perf_counter() - start, row

    run("warm up " + text[:1000])
    one, first = run(text)
    two, second = run(text * 2)
    assert two < 2.6 * one + 2
    if scan == "licenses":
        assert second.n_base == 2 * first.n_base == 2 * 3 * 4000


def test_places_of_many_matches(spark):
    text = "é1 " * 5000
    df = spark.createDataFrame([(text,)], "text string")
    found = df.select(matches.places(F.col("text"), "[0-9]", lambda t: F.lit(True)).alias("p")).first().p
    assert [(x.start, x.end) for x in found] == [(3 * i + 1, 3 * i + 2) for i in range(5000)]
