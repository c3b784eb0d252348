"""Versioned snapshots: whole or unseen, partitions carried over, old versions removed."""

import pytest
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.sources.snapshots import Files, PublishConflict, SnapshotTable

FIRST = RunContext.of("2024-01-01", "2024-01-01 06:00:00")
SECOND = RunContext.of("2024-01-02", "2024-01-02 06:00:00")


def rows(df):
    return sorted(map(tuple, df.select("k", "v", F.col("day").cast("string")).collect()), key=str)


def days(spark, *pairs):
    return spark.createDataFrame(pairs, "k int, v string, day string").withColumn("day", F.col("day").cast("date"))


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "t"))


def test_versions_by_number_and_untouched_files(spark, table):
    assert table.latest() == 0
    one = [(1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", None)]
    assert table.publish(days(spark, *one), FIRST, ["day"]) == 1
    before = {(r.folder, r.file) for r in table.manifest().collect()}
    two = [(4, "d", "2024-01-02"), (5, "e", "2024-01-03")]
    assert table.publish(days(spark, *two), SECOND, ["day"], replace=F.lit(False)) == 2
    assert rows(table.read(1)) == sorted(one, key=str)
    assert rows(table.read()) == sorted([one[0], one[2], *two], key=str)
    after = {(r.folder, r.file): r.batch_id for r in table.manifest().collect()}
    assert len(before & set(after)) == 2
    assert {after[f] for f in before & set(after)} == {FIRST.batch_id}
    gone, added = table.changed_rows(1)
    assert rows(gone) == [one[1]] and rows(added) == sorted(two, key=str)
    v = table.version()
    assert (v.parent, v.rows, v.batch_id, v.as_of) == (1, 4, SECOND.batch_id, "2024-01-02")


def test_a_condition_removes_partitions_without_new_rows(spark, table):
    table.publish(days(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-02")), FIRST, ["day"])
    table.publish(days(spark, (9, "z", "2024-01-09")).filter("k < 0"), SECOND, ["day"],
                  replace=F.col("values")["day"] == "2024-01-01")
    assert rows(table.read()) == [(2, "b", "2024-01-02")]


def test_a_run_killed_before_the_last_step_changes_nothing(spark, table, monkeypatch):
    table.publish(days(spark, (1, "a", "2024-01-01")), FIRST)

    def die(self, path, text):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Files, "create", die)
        with pytest.raises(KeyboardInterrupt):
            table.publish(days(spark, (2, "b", "2024-01-01")), SECOND)
    assert table.versions() == [1] and rows(table.read()) == [(1, "a", "2024-01-01")]
    # The next run is not disturbed, and the leftovers go once they are old enough.
    assert table.publish(days(spark, (3, "c", "2024-01-01")), SECOND) == 2
    assert len(table.files.names(table.root + "/data")) == 3
    table.expire(keep=2)
    assert len(table.files.names(table.root + "/data")) == 3
    table.expire(keep=2, grace_hours=0)
    assert len(table.files.names(table.root + "/data")) == 2
    assert rows(table.read(1)) == [(1, "a", "2024-01-01")] and rows(table.read(2)) == [(3, "c", "2024-01-01")]


def test_two_writers_from_one_version(spark, table, monkeypatch):
    table.publish(days(spark, (1, "a", "2024-01-01")), FIRST)
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "latest", lambda self: 0)
        with pytest.raises(PublishConflict):
            table.publish(days(spark, (2, "b", "2024-01-01")), SECOND)
    assert rows(table.read()) == [(1, "a", "2024-01-01")]


def test_expired_versions_leave_shared_partitions(spark, table):
    for i, day in enumerate(("2024-01-01", "2024-01-02", "2024-01-01"), 1):
        table.publish(days(spark, (i, "x", day)), FIRST, ["day"], replace=F.lit(False))
    assert table.expire(keep=1) == [1, 2]
    assert table.versions() == [3] and rows(table.read()) == [(2, "x", "2024-01-02"), (3, "x", "2024-01-01")]
    with pytest.raises(Exception):
        table.read(1)


def test_partition_values_with_marks_and_a_changed_schema(spark, table):
    odd = spark.createDataFrame([(1, "a b:c%/d=é"), (2, ""), (3, None)], "k int, p string")
    table.publish(odd, FIRST, ["p"])
    assert {(r.k, r.p) for r in table.read().collect()} == {(1, "a b:c%/d=é"), (2, None), (3, None)}
    with pytest.raises(ValueError):
        table.publish(odd.withColumn("x", F.lit(1)), SECOND, ["p"], replace=F.lit(False))
    assert table.publish(odd.withColumn("x", F.lit(1)), SECOND) == 2 and table.read().columns == ["k", "p", "x"]
